"""Byte-level BPE encoding and decoding.

A text is cut into pieces by the tokenizer's pattern. A piece that is a token is its own
code; any other is a byte array whose neighbouring pairs are merged, the pair of the lowest
rank and of those the leftmost first, until no pair has a rank. Decoding concatenates the byte strings
of the ids.

``encode_native`` folds the merges with Spark's higher-order functions, over byte strings
held as hexadecimal text and a literal map of ranks. It is exact, but its lambdas are
interpreted and it cannot remember a piece from one row to the next, and so stays above the
limits (README). ``encode`` and ``decode`` do the same row by row in Python: each distinct piece is merged
once per task and then looked up. No row leaves its partition.

Ids of a text are held as decimal numbers joined by commas; ``ids_array`` gives them as numbers.

Defined cases: a null text is empty; an empty text has no ids and decodes to nothing; pieces of any length are
merged with a heap, in n log n steps; equal rows are encoded each; an empty table gives an empty result; other columns are
ignored, or carried along if named in ``carry``.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakesearch.functions.text import let
from lakesearch.llm.common import document_columns, table

REMEMBERED_PIECES = 1 << 18
SLICE_ROWS = 256
SHORT_PIECE = 48
SHARDS = 1 << 14
NO_RANK = 2**31 - 1


class Vocabulary:
    """Ranks of a tiktoken file, and the pattern that goes with it."""

    def __init__(self, path: str, pattern: str):
        lines = [line.split() for line in Path(path).read_bytes().splitlines() if line]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.pattern = pattern

    def in_java(self) -> str:
        """The pattern with Unicode's white space, which Java's ``\\s`` is not."""
        return self._spaced(r"\p{IsWhite_Space}", r"\P{IsWhite_Space}")

    def in_python(self) -> str:
        """Likewise for the regex module, whose ``\\s`` has four more characters."""
        return self._spaced(r"\p{White_Space}", r"\P{White_Space}")

    def _spaced(self, blank: str, other: str) -> str:
        return self.pattern.replace(r"\s", blank).replace(r"\S", other)

    def pieces(self) -> list[str]:
        """Hexadecimal byte string of each id, '' where there is none."""
        out = [""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            out[rank] = token.hex().upper()
        return out


def _literal(value, ddl: str) -> Column:
    """A constant of nested type: the optimizer folds the parsing of its JSON text."""
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False, separators=(",", ":"))), ddl)


def _sharded(entries: dict[str, object], kind: str) -> Column:
    shards: list[dict] = [{} for _ in range(SHARDS)]
    for key, value in entries.items():
        shards[zlib.crc32(key.encode()) % SHARDS][key] = value
    return _literal(shards, f"array<map<string,{kind}>>")


def _find(shards: Column, key: Column) -> Column:
    return F.try_element_at(F.element_at(shards, (F.crc32(key) % SHARDS + 1).cast("int")), key)


def fold_merges(piece: Column, ranks: Column) -> Column:
    """Ids of one piece, as decimal numbers joined by commas."""
    whole = F.hex(F.encode(piece, "UTF-8"))
    first = F.transform(F.sequence(F.lit(0), F.octet_length(piece) - 1), lambda i: F.substr(whole, i * 2 + 1, F.lit(2)))

    def merge(parts: Column) -> Column:
        pair = F.transform(parts, lambda p, i: F.coalesce(_find(ranks, F.concat(p, F.get(parts, i + 1))), F.lit(NO_RANK)))
        return let(pair, lambda found: let(F.array_min(found), lambda low: F.when(low == NO_RANK, parts).otherwise(
            let(F.array_position(found, low).cast("int"), lambda at: F.concat(
                F.slice(parts, F.lit(1), at - 1), F.array(F.concat(F.element_at(parts, at), F.element_at(parts, at + 1))),
                F.slice(parts, at + 2, F.size(parts)))))))

    folded = let(first, lambda parts: F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), parts, lambda acc, _: merge(acc)))
    ids = F.array_join(F.transform(folded, lambda p: _find(ranks, p).cast("string")), ",")
    return F.coalesce(_find(ranks, whole).cast("string"), ids)


def encode_native(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, ids) in DataFrame operations only; steps grow with the square of a piece's length."""
    ranks = _sharded({token.hex().upper(): rank for token, rank in vocabulary.ranks.items()}, "int")
    pieces = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(vocabulary.in_java()), F.lit(0))
    return document_columns(docs).select("doc_id", F.array_join(F.transform(pieces, lambda p: fold_merges(p, ranks)), ",").alias("ids"))


def decode_native(ids: Column, vocabulary: Vocabulary) -> Column:
    """Bytes of ids joined by commas."""
    pieces = _literal(vocabulary.pieces(), "array<string>")
    parts = F.transform(F.split(ids, ","), lambda i: F.element_at(pieces, i.cast("int") + 1))
    return F.when(ids == "", F.lit(b"")).otherwise(F.unhex(F.array_join(parts, "")))


def merge_with_heap(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a long piece: a heap of ranked pairs over a linked list of parts."""
    if piece in ranks:
        return [ranks[piece]]
    parts: list[bytes | None] = [piece[i:i + 1] for i in range(len(piece))]
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap: list[tuple[int, int, bytes, bytes]] = []

    def offer(at: int) -> None:
        if 0 <= at and after[at] < len(parts):
            left, right = parts[at], parts[after[at]]
            rank = ranks.get(left + right)
            if rank is not None:
                heapq.heappush(heap, (rank, at, left, right))

    for at in range(len(parts) - 1):
        offer(at)
    while heap:
        _, at, left, right = heapq.heappop(heap)
        follower = after[at]
        if parts[at] != left or follower >= len(parts) or parts[follower] != right:
            continue
        parts[at], parts[follower] = left + right, None
        after[at] = after[follower]
        if after[at] < len(parts):
            before[after[at]] = at
        offer(before[at])
        offer(at)
    return [ranks[p] for p in parts if p is not None]


def merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a short piece, where a plain search for the least rank is quicker."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    pairs = [ranks.get(a + b, NO_RANK) for a, b in zip(parts, parts[1:])]
    while pairs:
        low = min(pairs)
        if low == NO_RANK:
            break
        at = pairs.index(low)
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], NO_RANK)
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1], NO_RANK)
    return [ranks[p] for p in parts]


class PieceMemory(dict):
    """Ids of each piece, as text; forgets everything when it holds ``REMEMBERED_PIECES``."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: str) -> str:
        if len(self) >= REMEMBERED_PIECES:
            self.clear()
        data = piece.encode()
        rank = self.ranks.get(data)
        if rank is not None:
            ids = [rank]
        else:
            ids = (merge_short if len(data) <= SHORT_PIECE else merge_with_heap)(data, self.ranks)
        text = self[piece] = ",".join(map(str, ids))
        return text


def bytes_of(ids: str, token) -> bytes:
    """Byte strings of ids joined by commas, concatenated; ``token`` gives that of one id."""
    return b"".join(map(token, ids.split(","))) if ids else b""


def _names_of_ids(vocabulary: Vocabulary) -> dict[str, bytes]:
    return {str(rank): token for token, rank in vocabulary.ranks.items()}


def _kinds(columns: DataFrame) -> str:
    return "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in columns.schema.fields)


def encode(docs: DataFrame, vocabulary: Vocabulary, carry: tuple[str, ...] = (), decoded: bool = False) -> DataFrame:
    """(doc_id, ids) and the ``carry`` columns; with ``decoded`` also the bytes that the ids decode
    to, as ``decode`` gives them, in the same pass."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.ranks)
    back = docs.sparkSession.sparkContext.broadcast(_names_of_ids(vocabulary)) if decoded else None
    pattern = vocabulary.in_python()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, ids_of = regex.compile(pattern).findall, PieceMemory(shared.value).__getitem__
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                ids = [",".join(map(ids_of, find(t or ""))) for t in part.column("text").to_pylist()]
                columns = {"doc_id": part.column("doc_id"), "ids": pa.array(ids, pa.string())}
                if decoded:
                    columns["decoded"] = pa.array([bytes_of(i, back.value.__getitem__) for i in ids], pa.binary())
                yield pa.RecordBatch.from_pydict(columns | {c: part.column(c) for c in carry})

    return plain.mapInArrow(run, "doc_id long, ids string" + ", decoded binary" * decoded + _kinds(plain.select(*carry)))


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Add ``decoded``, the bytes of ``ids``; an id that is no token fails the task."""
    back = encoded.sparkSession.sparkContext.broadcast(_names_of_ids(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                yield part.append_column("decoded", pa.array([bytes_of(i, back.value.__getitem__) for i in part.column("ids").to_pylist()], pa.binary()))

    return encoded.mapInArrow(run, _kinds(encoded)[2:] + ", decoded binary")


def ids_array(ids: Column) -> Column:
    return F.when(ids == "", F.array().cast("array<int>")).otherwise(F.split(ids, ",").cast("array<int>"))


def count_ids(ids: Column) -> Column:
    return F.when(ids == "", 0).otherwise(F.length(ids) - F.length(F.translate(ids, ",", "")) + 1).cast("long")


def multi_vocabulary() -> Vocabulary:
    import public_tokenizers

    return Vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def digests(encoded: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Digests of (doc_id, ids, decoded), and the ``carry`` columns."""
    return encoded.select("doc_id", count_ids(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"), *carry)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode(table(spark, sf_dir, "documents"), multi_vocabulary(), decoded=True))
