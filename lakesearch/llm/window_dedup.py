"""Substring dedup of word windows behind a count-min prefilter.

A window is ``width`` consecutive words of a document. Each word covered by a window whose
words also start earlier (in a document of smaller id, or before in the same one) goes;
windows are judged on the input.

First pass: each chunk of documents sketches its windows, and the merged sketch
(``sketch.py``) tells which may be repeated; it overestimates, so none is lost. Second
pass: only those are grouped exactly. A chunk sends each distinct window once, with the
first document that has it; per window the first chunk is found and told so. Third pass: a
chunk knows of each of its windows whether the first one of all is its own, and cuts the texts.

Text is shuffled once, by chunk; all else is a bit or a few bytes a window. A window that
a third of all documents share is one entry per chunk. Windows are compared by 96 bits of
hash over 64-bit word hashes: at 10**13 windows two different ones meet with a chance below 0.1 %.

Defined cases: a null or empty text has no words and stays empty; rows without id come after
all others, in an order of their texts; rows with equal id are in the order of their texts; of equal rows the first keeps its
words; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakesearch.llm.common import chunked, document_columns, table, text_bytes
from lakesearch.llm.sketch import ANSWERS, CELLS, answers, estimated_repeated, sketch_bits, sketch_rows
from lakesearch.llm.words import WordHashes, mixed, split_words, window_hashes

WIDTH = 20
CHUNK_BYTES = 8 << 20
LAST = np.iinfo(np.int64).max

_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

#: Distinct windows of a chunk for a group of windows.
KEYS = "part int, chunk int, high binary, low binary, docs binary"
KEPT = "doc_id long, n_words long, n_removed long, kept string"


class _Chunk:
    """Windows of a chunk's documents, in order of document and start."""

    def __init__(self, docs: pa.Table, width: int):
        rows = sorted(((LAST if d is None else d, t or "", d) for d, t in zip(docs["doc_id"].to_pylist(), docs["text"].to_pylist())),
                      key=lambda r: r[:2])
        hashes = WordHashes()
        self.ids = [r[2] for r in rows]
        self.words = [split_words(r[1].encode()) for r in rows]
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        codes = np.concatenate([hashes.of(w) for w in self.words]) if len(rows) else np.zeros(0, _U)
        owner = np.repeat(np.arange(len(rows)), sizes)
        n = max(0, len(codes) - width + 1)
        self.at = np.flatnonzero(owner[:n] == owner[width - 1:width - 1 + n])
        self.keys = window_hashes(codes, width, _BASES[0])[self.at]
        self._codes, self._width = codes, width
        self.docs = np.array([r[0] for r in rows], np.int64)[owner[self.at]]

    def distinct(self, maybe: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(high, low, first, which) of the windows ``maybe``: sorted distinct keys, the first
        window of each, and the key of each window."""
        high = self.keys[maybe]
        low = (window_hashes(mixed(self._codes + _U(1)), self._width, _BASES[1])[self.at[maybe]] >> _U(32)).astype(np.uint32)
        order = np.lexsort((low, high))
        new = np.ones(len(order), bool)
        new[1:] = (high[order[1:]] != high[order[:-1]]) | (low[order[1:]] != low[order[:-1]])
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        first = order[new]
        return high[first], low[first], maybe[first], which


def _parts(high: np.ndarray, bits: int):
    """(part, slice) of sorted keys by their leading bits."""
    if not len(high):
        return
    part = (high >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(high), np.int64)
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(high)]))
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(part[a]), slice(int(a), int(b))


def _answered(table_: pa.Table, kind: int) -> dict[int, bytes]:
    return {b: bits for k, b, bits in zip(table_["kind"].to_pylist(), table_["block"].to_pylist(), table_["bits"].to_pylist()) if k == kind}


def first_of_all(sent: pa.Table) -> pa.Table:
    """For one part: tells each chunk which of its windows come first of all."""
    high = np.frombuffer(b"".join(sent["high"].to_pylist()), _U)
    low = np.frombuffer(b"".join(sent["low"].to_pylist()), np.uint32)
    docs = np.frombuffer(b"".join(sent["docs"].to_pylist()), np.int64)
    chunks = sent["chunk"].to_numpy()
    sizes = np.array([len(x) // 4 for x in sent["low"].to_pylist()])
    order = np.lexsort((np.repeat(chunks, sizes), docs, low, high))
    new = np.ones(len(order), bool)
    new[1:] = (high[order[1:]] != high[order[:-1]]) | (low[order[1:]] != low[order[:-1]])
    owns = np.zeros(len(order), bool)
    owns[order[new]] = True
    ends = np.cumsum(sizes)
    bits = [np.packbits(owns[e - n:e]).tobytes() for e, n in zip(ends, sizes)]
    return pa.table({"chunk": pa.array(chunks, pa.int32()), "block": pa.array([sent["part"][0].as_py()] * len(bits), pa.int32()),
                     "bits": pa.array(bits, pa.binary())})


def window_dedup(docs: DataFrame, width: int = WIDTH, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): ``kept`` joins the words that stay by one space."""
    plain = document_columns(docs)
    n_bytes = text_bytes(plain)
    grouped, _ = chunked(plain, n_bytes, chunk_bytes)
    bits = sketch_bits(n_bytes)
    part_bits = max(0, bits - 24)

    def sketch(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
        return sketch_rows(_Chunk(found, width).keys, key[0].as_py(), bits)

    def keys(key: tuple[pa.Scalar, ...], found: pa.Table, told: pa.Table) -> pa.Table:
        held = _Chunk(found, width)
        high, low, first, _ = held.distinct(np.flatnonzero(estimated_repeated(held.keys, _answered(told, 0), bits)))
        docs_ = held.docs[first]
        parts = list(_parts(high, part_bits))
        return pa.table({"part": pa.array([p for p, _ in parts], pa.int32()), "chunk": pa.array([key[0].as_py()] * len(parts), pa.int32()),
                         **{name: pa.array([x[s].tobytes() for _, s in parts], pa.binary())
                            for name, x in (("high", high), ("low", low), ("docs", docs_))}})

    def cut(key: tuple[pa.Scalar, ...], found: pa.Table, told: pa.Table) -> pa.Table:
        held = _Chunk(found, width)
        maybe = np.flatnonzero(estimated_repeated(held.keys, _answered(told, 0), bits))
        high, _, first, which = held.distinct(maybe)
        owns = np.zeros(len(high), bool)
        answered = _answered(told, 1)
        for part, at in _parts(high, part_bits):
            owns[at] = np.unpackbits(np.frombuffer(answered[part], np.uint8))[:at.stop - at.start].astype(bool)
        again = maybe[~(owns[which] & (first[which] == maybe))]
        edges = np.zeros(held.starts[-1] + 1, np.int32)
        edges[held.at[again]] += 1
        edges[held.at[again] + width] -= 1  # starts are distinct, so no entry is hit twice in one step
        stays = np.cumsum(edges[:-1]) == 0
        sizes, kept = np.diff(held.starts), []
        for words, a, b in zip(held.words, held.starts[:-1], held.starts[1:]):
            kept.append(b" ".join(words if stays[a:b].all() else compress(words, stays[a:b])).decode())
        left = np.add.reduceat(np.append(stays, 0), held.starts[:-1]) * (sizes > 0) if len(sizes) else sizes
        return pa.table({"doc_id": pa.array(held.ids, pa.int64()), "n_words": pa.array(sizes), "n_removed": pa.array(sizes - left),
                         "kept": pa.array(kept, pa.string())})

    repeated = answers(grouped.groupBy("chunk").applyInArrow(sketch, CELLS)).withColumn("kind", F.lit(0))
    sent = grouped.groupBy("chunk").cogroup(repeated.groupBy("chunk")).applyInArrow(keys, KEYS)
    owned = sent.groupBy("part").applyInArrow(first_of_all, ANSWERS).withColumn("kind", F.lit(1))
    return grouped.groupBy("chunk").cogroup(repeated.unionByName(owned).groupBy("chunk")).applyInArrow(cut, KEPT)


def op2_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = rf"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, w, unnest(range(1, len(w) - {WIDTH} + 2)) as i from d where len(w) >= {WIDTH}),
h as (select doc_id, i, row_number() over (partition by array_to_string(w[i:i + {WIDTH - 1}], ' ') order by doc_id, i) > 1 as again from s),
c as (select distinct doc_id, unnest(range(i, i + {WIDTH})) as i from h where again),
g as (select doc_id, list(i) as gone from c group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(len(gone), 0)::bigint as n_removed,
  sha256(coalesce(array_to_string(list_filter(w, lambda x, i: not list_contains(coalesce(gone, []), i)), ' '), '')) as kept_sha256
from d left join g on g.doc_id = d.doc_id"""
