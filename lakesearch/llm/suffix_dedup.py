"""Suffix-array dedup of byte strings by deep-shallow sorting.

Each byte covered by a ``width``-byte string that also starts in a document of smaller id
goes; overlaps count, and strings are judged on the input.

Suffixes are sorted where equal ones meet. A window of ``width`` bytes belongs to the least hash
among its ``GRAM``-byte grams, so equal windows belong to equal hashes; neighbouring windows mostly
share theirs and form a run, which travels as one stretch of bytes. A merged count-min
sketch (``sketch.py``) of the runs' hashes drops runs that occur once, losing none that repeats. The
rest goes by hash to parts of bounded size, where all suffixes of the stretches are sorted:
multikey quicksort, on four bytes at a time, to depth ``SHALLOW``; then groups that still agree
are ordered by blind tries, which compare each suffix in full with one leaf only. Suffixes that end in the
same leaf are equal; all but those of the least document are repeats.

Text is shuffled once, by chunk. Whole copies of a text are found first, by MD5, and only
the one of least id is sorted. Of equal stretches of a chunk one travels, so a passage that a
third of all documents share is one stretch per chunk. Runs at the edges of such a passage carry each document's
own bytes, so their stretches differ and their hash may have as many as there are documents. A hash with more than
``CROWD`` different stretches in all chunks is crowded: its windows travel one by one, of equal ones in a chunk one,
to the part of their own 50 bytes, where equal windows still meet. Chunks find crowded hashes by telling the sketch how many
stretches a hash has, unless one, or so few that all chunks together stay below half of ``CROWD``.

Defined cases: a null text is empty; texts shorter than ``width`` lose nothing; rows without id count as larger
than all ids and lose nothing to each other; rows of equal id lose nothing to each other; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakesearch.llm.common import chunked, table
from lakesearch.llm.sketch import ANSWERS, CELLS, answers, crowd_rows, estimated_crowded, estimated_repeated, sketch_bits, sketch_rows
from lakesearch.llm.words import mixed, window_hashes
from lakesearch.session import staged

WIDTH = 50
GRAM = 20
SHALLOW = 16
CHUNK_BYTES = 4 << 20
CROWD = 1 << 14
SLAB = 1 << 19
LAST = np.iinfo(np.int64).max

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BYTE = mixed(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93))

#: Stretches of a chunk for a part: windows in each, document of each, and their bytes.
RUNS = "part int, chunk int, sizes binary, docs binary, bytes binary"
KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, starts array<long>, ends array<long>, kept binary"


def window_minima(data: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> np.ndarray:
    """Least gram hash of each window of ``data``."""
    hashes = window_hashes(_BYTE[data], gram, _BASE)
    grams, size = width - gram + 1, 1
    while size * 2 <= grams:
        hashes = np.minimum(hashes[:-size], hashes[size:]) if len(hashes) > size else hashes[:0]
        size *= 2
    if size < grams:
        hashes = np.minimum(hashes[:size - grams], hashes[grams - size:]) if len(hashes) > grams - size else hashes[:0]
    return hashes


class _Chunk:
    """Texts of a chunk and the runs of their windows; whole copies have no runs."""

    def __init__(self, docs: pa.Table, told: pa.Table, width: int):
        copies: dict[int, set[str]] = {}
        for kind, doc, digest in zip(*(told[c].to_pylist() for c in ("kind", "doc", "digest"))):
            if kind == 2:
                copies.setdefault(doc, set()).add(digest)
        rows = sorted((LAST if d is None else d, (t or "").encode(), i) for i, (d, t) in enumerate(zip(docs["doc_id"].to_pylist(), docs["text"].to_pylist())))
        self.width, self.texts, self.ids = width, [t for _, t, _ in rows], np.array([d for d, _, _ in rows], np.int64)
        self.row = [i for *_, i in rows]
        self.copy = [d in copies and hashlib.md5(t).hexdigest() in copies[d] for d, t, _ in rows]
        at, size, starts, ends, values, owners = 0, 0, [], [], [], []
        for i in range(len(rows) + 1):  # documents are hashed together, a slab at a time
            if i == len(rows) or size + len(self.texts[i]) > SLAB and size:
                found = self._runs(range(at, i))
                for into, x in zip((owners, starts, ends, values), found):
                    into.append(x)
                at, size = i, 0
            if i < len(rows):
                size += len(self.texts[i])
        join = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, kind)
        self.owner, self.start, self.end, self.value = join(owners, np.int64), join(starts, np.int64), join(ends, np.int64), join(values, _U)

    def _runs(self, some: range) -> tuple[np.ndarray, ...]:
        """(document, first window, end window, hash) of the runs of some documents."""
        used = [i for i in some if not self.copy[i] and len(self.texts[i]) >= self.width]
        none = np.zeros(0, np.int64)
        if not used:
            return none, none, none, np.zeros(0, _U)
        least = window_minima(np.frombuffer(b"".join(self.texts[i] for i in used), np.uint8), self.width)
        sizes = np.array([len(self.texts[i]) for i in used], np.int64)
        begin = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        change = np.zeros(len(least) + 1, bool)
        change[1:-1] = least[1:] != least[:-1]
        change[begin] = True
        change[begin + sizes - self.width + 1] = True  # the end of a document's own windows
        cuts = np.flatnonzero(change)
        if cuts[-1] != len(least):
            cuts = np.append(cuts, len(least))
        first, end = cuts[:-1], cuts[1:]
        of = np.searchsorted(begin, first, side="right") - 1
        inside = first - begin[of] <= sizes[of] - self.width
        first, end, of = first[inside], end[inside], of[inside]
        return np.array(used, np.int64)[of], first - begin[of], end - begin[of], least[first]

    def crowds(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, numbers) of the hashes with more than ``least`` different stretches."""
        values, which, n = np.unique(self.value, return_inverse=True, return_counts=True)
        runs = np.flatnonzero((n > least)[which])
        seen: dict[int, set[bytes]] = {}
        for key, doc, a, b in zip(which[runs].tolist(), self.owner[runs].tolist(), self.start[runs].tolist(), self.end[runs].tolist()):
            seen.setdefault(key, set()).add(self.texts[doc][a:b + self.width - 1])
        many = sorted(k for k, x in seen.items() if len(x) > least)
        return values[many], np.array([len(seen[k]) for k in many], np.int64)

    def _alone(self, crowded: np.ndarray) -> np.ndarray:
        """Cuts the runs of crowded hashes into single windows; tells which runs these are."""
        sizes = np.where(crowded, self.end - self.start, 1)
        before = np.cumsum(sizes) - sizes
        self.owner, self.value, crowded = (np.repeat(x, sizes) for x in (self.owner, self.value, crowded))
        self.start = np.repeat(self.start, sizes) + np.arange(sizes.sum()) - np.repeat(before, sizes)
        self.end = np.where(crowded, self.start + 1, np.repeat(self.end, sizes))
        return crowded

    def stretches(self, told: pa.Table, bits: int, part_bits: int):
        """Runs that may repeat, ordered by part; for each the stretch that stands for it."""
        answered = {b: x for k, b, x in zip(*(told[c].to_pylist() for c in ("kind", "block", "bits"))) if k == 0}
        repeated, crowded = estimated_repeated(self.value, answered, bits), estimated_crowded(self.value, answered, bits)
        if crowded.any():
            repeated = np.repeat(repeated, np.where(crowded, self.end - self.start, 1))
            crowded = self._alone(crowded)
        maybe = np.flatnonzero(repeated)
        place = self.value[maybe]
        own = np.flatnonzero(crowded[maybe])
        for n, doc, a in zip(own.tolist(), self.owner[maybe[own]].tolist(), self.start[maybe[own]].tolist()):
            place[n] = xxhash.xxh3_64_intdigest(self.texts[doc][a:a + self.width])
        part = (mixed(place) >> _U(64 - part_bits)).astype(np.int64) if part_bits else np.zeros(len(maybe), np.int64)
        order = np.argsort(part, kind="stable")  # within a part still by document
        maybe, part = maybe[order], part[order]
        seen: dict[bytes, int] = {}
        stands, kept, data = np.empty(len(maybe), np.int64), [], []
        for n, (doc, a, b) in enumerate(zip(self.owner[maybe].tolist(), self.start[maybe].tolist(), self.end[maybe].tolist())):
            stretch = self.texts[doc][a:b + self.width - 1]
            stands[n] = at = seen.setdefault(stretch, len(kept))
            if at == len(kept):
                kept.append(n)
                data.append(stretch)
        kept = np.array(kept, np.int64)
        return maybe, stands, maybe[kept], part[kept], data

    def cut(self, maybe: np.ndarray, stands: np.ndarray, kept: np.ndarray, flags: np.ndarray) -> pa.Table:
        """The texts without their repeats. ``flags`` tell of each window of the ``kept`` runs whether
        it repeats; other runs of ``maybe`` go by the kept run that stands for them."""
        sizes = (self.end - self.start)[kept]
        before = np.concatenate(([0], np.cumsum(sizes)))
        lengths = (self.end - self.start)[maybe]
        first = self.ids[self.owner[maybe]] == self.ids[self.owner[kept[stands]]]  # else its own chunk has a smaller document
        steps = np.arange(lengths.sum()) - np.repeat(np.concatenate(([0], np.cumsum(lengths)))[:-1], lengths)
        gone = flags[np.repeat(before[stands], lengths) + steps] | ~np.repeat(first, lengths)
        n = np.array([len(t) for t in self.texts], np.int64)
        begin = np.concatenate(([0], np.cumsum(n)))
        windows = (np.repeat(begin[self.owner[maybe]] + self.start[maybe], lengths) + steps)[gone]
        edges = np.zeros(begin[-1] + 1, np.int32)
        edges[windows] += 1
        edges[windows + self.width] -= 1
        out = np.cumsum(edges[:-1]) > 0
        rows: dict[str, list] = {c: [] for c in ("n_removed", "starts", "ends", "kept")}
        for i, text in enumerate(self.texts):
            if self.copy[i]:
                spans = np.array([0, len(text)])
            else:
                mask = np.zeros(len(text) + 2, np.int8)
                mask[1:-1] = out[begin[i]:begin[i + 1]]
                spans = np.flatnonzero(np.diff(mask))
            a, b = spans[::2], spans[1::2]
            edge = [0, *spans.tolist(), len(text)]
            rows["n_removed"].append(int((b - a).sum()))
            rows["starts"].append(a)
            rows["ends"].append(b)
            rows["kept"].append(b"".join(text[x:y] for x, y in zip(edge[::2], edge[1::2])))
        ids = pa.array([None if d == LAST else int(d) for d in self.ids], pa.int64())
        return pa.table({"doc_id": ids, "n_bytes": pa.array(n), "n_removed": pa.array(rows["n_removed"], pa.int64()),
                         "n_spans": pa.array([len(x) for x in rows["starts"]], pa.int64()), "starts": pa.array(rows["starts"], pa.list_(pa.int64())),
                         "ends": pa.array(rows["ends"], pa.list_(pa.int64())), "kept": pa.array(rows["kept"], pa.binary())})


def _cuts(part: np.ndarray):
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(part)])) if len(part) else [0]
    return [(int(part[a]), int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:])]


class BlindTrie:
    """Orders strings of one length that share a prefix. An inner node knows the depth at which its
    strings part, and a child for each byte there; a leaf the strings that are equal."""

    def __init__(self, first: bytes):
        self.root: list = [first, [0]]  # a leaf: [string, members]; an inner node: [depth, {byte: node}]

    def insert(self, text: bytes, member: int) -> None:
        node, path = self.root, []
        while isinstance(node[0], int):  # blindly down: bytes between the branches are not looked at
            path.append(node)
            node = node[1].get(text[node[0]]) or next(iter(node[1].values()))
        if node[0] == text:
            node[1].append(member)
            return
        leaf = node[0]
        common = next(i for i, (x, y) in enumerate(zip(leaf, text)) if x != y)
        parent, node = None, self.root
        for step in path:
            if step[0] >= common:
                break
            parent, node = step, step[1].get(text[step[0]])
            if node is None:
                break
        new: list = [text, [member]]
        if node is not None and isinstance(node[0], int) and node[0] == common:
            node[1][text[common]] = new
        elif node is None:
            parent[1][text[parent[0]]] = new
        else:
            branch = [common, {leaf[common]: node, text[common]: new}]
            if parent is None:
                self.root = branch
            else:
                parent[1][text[parent[0]]] = branch

    def leaves(self) -> list[list[int]]:
        """Members of each leaf, in order of the strings."""
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if isinstance(node[0], int):
                todo += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                out.append(node[1])
        return out


def deep_shallow_sort(data: bytes, at: np.ndarray, width: int = WIDTH, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): the suffixes of ``data`` at ``at``, each read to ``width`` bytes, in order, and
    where in that order a string differs from the one before."""
    padded = data + bytes(8)
    eight = np.ndarray((len(data) + 1,), ">u8", padded, strides=(1,))
    four = np.ndarray((len(data) + 5,), ">u4", padded, strides=(1,))
    order = np.argsort(eight[at].astype(_U))
    word = eight[at[order]]
    new = np.ones(len(at), bool)
    new[1:] = word[1:] != word[:-1]
    tied = _tied(new)
    for depth in range(8, shallow, 4):  # only suffixes that still agree with a neighbour go on
        group = np.cumsum(new)[tied].astype(_U)
        key = group << _U(32) | four[at[order[tied]] + depth].astype(_U)
        by = np.argsort(key)
        order[tied] = order[tied[by]]
        key = key[by]
        new[tied[1:]] |= key[1:] != key[:-1]
        tied = _tied(new)
    starts = tied[new[tied]]
    if len(starts):
        ends = np.append(starts[1:], 0)
        follow = np.flatnonzero(new)
        ends = np.append(follow, len(at))[np.searchsorted(follow, starts, side="right")]
        leader = np.repeat(starts, ends - starts)
        same = np.ones(len(tied), bool)
        for offset in [*range(shallow, width - 8, 8), width - 8]:
            same &= eight[at[order[tied]] + offset] == eight[at[order[leader]] + offset]
        odd = np.unique(leader[~same])  # groups of more than one leaf
        for a, b in zip(odd.tolist(), ends[np.searchsorted(starts, odd)].tolist()):
            members = order[a:b]
            spots = at[members].tolist()
            trie = BlindTrie(data[spots[0]:spots[0] + width])
            for i, spot in enumerate(spots[1:], 1):
                trie.insert(data[spot:spot + width], i)
            leaves = trie.leaves()
            order[a:b] = members[np.concatenate(leaves)]
            new[a + np.cumsum([len(x) for x in leaves])[:-1]] = True
    return order, new


def _tied(new: np.ndarray) -> np.ndarray:
    """Places in groups of two or more."""
    alone = new.copy()
    alone[:-1] &= new[1:]
    return np.flatnonzero(~alone)


def sort_part(sent: pa.Table, width: int = WIDTH) -> pa.Table:
    """Sorts the suffixes of one part; tells each chunk which of its windows repeat."""
    sizes = [np.frombuffer(x, np.uint32).astype(np.int64) for x in sent["sizes"].to_pylist()]
    windows = np.concatenate(sizes)
    docs = np.repeat(np.frombuffer(b"".join(sent["docs"].to_pylist()), np.int64), windows)
    lengths = windows + width - 1
    begin = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    before = np.concatenate(([0], np.cumsum(windows)))
    at = np.repeat(begin - before[:-1], windows) + np.arange(before[-1])
    order, new = deep_shallow_sort(b"".join(sent["bytes"].to_pylist()), at, width)
    least = np.minimum.reduceat(docs[order], np.flatnonzero(new))
    repeats = np.zeros(len(at), bool)
    repeats[order] = docs[order] > least[np.cumsum(new) - 1]
    cuts = before[np.concatenate(([0], np.cumsum([len(s) for s in sizes])))]
    return pa.table({"chunk": sent["chunk"].combine_chunks(), "block": pa.array([sent["part"][0].as_py()] * len(sizes), pa.int32()),
                     "bits": pa.array([np.packbits(repeats[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())})


def suffix_dedup(docs: DataFrame, width: int = WIDTH, chunk_bytes: int = CHUNK_BYTES, carry: tuple[str, ...] = (),
                 as_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, starts, ends, kept) and the ``carry`` columns: the spans
    removed, as byte offsets, and the bytes that stay; with ``as_text`` as a string, without the characters
    that a span cut in two."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry)
    extra = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields[2:])
    texts = staged(plain.select(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.xxhash64(F.coalesce("doc_id", F.xxhash64("text"))).alias("spread"),
                                F.octet_length("text").cast("long").alias("n"), F.md5("text").alias("digest")), "digests")
    n_bytes = texts.agg(F.sum("n")).first()[0] or 0
    grouped, n_chunks = chunked(plain, n_bytes, chunk_bytes)
    few, half = max(1, CROWD // 2 // n_chunks), CROWD // 2
    bits = sketch_bits(n_bytes)
    part_bits = max(0, bits - 22)
    long = texts.where(F.col("n") >= width)
    firsts = long.groupBy("digest").agg(F.min("doc").alias("first"))
    nothing = {"block": F.lit(None).cast("int"), "bits": F.lit(None).cast("binary"), "doc": F.lit(None).cast("long"), "digest": F.lit(None).cast("string")}
    order = ["chunk", "kind", "block", "bits", "doc", "digest"]
    copies = (long.join(firsts, "digest").where("doc > first").withColumn("chunk", F.pmod("spread", F.lit(n_chunks)).cast("int"))
              .withColumns({"kind": F.lit(2), "block": nothing["block"], "bits": nothing["bits"]}).select(order))

    def as_told(rows: DataFrame, kind: int) -> DataFrame:
        return rows.withColumns({"kind": F.lit(kind), "doc": nothing["doc"], "digest": nothing["digest"]}).select(order)

    def sketch(key: tuple[pa.Scalar, ...], found: pa.Table, told: pa.Table) -> pa.Table:
        held = _Chunk(found, told, width)
        return pa.concat_tables([sketch_rows(held.value, key[0].as_py(), bits), crowd_rows(*held.crowds(few), key[0].as_py(), bits)])

    def runs(key: tuple[pa.Scalar, ...], found: pa.Table, told: pa.Table) -> pa.Table:
        held = _Chunk(found, told, width)
        _, _, kept, part, data = held.stretches(told, bits, part_bits)
        sizes, owners, cuts = (held.end - held.start)[kept].astype(np.uint32), held.ids[held.owner[kept]], _cuts(part)
        return pa.table({"part": pa.array([p for p, _, _ in cuts], pa.int32()), "chunk": pa.array([key[0].as_py()] * len(cuts), pa.int32()),
                         "sizes": pa.array([sizes[a:b].tobytes() for _, a, b in cuts], pa.binary()),
                         "docs": pa.array([owners[a:b].tobytes() for _, a, b in cuts], pa.binary()),
                         "bytes": pa.array([b"".join(data[a:b]) for _, a, b in cuts], pa.binary())})

    def cut(key: tuple[pa.Scalar, ...], found: pa.Table, told: pa.Table) -> pa.Table:
        held = _Chunk(found, told, width)
        maybe, stands, kept, part, _ = held.stretches(told, bits, part_bits)
        answered = {b: x for k, b, x in zip(*(told[c].to_pylist() for c in ("kind", "block", "bits"))) if k == 1}
        sizes = (held.end - held.start)[kept]
        flags = [np.unpackbits(np.frombuffer(answered[p], np.uint8))[:sizes[a:b].sum()] for p, a, b in _cuts(part)]
        out = held.cut(maybe, stands, kept, np.concatenate(flags).astype(bool) if flags else np.zeros(0, bool))
        if as_text:
            texts_ = pa.array([t.decode("utf-8", "ignore") for t in out["kept"].to_pylist()], pa.string())
            out = out.set_column(out.column_names.index("kept"), "kept", texts_)
        for name in carry:
            out = out.append_column(name, found[name].take(pa.array(held.row, pa.int64())))
        return out

    narrow = grouped.select("doc_id", "text", "chunk") if carry else grouped
    sketched = narrow.groupBy("chunk").cogroup(copies.groupBy("chunk")).applyInArrow(sketch, CELLS)
    told = copies.unionByName(as_told(answers(sketched, half), 0))
    sent = narrow.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(runs, RUNS)
    told = told.unionByName(as_told(sent.groupBy("part").applyInArrow(_part_sorter(width), ANSWERS), 1))
    return grouped.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(cut, (KEPT.replace("kept binary", "kept string") if as_text else KEPT) + extra)


def _part_sorter(width: int):
    def run(sent: pa.Table) -> pa.Table:
        return sort_part(sent, width)

    return run


def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
