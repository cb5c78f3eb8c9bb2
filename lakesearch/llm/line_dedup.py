"""Line dedup with sharded cuckoo filters backed by exact reference counts.

The state of an incremental line dedup is a ``LineIndex`` of two tables:

* ``refs`` (key_hash, key, doc_id, lines): the exact reference counts, how many lines of
  each document hold each key. Keys shorter than ``MIN_CHARS`` are never counted.
* ``filters`` (shard, buckets, slots): one cuckoo filter a shard, holding 16-bit
  fingerprints of the *frequent* keys, those of ``MIN_DOCS`` documents or more. A shard is
  ``key_hash`` modulo the number of shards, sized so that a filter holds about
  ``SHARD_KEYS`` keys.

``insert`` adds the counts of new documents and ``delete`` takes away those of removed ones;
both are exact, so deleting what was inserted gives back the index before, and the cuckoo
filters follow: fingerprints of keys that became frequent are inserted, those of keys that
stopped being frequent are deleted (a Bloom filter could not). A shard whose filter cannot
take an insertion is rebuilt at twice the size from the counts.

``dedup`` decides the lines of documents: the (document, key) pairs of long lines go to the
filter of their shard, which lets through only keys that may be frequent; only those are
joined with the exact table, and a line goes if its key is frequent and its document is not
the largest id holding the key. The probe rows are narrow (id and hash); a shard that holds a
hot key is split by a salt sized from its rows, with its filter sent to every part.

Defined cases: a null or empty text is one empty line; a null ``doc_id`` is not counted as
a document of a key, and its lines of frequent keys go; equal rows count as one document
for a key and get equal results; very long lines and texts are split like others (a line is
one column value); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakesearch.llm.common import document_columns, table
from lakesearch.llm.words import mixed
from lakesearch.session import staged

# Fixed values of the contract.
BLANKS = "[\\x20\\x09-\\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 20
MIN_DOCS = 3

#: Frequent keys a shard's filter is sized for.
SHARD_KEYS = 1 << 16
#: Probe rows (16 bytes each) one task holds with its filter.
PROBE_ROWS = 1 << 20
SLOTS = 4
#: Largest share of slots in use when a filter is built.
LOAD = 0.5
MAX_KICKS = 500

_FILTER = "shard long, buckets long, slots binary, full boolean"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    stripped = F.regexp_replace(line, f"\\A{BLANKS}+|{BLANKS}+\\z", "")
    return F.translate(stripped, UPPER, LOWER)


def keyed_pairs(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, key, key_hash, lines): long keys of each document with their number of lines."""
    lines = document_columns(docs).select("doc_id", F.explode(lines_of(F.col("text"))).alias("line"))
    keyed = lines.select("doc_id", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    return (keyed.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("lines"))
            .withColumn("key_hash", F.xxhash64("key")))


def _parts(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint (never 0) and the two buckets of each 64-bit key hash."""
    h = hashes.astype(np.uint64)
    fp = ((h >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.uint16)
    fp[fp == 0] = 1
    mask = np.uint64(buckets - 1)
    first = (h >> np.uint64(32)) & mask
    second = first ^ (mixed(fp.astype(np.uint64)) & mask)
    return fp, first.astype(np.int64), second.astype(np.int64)


class Cuckoo:
    """A cuckoo filter: ``buckets`` (a power of two) rows of ``SLOTS`` 16-bit fingerprints."""

    def __init__(self, buckets: int, slots: np.ndarray | None = None):
        self.buckets = buckets
        self.slots = np.zeros((buckets, SLOTS), np.uint16) if slots is None else slots.reshape(buckets, SLOTS).copy()

    @staticmethod
    def size_for(n: int, load: float = LOAD) -> int:
        return 1 << max(0, math.ceil(math.log2(max(1, n) / (SLOTS * load))))

    def insert(self, hashes: np.ndarray) -> bool:
        """Insert each hash; False if one found no place (the filter is then unusable)."""
        fps, firsts, seconds = _parts(hashes, self.buckets)
        rng = np.random.default_rng(len(hashes))
        for fp, i, j in zip(fps.tolist(), firsts.tolist(), seconds.tolist()):
            placed = False
            for b in (i, j):
                free = np.flatnonzero(self.slots[b] == 0)
                if free.size:
                    self.slots[b, free[0]] = fp
                    placed = True
                    break
            b = i if rng.random() < 0.5 else j
            for _ in range(0 if placed else MAX_KICKS):
                s = int(rng.integers(SLOTS))
                fp, self.slots[b, s] = int(self.slots[b, s]), fp
                b = int((b ^ int(mixed(np.array([fp], np.uint64))[0])) & (self.buckets - 1))
                free = np.flatnonzero(self.slots[b] == 0)
                if free.size:
                    self.slots[b, free[0]] = fp
                    placed = True
                    break
            if not placed:
                return False
        return True

    def delete(self, hashes: np.ndarray) -> None:
        """Take one copy of each hash's fingerprint out of one of its buckets."""
        fps, firsts, seconds = _parts(hashes, self.buckets)
        for fp, i, j in zip(fps.tolist(), firsts.tolist(), seconds.tolist()):
            for b in (i, j):
                found = np.flatnonzero(self.slots[b] == fp)
                if found.size:
                    self.slots[b, found[0]] = 0
                    break

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        fps, firsts, seconds = _parts(hashes, self.buckets)
        return ((self.slots[firsts] == fps[:, None]).any(1)) | ((self.slots[seconds] == fps[:, None]).any(1))

    def row(self, shard: int, full: bool = False) -> dict:
        return {"shard": shard, "buckets": self.buckets, "slots": self.slots.tobytes(), "full": full}


def _unpack(rows: pd.DataFrame) -> Cuckoo | None:
    if rows.empty:
        return None
    first = rows.iloc[0]
    return Cuckoo(int(first.buckets), np.frombuffer(first.slots, np.uint16))


def _build(frame: pd.DataFrame) -> pd.DataFrame:
    hashes = frame.key_hash.to_numpy(np.int64)
    buckets = Cuckoo.size_for(len(hashes))
    while True:
        cuckoo = Cuckoo(buckets)
        if cuckoo.insert(hashes):
            return pd.DataFrame([cuckoo.row(int(frame.shard.iloc[0]))])
        buckets *= 2


def _update(old: pd.DataFrame, change: pd.DataFrame) -> pd.DataFrame:
    cuckoo = _unpack(old)
    shard = int((old if not old.empty else change).shard.iloc[0])
    gone, added = change[~change.frequent], change[change.frequent]
    if cuckoo is None:
        cuckoo = Cuckoo(Cuckoo.size_for(len(added)))
    cuckoo.delete(gone.key_hash.to_numpy(np.int64))
    return pd.DataFrame([cuckoo.row(shard, not cuckoo.insert(added.key_hash.to_numpy(np.int64)))])


def _probe(pairs: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    cuckoo = _unpack(filters)
    if cuckoo is None or pairs.empty:
        return pairs.iloc[:0][["doc_id", "key_hash"]]
    return pairs[cuckoo.contains(pairs.key_hash.to_numpy(np.int64))][["doc_id", "key_hash"]]


def _frequent(refs: DataFrame, min_docs: int) -> DataFrame:
    """(key_hash, key, top): keys of ``min_docs`` documents or more, and their largest id."""
    return (refs.where(F.col("doc_id").isNotNull()).groupBy("key_hash", "key")
            .agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("top"))
            .where(F.col("n_docs") >= min_docs).drop("n_docs"))


@dataclass
class LineIndex:
    refs: DataFrame
    frequent: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int = MIN_DOCS
    min_chars: int = MIN_CHARS

    @staticmethod
    def build(docs: DataFrame, shards: int | None = None, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> LineIndex:
        """An index of ``docs``; ``shards`` from the number of frequent keys if not given."""
        refs = staged(keyed_pairs(docs, min_chars), "line-refs")
        frequent = staged(_frequent(refs, min_docs), "line-frequent")
        if shards is None:
            shards = max(1, -(-frequent.count() // SHARD_KEYS))
        sharded = frequent.select(F.pmod("key_hash", F.lit(shards)).alias("shard"), "key_hash")
        filters = staged(sharded.groupBy("shard").applyInPandas(_build, _FILTER), "line-filters")
        return LineIndex(refs, frequent, filters, shards, min_docs, min_chars)

    def _changed(self, refs: DataFrame) -> LineIndex:
        """The index with ``refs``; filters follow the keys whose frequency changed."""
        frequent = staged(_frequent(refs, self.min_docs), "line-frequent")
        before = self.frequent.select("key_hash", "key", F.lit(True).alias("was"))
        after = frequent.select("key_hash", "key", F.lit(True).alias("is"))
        change = (before.join(after, ["key_hash", "key"], "full")
                  .where(F.col("was").isNull() | F.col("is").isNull())
                  .select(F.pmod("key_hash", F.lit(self.shards)).alias("shard"), "key_hash", F.col("is").isNotNull().alias("frequent")))
        touched = change.select("shard").distinct()
        kept = self.filters.join(touched, "shard", "left_anti")
        updated = staged(self.filters.join(touched, "shard").groupBy("shard")
                         .cogroup(change.groupBy("shard")).applyInPandas(_update, _FILTER), "line-filters")
        full = updated.where("full").select("shard")
        rebuilt = (frequent.select(F.pmod("key_hash", F.lit(self.shards)).alias("shard"), "key_hash")
                   .join(full, "shard").groupBy("shard").applyInPandas(_build, _FILTER))
        filters = staged(kept.unionByName(updated.where("not full")).unionByName(rebuilt), "line-filters")
        return LineIndex(refs, frequent, filters, self.shards, self.min_docs, self.min_chars)

    def insert(self, docs: DataFrame) -> LineIndex:
        added = keyed_pairs(docs, self.min_chars)
        both = self.refs.unionByName(added).groupBy("doc_id", "key", "key_hash").agg(F.sum("lines").alias("lines"))
        return self._changed(staged(both.select("doc_id", "key", "lines", "key_hash"), "line-refs"))

    def delete(self, docs: DataFrame) -> LineIndex:
        """Take out the counts of ``docs`` (rows as they were inserted)."""
        gone = keyed_pairs(docs, self.min_chars).select("doc_id", "key", "key_hash", (-F.col("lines")).alias("lines"))
        both = (self.refs.unionByName(gone).groupBy("doc_id", "key", "key_hash").agg(F.sum("lines").alias("lines"))
                .where(F.col("lines") > 0))
        return self._changed(staged(both.select("doc_id", "key", "lines", "key_hash"), "line-refs"))

    def maybe_frequent(self, pairs: DataFrame) -> DataFrame:
        """(doc_id, key_hash) of ``pairs`` whose key the filters may hold."""
        sharded = pairs.select("doc_id", "key_hash", F.pmod("key_hash", F.lit(self.shards)).alias("shard"))
        salts = sharded.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(PROBE_ROWS)).cast("long").alias("salts"))
        salted = sharded.join(salts.alias("a"), "shard").select(
            "shard", "doc_id", "key_hash", F.pmod(F.xxhash64("doc_id", "key_hash"), F.col("a.salts")).alias("salt"))
        copies = self.filters.join(salts.alias("b"), "shard").select(
            "shard", "buckets", "slots", F.explode(F.sequence(F.lit(0).cast("long"), F.col("b.salts") - 1)).alias("salt"))
        return (salted.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt"))
                .applyInPandas(_probe, "doc_id long, key_hash long"))

    def dropped_keys(self, docs: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
        """(doc_id, keys): for each document, the frequent keys of which it loses its lines.

        ``pairs`` (doc_id, key_hash) of ``docs`` may be given where they are known, as for
        the documents of the index itself.
        """
        if pairs is None:
            pairs = keyed_pairs(docs, self.min_chars).select("doc_id", "key_hash").distinct()
        hits = self.maybe_frequent(pairs)
        lost = (hits.join(self.frequent, "key_hash")
                .where(~F.col("doc_id").eqNullSafe(F.col("top"))))
        return lost.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))

    def dedup(self, docs: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
        """doc_id, n_lines, n_dropped, kept_sha256 and ``kept`` (the text left) per row of ``docs``."""
        own = document_columns(docs)
        lost = staged(self.dropped_keys(own, pairs), "line-dropped")
        joined = own.alias("d").join(lost.alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")), "left")
        lines = lines_of(F.col("d.text"))
        keys = F.coalesce(F.col("k.keys"), F.array().cast("array<string>"))
        kept = F.filter(lines, lambda line: ~F.array_contains(keys, line_key(line)))
        out = joined.select(F.col("d.doc_id").alias("doc_id"), lines.alias("lines"), kept.alias("kept_lines"))
        return out.select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                          (F.size("lines") - F.size("kept_lines")).cast("long").alias("n_dropped"),
                          F.array_join("kept_lines", "\n").alias("kept"),
                          F.sha2(F.array_join("kept_lines", "\n"), 256).alias("kept_sha256"))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    index = LineIndex.build(docs, min_docs=min_docs, min_chars=min_chars)
    return index.dedup(docs, index.refs.select("doc_id", "key_hash"))


def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).drop("kept")


SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls, row_number() OVER () AS rid FROM documents),
l AS (SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM f.top AS dropped FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id
"""
