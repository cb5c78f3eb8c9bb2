"""Exact top-k search by the threshold algorithm.

A block of vectors keeps, for each dimension, its row numbers sorted by that component.
A query walks the lists from the end that suits the sign of its own component, scores
every row it meets for the first time, and stops when the sum of the products at the
depths reached, the best that any row not yet met can score, is below its kth result.
Results of earlier blocks of a task count for the later ones, so a block that cannot hold a
better row is left at once.

Vectors stay where they are: queries come in batches of bounded bytes, and each batch is
broadcast to one scan of the vectors. Only the k best of each query leave a task.

Defined cases: vectors that are null, empty or hold a null or non-finite component, and
rows without an id, take no part; a query meets only vectors of its own length, and no row with its
own id; equal rows are separate candidates; ties go to the smaller id; components are
clipped to 64 bits and a score beyond 64 bits wraps. No queries or an empty table give an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakesearch.functions.numbering import numbered
from lakesearch.llm.common import table
from lakesearch.session import staged

BLOCK_ROWS = 4096
BATCH_BYTES = 16 << 20
FIRST_DEPTH = 16
SCALE = 1024


def quantized(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
              scale: int = SCALE) -> DataFrame:
    """(vec_id, v): components as floor(scale * x), vectors that take no part left out."""
    x = F.col("x").cast("array<double>")
    odd = F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x"))
            .withColumn("x", x).where("vec_id is not null and x is not null and size(x) > 0").where(~odd)
            .select("vec_id", F.transform("x", lambda e: F.floor(e * scale).cast("long")).alias("v")))


def _matrices(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) for each vector length in the batch."""
    ids = batch.column("vec_id").to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) else batch["vec_id"].to_numpy()
    lists = batch.column("v") if isinstance(batch, pa.RecordBatch) else batch["v"].combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], pa.list_(pa.int64()))
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield ids[rows], flat[starts[rows][:, None] + np.arange(size)]


class _Block:
    """Rows of one length with their sorted lists."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids = ids
        self.order = np.argsort(values, axis=0, kind="stable")
        self.sorted = np.take_along_axis(values, self.order, axis=0)
        self.largest = float(np.abs(values).max())
        self.values = values
        self.floats = values.astype(np.float64) if self.largest < 2**26 else None

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Integer products; in floats only where those are exact."""
        if self.floats is not None and self.largest * float(np.abs(query).max()) * len(query) < 2**53:
            return (self.floats[rows] @ query.astype(np.float64)).astype(np.int64)
        return self.values[rows] @ query

    def search(self, query_id: int, query: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best (scores, ids) of ``best`` and this block."""
        n = len(self.ids)
        used = np.flatnonzero(query)
        weights = query[used].astype(object) if float(np.abs(query).max()) * self.largest * len(query) >= 2**62 else query[used]
        falling = query[used] > 0
        seen = np.zeros(n, bool)
        start, depth = 0, 0
        scores, ids = best
        while True:
            edge = np.where(falling, n - 1 - max(depth - 1, 0), max(depth - 1, 0))
            bound = (weights * self.sorted[edge, used]).sum()
            if (len(scores) == k and scores[-1] > bound) or start >= n:
                return scores, ids
            depth = n if not len(used) else min(n, max(FIRST_DEPTH, depth * 4))
            steps = np.arange(start, depth)
            met = self.order[np.where(falling, n - 1 - steps[:, None], steps[:, None]), used] if len(used) else np.arange(n)
            fresh = np.zeros(n, bool)
            fresh[met.ravel()] = True
            rows = np.flatnonzero(fresh & ~seen & (self.ids != query_id))
            seen |= fresh
            if len(rows):
                scores, ids = _best(np.concatenate((scores, self.scores(rows, query))), np.concatenate((ids, self.ids[rows])), k)
            start = depth


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(scores) > k:
        near = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, ids = scores[near], ids[near]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def top_k(vectors: DataFrame, queries: DataFrame, k: int, block_rows: int = BLOCK_ROWS,
          batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score) of ``queries`` against ``vectors``, both quantized."""
    spark = vectors.sparkSession
    vectors = staged(vectors, "vectors")
    asked = staged(numbered(queries.withColumn("all", F.lit(0)), ["all"], ["vec_id"]), "queries")
    count, longest = asked.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    step = max(1, batch_bytes // (8 * (longest or 1)))
    parts = [_search_batch(vectors, spark.sparkContext.broadcast(
        list(_matrices(asked.where((F.col("position") >= at) & (F.col("position") < at + step)).select("vec_id", "v").toArrow()))), k, block_rows)
        for at in range(0, count, step)]
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = parts[0] if len(parts) == 1 else _union(parts)
    place = Window.partitionBy("query_id", "asked").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _union(parts: list[DataFrame]) -> DataFrame:
    """Each batch written on its own, so that one scan runs at a time."""
    out = staged(parts[0], "found")
    for part in parts[1:]:
        out = out.unionByName(staged(part, "found"))
    return out


def _search_batch(vectors: DataFrame, queries, k: int, block_rows: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = [(int(i), q) for ids, matrix in queries.value for i, q in zip(ids, matrix)]
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        best = [none] * len(asked)
        for block in _blocks(batches, block_rows):
            for ids, values in _matrices(block):
                held = _Block(ids, values)
                for at, (query_id, query) in enumerate(asked):
                    if len(query) == values.shape[1]:
                        best[at] = held.search(query_id, query, best[at], k)
        for at in range(0, len(asked), 1024):
            some = [(asked[i][0], i, *best[i]) for i in range(at, min(at + 1024, len(asked))) if len(best[i][0])]
            if some:
                sizes = [len(s) for _, _, s, _ in some]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(np.array([q for q, *_ in some], np.int64), sizes)),
                    pa.array(np.repeat(np.array([i for _, i, *_ in some], np.int64), sizes)),
                    pa.array(np.concatenate([v for *_, v in some])), pa.array(np.concatenate([s for *_, s, _ in some]))],
                    names=["query_id", "asked", "vec_id", "score"])

    return vectors.select("vec_id", "v").mapInArrow(run, "query_id long, asked long, vec_id long, score long")


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantized(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 100 = 0"), 10)


SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as q from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as query_id, b.vec_id as vec_id,
    list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::bigint as score
  from v a join v b on a.vec_id <> b.vec_id and len(a.q) = len(b.q) where a.vec_id % 100 = 0)
select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score
from s qualify rank <= 10"""
