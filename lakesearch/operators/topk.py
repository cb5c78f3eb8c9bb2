"""Exact top-k by cosine for many probes at once.

Scoring every (probe, vector) pair as rows would put each pair through a sort, and a
join on the scope would send a large scope to one task. Instead the vectors of a scope and its
probes are cut into blocks of at most ``BATCH_BYTES``, and every block of vectors meets every
block of probes in a cell of its own. Cells are shuffled, sorted so that a cell's vectors come
before its probes, and scored where they land: a task holds one block of vectors and passes the
probes by it batch by batch. Nothing is collected or broadcast, and a cell's size does not
depend on the input's. Only the k best of each probe leave a cell; a window merges the cells
where a scope has more than one block of vectors.

Within a cell single precision finds a bound below each probe's k-th best score, and only the
pairs that reach it, less the bound of the rounding error, are scored in double precision. The
result is exact. Scores are made in tiles that fit the cache and passed over once there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lakesearch.functions.similarity import SCORE_DIGITS
from lakesearch.session import shuffle_partitions, staged

BATCH_BYTES = 32 << 20
LEAST_BYTES = 2 << 20
# Scores in memory at once, in single and in double precision; probes scored together, more where they make fewer
# than TILE_CELLS scores.
SCORE_CELLS, DENSE_CELLS, TILE_PROBES, TILE_CELLS = 16 << 20, 4 << 20, 256, 1 << 19
PENDING_ROWS = 200_000
# Columns whose best scores bound a probe's k-th best; pairs scored in double precision at once; pairs, and share of
# all pairs, above which all are scored in double precision.
GROUPS, GATHERED, EXACT_PAIRS, CROWDED = 512, 1024, 1 << 15, 1 / 8

_UNIT = 10 ** SCORE_DIGITS
# More than the range of keys.
_SPAN = 1 << (2 * _UNIT).bit_length()
# Below every key, and still so when negated and back.
_WORST = -np.iinfo(np.int64).max
_ASKED = ["scope", "need", "k", "qvec"]
_VECTOR_ONLY = ["scope", "bits", "embedding"]
_CELL = ["scope", "v_block", "p_block"]


class _Lists:
    """A column of vectors of any lengths."""

    def __init__(self, column: pa.ChunkedArray | pa.Array):
        lists = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
        self.sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        self.flat = lists.flatten().to_numpy(zero_copy_only=False)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def unit_rows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, matrix of unit vectors) of the usable vectors of one length: all numbers finite, not all zero."""
        rows = np.flatnonzero(self.sizes == size)
        values = self.flat[self.starts[rows][:, None] + np.arange(size)].astype(np.float64)
        length = np.sqrt((values * values).sum(axis=1))
        good = np.isfinite(length) & (length > 0)
        return rows[good], values[good] / length[good, None]


def _reaching(rough: np.ndarray, queries: np.ndarray, k: np.ndarray, room: np.ndarray | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Pairs (query, vector) that may be among a query's k best, in order; None if they are too many to score singly.

    The scores are made tile by tile, into ``room`` if there is one, and the best of each column over all tiles is kept
    while a tile is in the cache. Only columns whose best reaches the bound are looked at again.
    """
    n, size = rough.shape
    asked, width = queries.astype(np.float32), min(n, max(GROUPS, 4 * int(k.max())))
    tiles = -(-n // width)
    cells = tiles * len(asked) * width
    scores = (np.empty(cells, np.float32) if room is None else room[:cells]).reshape(tiles, len(asked), width)
    best = np.empty(scores.shape[1:], np.float32)
    for tile in range(tiles):
        part = rough[tile * width:(tile + 1) * width]
        here = scores[tile, :, :len(part)]
        np.matmul(asked, part.T, out=here)
        scores[tile, :, len(part):] = -np.inf
        if tile:
            np.maximum(best[:, :len(part)], here, out=best[:, :len(part)])
        else:
            best[:] = here
    # The best of each column are as many different scores, so the k-th of them is no higher than the k-th of all.
    place = np.maximum(width - k, 0)
    bound = np.where(k > width, -np.inf, np.partition(best, np.unique(place), axis=1)[np.arange(len(k)), place])
    error = (size + 8) * 2.0 ** -24
    least = (bound - 2 * error - 10 / _UNIT).astype(np.float32) - np.float32(2.0 ** -23)
    query, column = np.divmod(np.flatnonzero(best >= least[:, None]), width)
    reached = scores[:, query, column] >= least[query]
    if np.count_nonzero(reached) > max(EXACT_PAIRS, CROWDED * n * len(asked)):
        return None
    tile, place = np.nonzero(reached)
    return np.divmod(np.sort(query[place] * n + tile * width + column[place]), n)


def _dense(exact: np.ndarray, queries: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``_best`` by the scores of all pairs in double precision."""
    n, most = len(exact), min(int(k.max()), len(exact))
    # The position makes keys distinct.
    keys = np.rint(queries @ exact.T * _UNIT).astype(np.int64) * n - np.arange(n)
    top = np.argpartition(keys, n - most, axis=1)[:, n - most:]
    top = np.take_along_axis(top, np.argsort(-np.take_along_axis(keys, top, 1), axis=1), 1)
    query, rank = np.nonzero(np.arange(most)[None, :] < k[:, None])
    vector = top[query, rank]
    return query, vector, -((-keys[query, vector]) // n) / _UNIT, rank


def _best(exact: np.ndarray, rough: np.ndarray, queries: np.ndarray, k: np.ndarray,
          room: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score, rank) of each query's k best, ties to the vector that comes first.

    Scores are compared as whole multiples of the rounding unit.
    """
    pairs = _reaching(rough, queries, k, room)
    if pairs is None:
        step = max(1, DENSE_CELLS // len(exact))
        parts = [(start, _dense(exact, queries[start:start + step], k[start:start + step])) for start in range(0, len(queries), step)]
        query, vector, score, rank = (np.concatenate(column) for column in zip(*(part for _, part in parts)))
        return query + np.repeat([start for start, _ in parts], [len(part[0]) for _, part in parts]), vector, score, rank
    query, vector = pairs
    score = np.empty(len(query))
    for start in range(0, len(query), GATHERED):
        part = slice(start, start + GATHERED)
        score[part] = np.einsum("ij,ij->i", queries.take(query[part], axis=0), exact.take(vector[part], axis=0))
    key = np.rint(score * _UNIT)
    # One number orders by query and falling score, and the sort keeps the order of vectors.
    order = np.argsort(query * _SPAN - key.astype(np.int64), kind="stable")
    query, vector, key = query[order], vector[order], key[order]
    first = np.flatnonzero(np.diff(query, prepend=-1))
    rank = np.arange(len(query)) - np.repeat(first, np.diff(first, append=len(query)))
    kept = rank < k[query]
    return query[kept], vector[kept], key[kept] / _UNIT, rank[kept]


class _Block:
    """The vectors of a cell, in the order of their ids. A probe meets only those of its own length."""

    def __init__(self, pieces: list[pa.Table]):
        table = pa.concat_tables(pieces)
        ids = pa.table({"id": pc.struct_field(table.column("row"), "id")})
        table = table.take(pc.sort_indices(ids, [("id", "ascending")], null_placement="at_start"))
        self.rows = table.column("row").combine_chunks()
        self.bits = table.column("mask").to_numpy()
        self.lists = _Lists(table.column("vec"))
        self.sizes = set(np.unique(self.lists.sizes).tolist())
        self.units: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.offers: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def offered(self, size: int, need: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows, unit vectors, the same in single precision) of one length that have the bits ``need``."""
        if (size, need) not in self.offers:
            if size not in self.units:
                self.units[size] = self.lists.unit_rows(size)
            rows, matrix = self.units[size]
            has = (self.bits[rows] & need) == need
            if not has.all():
                rows, matrix = rows[has], matrix[has]
            self.offers[size, need] = rows, matrix, matrix.astype(np.float32)
        return self.offers[size, need]

    def answers(self, probes: pa.Table) -> Iterator[pa.RecordBatch]:
        asked, pending, waiting = _Lists(probes.column("vec")), [], 0
        need, k, told = probes.column("mask").to_numpy(), probes.column("k").to_numpy(), probes.column("asked").combine_chunks()
        for size in sorted(self.sizes & set(np.unique(asked.sizes).tolist()) - {0}):
            wanted, queries = asked.unit_rows(size)
            for bits in np.unique(need[wanted]):
                mine = np.flatnonzero(need[wanted] == bits)
                rows, exact, rough = self.offered(size, int(bits))
                if not len(rows):
                    continue
                step = min(len(mine), max(1, min(SCORE_CELLS // len(rows), max(TILE_PROBES, TILE_CELLS // len(rows)))))
                # Kept, as fresh memory costs as much as half of the scoring.
                room = np.empty(step * (len(rows) + min(len(rows), max(GROUPS, 4 * int(k.max())))), np.float32)
                for start in range(0, len(mine), step):
                    part = mine[start:start + step]
                    query, vector, score, rank = _best(exact, rough, queries[part], k[wanted[part]], room)
                    pending.append((wanted[part][query], rows[vector], score, rank))
                    waiting += len(query)
                    if waiting > PENDING_ROWS:
                        yield self._out(told, pending)
                        pending, waiting = [], 0
        if waiting:
            yield self._out(told, pending)

    def _out(self, told: pa.Array, pending: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        probe, vector, score, rank = (np.concatenate(column) for column in zip(*pending))
        return pa.RecordBatch.from_arrays([self.rows.take(pa.array(vector)), told.take(pa.array(probe)), pa.array(score),
                                           pa.array((rank + 1).astype(np.int32))], ["row", "asked", "score", "rank"])


def _runs(table: pa.Table) -> np.ndarray:
    """Where rows of another cell or side than the row before begin, and the end."""
    new = np.ones(table.num_rows, dtype=bool)
    scope = table.column("scope")
    new[1:] = pc.not_equal(scope.slice(1), scope.slice(0, table.num_rows - 1)).to_numpy()
    for name in ("v_block", "p_block", "side"):
        new[1:] |= np.diff(table.column(name).to_numpy()) != 0
    return np.append(np.flatnonzero(new), table.num_rows)


def _score_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by place: the vectors of a cell, then its probes. Cells that share a place, which is a hash, come mixed."""
    cells, held, blocks = None, {}, {}
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        starts = _runs(table)
        for start, end in zip(starts[:-1].tolist(), starts[1:].tolist()):
            piece = table.slice(start, end - start)
            here = piece.column("place")[0].as_py() >> 1
            if here != cells:
                cells, held, blocks = here, {}, {}
            cell = tuple(piece.column(name)[0].as_py() for name in _CELL)
            if piece.column("side")[0].as_py() == 0:
                held.setdefault(cell, []).append(piece.select(["row", "mask", "vec"]))
            elif cell in held or cell in blocks:
                if cell not in blocks:
                    blocks[cell] = _Block(held.pop(cell))
                yield from blocks[cell].answers(piece)


def _weight(vector: str) -> Column:
    return F.sum(F.octet_length("scope").cast("long") + 4 * F.size(vector) + 64)


def top_k(vectors: DataFrame, probes: DataFrame, key: list[str]) -> DataFrame:
    """The k best vectors of each probe's scope.

    ``vectors``: scope STRING, id STRING, bits INT, embedding, other columns to carry.
    ``probes``: scope STRING, need INT (bits a vector must have), k INT, qvec, and other
    columns to carry, of which ``key`` names one probe. They are read twice: write them first if they are costly.
    Vectors that are empty, all zeros or hold a null or non-finite number, and pairs of
    different lengths, have no score.
    Returns the carried columns with ``score`` (``SCORE_DIGITS`` digits) and ``rank``.
    """
    spark = vectors.sparkSession
    vectors = vectors.where("size(embedding) > 0 and scope is not null")
    probes = probes.where("size(qvec) > 0 and scope is not null and k > 0")
    plain = [c for c in vectors.columns if c not in _VECTOR_ONLY]
    # A column both sides have (the namespace) is taken from the vector.
    own = [c for c in probes.columns if c not in (*_ASKED, *plain)]
    sizes = staged(vectors.groupBy("scope").agg(_weight("embedding").alias("v_bytes"))
                   .join(probes.groupBy("scope").agg(_weight("qvec").alias("p_bytes")), "scope"), "sizes")
    # Smaller blocks of probes where the whole would make too few cells to go round.
    share = (sizes.agg(F.sum("p_bytes")).first()[0] or 0) // shuffle_partitions(spark)
    blocks = sizes.withColumns({"v_blocks": F.ceil(F.col("v_bytes") / BATCH_BYTES).cast("int"),
                                "p_blocks": F.ceil(F.col("p_bytes") / min(BATCH_BYTES, max(LEAST_BYTES, share))).cast("int")})
    most, cells, size = blocks.agg(F.max("v_blocks"), F.sum(F.col("v_blocks").cast("long") * F.col("p_blocks")), F.sum(
        F.col("v_bytes") * F.col("p_blocks") + F.col("p_bytes") * F.col("v_blocks"))).first()
    blocks = blocks.select("scope", "v_blocks", "p_blocks")
    merged = (most or 0) > 1
    if merged:
        # Written, so that a probe has one number in all its cells. Where every scope is one block, no cells are merged.
        probes = staged(probes.withColumn("probe_no", F.monotonically_increasing_id()), "numbered")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    row = F.struct(*plain)
    asked = F.struct(*([F.col("probe_no"), F.col("k").cast("int").alias("cut")] if merged else []), *own)
    dealt = F.col("probe_no") if merged else F.xxhash64(*key, "qvec")
    stored = vectors.join(blocks, "scope").select(
        "scope", F.pmod(F.monotonically_increasing_id(), "v_blocks").cast("int").alias("v_block"), every("p_blocks").alias("p_block"),
        F.lit(0).alias("side"), F.col("bits").cast("int").alias("mask"), F.lit(0).alias("k"), F.col("embedding").alias("vec"), row.alias("row"))
    posed = probes.join(blocks, "scope").select(
        "scope", every("v_blocks").alias("v_block"), F.pmod(dealt, "p_blocks").cast("int").alias("p_block"),
        F.lit(1).alias("side"), F.col("need").cast("int").alias("mask"), F.col("k").cast("int").alias("k"), F.col("qvec").alias("vec"),
        asked.alias("asked"))
    # One number to sort by: cells apart, and the vectors of a cell before its probes.
    place = F.xxhash64(*_CELL).bitwiseAND(F.lit(-2)).bitwiseOR(F.col("side"))
    both = stored.unionByName(posed, allowMissingColumns=True).withColumn("place", place)
    schema = T.StructType([both.schema["row"], both.schema["asked"], T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())])
    if not cells:
        found = spark.createDataFrame([], schema)
    else:
        # A fixed number of parts: the work of a cell does not show in its bytes.
        parts = min(4 * cells, max(shuffle_partitions(spark), -(-size // BATCH_BYTES)))
        found = both.repartition(parts, *_CELL).sortWithinPartitions("place").mapInArrow(_score_cells, schema)
        if merged:
            order = Window.partitionBy("asked.probe_no").orderBy(F.desc("score"), "row.id")
            found = found.withColumn("rank", F.row_number().over(order)).where("rank <= asked.cut")
    return found.select("row.*", "score", "rank", *[F.col("asked")[c].alias(c) for c in own])
