"""The blocked top-k against brute force, with one batch of probes and with many."""

import numpy as np
import pytest

from lakesearch.operators import topk

DIM, VECTORS, PROBES = 8, 300, 40


def _data():
    rng = np.random.default_rng(7)
    base = rng.normal(size=(VECTORS, DIM)).astype(np.float32)
    base[100:200] = base[100]  # a third of all rows are copies of one vector
    base[5] = 0
    # Two scopes of very different size, plus one without probes.
    scopes = np.where(np.arange(VECTORS) < 250, "big", np.where(np.arange(VECTORS) < 290, "small", "other"))
    vectors = [(scopes[i], f"v{i:03d}", int(i % 4), base[i].tolist()) for i in range(VECTORS)]
    asked = rng.normal(size=(PROBES, DIM)).astype(np.float32)
    asked[0] = base[100]
    probes = [(("big", "small", "empty")[i % 3], i, int(i % 4), 1 + i % 7, asked[i].tolist()) for i in range(PROBES)]
    return vectors, probes


def _brute(vectors, probes):
    found = {}
    for scope, number, need, k, q in probes:
        q = np.array(q, dtype=np.float64)
        scored = []
        for vector_scope, name, bits, v in vectors:
            v = np.array(v, dtype=np.float64)
            if vector_scope == scope and bits & need == need and np.any(v):
                scored.append((-round(float(v @ q / np.linalg.norm(v) / np.linalg.norm(q)), 6), name))
        found[number] = [(n, -s) for s, n in sorted(scored)[:k]]
    return {n: rows for n, rows in found.items() if rows}


@pytest.mark.parametrize("batch_bytes", [64 << 20, 900])
def test_equals_brute_force(spark, monkeypatch, batch_bytes):
    monkeypatch.setattr(topk, "BATCH_BYTES", batch_bytes)
    monkeypatch.setattr(topk, "SCORE_CELLS", 500)
    monkeypatch.setattr(topk, "PENDING_ROWS", 10)
    vectors, probes = _data()
    rows = spark.createDataFrame(vectors, "scope string, id string, bits int, embedding array<float>").repartition(5)
    asked = spark.createDataFrame(probes, "scope string, number bigint, need int, k int, qvec array<float>")
    out = topk.top_k(rows, asked, ["number"]).orderBy("number", "rank").collect()
    got = {}
    for row in out:
        got.setdefault(row.number, []).append((row.id, round(row.score, 6)))
        assert row["rank"] == len(got[row.number])
    want = _brute(vectors, probes)
    assert got.keys() == want.keys()
    for number, found in want.items():
        assert [i for i, _ in got[number]] == [i for i, _ in found]
        assert np.allclose([s for _, s in got[number]], [s for _, s in found], atol=1e-6)


VECTORS_DDL = "scope string, id string, bits int, embedding array<float>"
PROBES_DDL = "scope string, number bigint, need int, k int, qvec array<float>"


def test_lengths_nulls_and_non_finite_numbers(spark):
    rows = spark.createDataFrame([("s", "two", 0, [1.0, 0.0]), ("s", "three", 0, [1.0, 0.0, 0.0]), ("s", "four", 0, [1.0, 0.0, 0.0, 0.0]),
                                  ("s", "null", 0, [1.0, None, 0.0]), ("s", "nan", 0, [1.0, float("nan"), 0.0]), ("s", "zero", 0, [0.0] * 3),
                                  ("s", "empty", 0, []), ("s", "none", 0, None)], VECTORS_DDL)
    asked = spark.createDataFrame([("s", 1, 0, 5, [2.0, 0.0, 0.0]), ("s", 2, 0, 5, [0.0, 1.0]), ("s", 3, 0, 5, [None, 1.0, 0.0])], PROBES_DDL)
    assert [(r.number, r.id, r.score) for r in topk.top_k(rows, asked, ["number"]).orderBy("number").collect()] == [(1, "three", 1.0), (2, "two", 0.0)]


def test_carries_columns_of_any_type(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(topk, "BATCH_BYTES", 200)
    extra = [F.array(F.lit("a"), F.lit("b")).alias("list"), F.struct(F.lit(1).alias("x"), F.lit("y").alias("y")).alias("pair"),
             F.timestamp_seconds(F.lit(0)).alias("at"), F.create_map(F.lit("k"), F.lit(1)).alias("map")]
    rows = spark.createDataFrame([("s", f"v{i}", 0, [1.0, float(i)]) for i in range(9)] + [("t", "w", 0, [1.0, 1.0])], VECTORS_DDL).select("*", *extra)
    asked = spark.createDataFrame([("s", i, 0, 2, [1.0, 1.0]) for i in range(9)] + [("u", 99, 0, 2, [1.0, 1.0])], PROBES_DDL)
    asked = asked.select("*", F.array(F.lit(1)).alias("note"), F.current_date().alias("day"))
    out = topk.top_k(rows, asked, ["number"]).collect()
    assert len(out) == 18 and all(r.list == ["a", "b"] and r.pair.y == "y" and r.map == {"k": 1} and r.note == [1] for r in out)


def test_near_ties_at_the_edge_are_ordered_by_full_score(spark):
    rows = spark.createDataFrame([("s", "a", 0, [1.0, 2e-4]), ("s", "b", 0, [1.0, 1e-4])], VECTORS_DDL)
    asked = spark.createDataFrame([("s", 1, 0, 1, [1.0, 0.0])], PROBES_DDL)
    assert [r.id for r in topk.top_k(rows, asked, ["number"]).collect()] == ["b"]


def test_no_probes_need_no_scan(spark):
    rows = spark.createDataFrame([("s", "a", 0, [1.0])], VECTORS_DDL)
    out = topk.top_k(rows, spark.createDataFrame([], PROBES_DDL), ["number"])
    assert out.collect() == [] and {"number", "id", "score", "rank"} <= set(out.columns)
    assert "ArrowMap" not in out._jdf.queryExecution().toString() and "MapInArrow" not in out._jdf.queryExecution().toString()


def test_nothing_passes_through_the_driver(spark, monkeypatch):
    from pyspark import SparkContext
    from pyspark.sql.classic.dataframe import DataFrame

    def never(*args, **kwargs):
        raise AssertionError("probes or vectors collected or broadcast")

    collect = DataFrame.collect
    for owner, name in ((DataFrame, "toArrow"), (DataFrame, "toPandas"), (SparkContext, "broadcast")):
        monkeypatch.setattr(owner, name, never)
    monkeypatch.setattr(DataFrame, "collect", lambda self: rows if len(rows := collect(self)) < 2 else never())
    vectors, probes = _data()
    out = topk.top_k(spark.createDataFrame(vectors, VECTORS_DDL), spark.createDataFrame(probes, "scope string, number bigint, need int, k int, qvec array<float>"),
                     ["number"])
    assert out.count() == sum(map(len, _brute(vectors, probes).values()))


@pytest.mark.parametrize("crowded", [0, 1])
def test_bound_loses_nothing_among_near_ties(crowded, monkeypatch):
    monkeypatch.setattr(topk, "CROWDED", crowded)
    monkeypatch.setattr(topk, "EXACT_PAIRS", 7 if crowded else 0)
    rng = np.random.default_rng(3)
    exact = np.repeat(rng.normal(size=(40, 16)), 30, axis=0)
    exact[::2] += 1e-9 * rng.normal(size=exact[::2].shape)  # closer than single precision tells apart
    exact /= np.linalg.norm(exact, axis=1)[:, None]
    queries = np.concatenate([exact[:50:7], rng.normal(size=(20, 16))])
    queries /= np.linalg.norm(queries, axis=1)[:, None]
    k = 1 + np.arange(len(queries)) % 11
    query, vector, score, rank = topk._best(exact, exact.astype(np.float32), queries, k)
    for q in range(len(queries)):
        keys = np.rint(exact @ queries[q] * topk._UNIT)
        got = np.rint(score[query == q] * topk._UNIT)
        assert len(got) == k[q] and rank[query == q].tolist() == list(range(k[q]))
        assert np.abs(got - np.sort(keys)[::-1][:k[q]]).max() <= 1 and len(set(vector[query == q])) == k[q]
        assert all(a < b for a, b, x, y in zip(vector[query == q], vector[query == q][1:], got, got[1:]) if x == y)


def _scored(exact, queries, k):
    """Each query's k best by keys, ties to the vector that comes first."""
    keys = np.rint(queries @ exact.T * topk._UNIT)
    return [np.lexsort((np.arange(len(exact)), -row))[:n].tolist() for row, n in zip(keys, k)]


@pytest.mark.parametrize("dense", [False, True])
@pytest.mark.parametrize("vectors", [1, 9, 511, 512, 513, 1024, 1500])
def test_tiles_of_any_size_give_every_best_pair(vectors, dense, monkeypatch):
    if dense:
        monkeypatch.setattr(topk, "EXACT_PAIRS", 0)
        monkeypatch.setattr(topk, "CROWDED", 0)
        monkeypatch.setattr(topk, "DENSE_CELLS", 9 * vectors)
    rng = np.random.default_rng(vectors)
    exact, queries = rng.normal(size=(vectors, 8)), rng.normal(size=(70, 8))
    exact[vectors // 2:] *= -1
    exact[::7] = exact[0]  # ties over all tiles
    exact, queries = (x / np.linalg.norm(x, axis=1)[:, None] for x in (exact, queries))
    k = 1 + np.arange(70) % 12
    k[5], k[6] = vectors, 3 * vectors  # all of them, and more than there are
    query, vector, _, rank = topk._best(exact, exact.astype(np.float32), queries, k, np.full(2 * 70 * vectors, np.inf, np.float32))
    for q, best in enumerate(_scored(exact, queries, k)):
        assert vector[query == q].tolist() == best and rank[query == q].tolist() == list(range(len(best)))


def test_only_columns_that_reach_the_bound_are_looked_at_again(monkeypatch):
    """The scores are passed over in tiles; whole rows of scores are not compared with the bound."""
    rng = np.random.default_rng(1)
    exact, queries = rng.normal(size=(20 * topk.GROUPS, 16)), rng.normal(size=(30, 16))
    exact, queries = (x / np.linalg.norm(x, axis=1)[:, None] for x in (exact, queries))
    seen, found = [], np.flatnonzero
    monkeypatch.setattr(topk.np, "flatnonzero", lambda x: seen.append(x.size) or found(x))
    query, vector, _, _ = topk._best(exact, exact.astype(np.float32), queries, np.full(30, 3))
    assert seen[0] == 30 * topk.GROUPS
    assert [vector[query == q].tolist() for q in range(30)] == _scored(exact, queries, np.full(30, 3))


@pytest.mark.parametrize("batch_bytes, written", [(64 << 20, 0), (900, 1)])
def test_probes_are_written_only_where_cells_are_merged(spark, monkeypatch, batch_bytes, written):
    names, staged = [], topk.staged
    monkeypatch.setattr(topk, "BATCH_BYTES", batch_bytes)
    monkeypatch.setattr(topk, "staged", lambda df, name: names.append(name) or staged(df, name))
    vectors, probes = _data()
    out = topk.top_k(spark.createDataFrame(vectors, VECTORS_DDL), spark.createDataFrame(probes, PROBES_DDL), ["number"])
    assert out.count() == sum(map(len, _brute(vectors, probes).values()))
    assert names.count("numbered") == written


def test_probes_of_one_key_are_each_answered(spark):
    rows = spark.createDataFrame([("s", "a", 0, [1.0, 0.0]), ("s", "b", 0, [0.0, 1.0])], VECTORS_DDL)
    asked = spark.createDataFrame([("s", n, 0, 1, q) for n in (1, None) for q in ([1.0, 0.0], [1.0, 0.0], [0.0, 1.0])], PROBES_DDL)
    got = [(r.number, r.id, r["rank"]) for r in topk.top_k(rows, asked, ["number"]).collect()]
    assert sorted(got, key=str) == sorted([(n, i, 1) for n in (1, None) for i in "aab"], key=str)


@pytest.mark.parametrize("size", [1, 2, 100])
def test_cells_that_share_a_place_are_kept_apart(size):
    """Rows are sorted by one number only, a hash of the cell and the side; two cells with one hash come mixed."""
    import pyarrow as pa
    rows = [(scope, 0, side, 6 + side, {"id": f"{scope}{i}"} if not side else None, {"number": i} if side else None, [1.0, float(i)])
            for side in (0, 1) for i in range(3) for scope in "ab"]
    rows.append(("c", 0, 1, 9, None, {"number": 7}, [1.0, 1.0]))  # a cell without vectors
    names = ["scope", "block", "side", "place", "row", "asked", "vec"]
    table = pa.table({n: pa.array([r[i] for r in rows]) for i, n in enumerate(names)})
    block = table.column("block")
    table = table.drop_columns("block").append_column("v_block", block).append_column("p_block", block)
    table = table.append_column("mask", pa.array([0] * len(rows), pa.int32())).append_column("k", pa.array([1] * len(rows), pa.int32()))
    found = [(r["row"]["id"], r["asked"]["number"]) for b in topk._score_cells(iter(table.to_batches(max_chunksize=size))) for r in b.to_pylist()]
    assert sorted(found) == [(f"{scope}{i}", i) for scope in "ab" for i in range(3)]
