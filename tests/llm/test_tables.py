import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakesearch.llm import fixity, mixing, tool_calls, topk_search
from tests.llm import brute

DOCS = "doc_id long, text string, source string"


def mix_docs(seed):
    rng = random.Random(seed)
    sources = ["big", "b", "é", "z", "A", "", None]
    out = [(i, " ".join(["w"] * rng.randint(0, 30)) + rng.choice(["", "\n", " \t"]), "big" if i % 3 else rng.choice(sources)) for i in range(300)]
    return out + [(900, None, "none"), (901, "", "none"), (None, "a b c", "b"), (None, "a b c", "b"), (5, "x y", "big"), (5, "x y", "big")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_matches_brute_force(spark, seed):
    docs = mix_docs(seed)
    frame = spark.createDataFrame(docs, DOCS).select("*", *[F.lit(1).alias(c) for c in ("size", "target", "taken", "draw", "weight", "range_id", "before")])
    key = lambda r: tuple((x is None, x) for x in r)
    got = sorted(((r.doc_id, r.source, r.size, r.target, r.taken) for r in mixing.mix(frame).collect()), key=key)
    assert got == sorted(brute.mix(docs), key=key)
    again = sorted(((r.doc_id, r.source, r.size, r.target, r.taken) for r in mixing.mix(frame.repartition(13)).collect()), key=key)
    assert again == got
    assert all(0 <= taken <= 3 * size for _, _, size, _, taken in got)
    for source in {s for _, s, *_ in got}:
        own = [r for r in got if r[1] == source]
        assert abs(sum(r[4] for r in own) - own[0][3]) <= 0.5


def test_mixed_documents_have_the_words_taken(spark):
    docs = mix_docs(4)
    frame = spark.createDataFrame([(*d, 7, "x") for d in docs], DOCS + ", n_chars int, size string")
    rows = mixing.mixed_documents(frame)
    assert rows.columns == frame.columns
    got = {r.source: r.n for r in rows.groupBy("source").agg(F.sum(mixing.count_words(F.col("text"))).alias("n")).collect()}
    want = {}
    for _, s, _, _, taken in brute.mix(docs):
        want[s] = want.get(s, 0) + taken
    assert got == {s: n for s, n in want.items() if n}
    assert mixing.mix(spark.createDataFrame([], DOCS)).collect() == []


def brute_top(vectors, k):
    clean = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in vectors
             if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in clean:
        if q % 100 == 0:
            scores = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in clean if i != q and len(b) == len(a)))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def test_top_k_matches_brute_force(spark):
    rng = random.Random(8)
    vectors = [(i, [rng.gauss(0, 0.3) for _ in range(6)]) for i in range(700)]
    vectors += [(1000 + i, [rng.choice([-0.5, 0.0, 0.5]) for _ in range(6)]) for i in range(600)]  # many ties
    vectors += [(3000, [0.0] * 6), (3100, [1.0] * 3), (3101, [0.5, -0.5, 1.0]), (3200, None), (3300, []), (3400, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
                (3500, [float("nan")] * 6), (3600, [float("inf")] + [0.0] * 5), (None, [9.0] * 6), (3700, [1e12] * 6)]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in vectors], "vec_id long, embedding array<float>, score int, rank int").repartition(5)
    x = topk_search.quantized(frame)
    got = topk_search.top_k(x, x.where("vec_id % 100 = 0"), 10, block_rows=128, batch_bytes=300).collect()
    wrapped = [(q, n, i, (s + 2**63) % 2**64 - 2**63) for q, n, i, s in brute_top(vectors, 10) if 3700 not in (q, i)]
    assert sorted(tuple(r) for r in got if 3700 not in (r.query_id, r.vec_id) and r.query_id in (3100,)) == [w for w in wrapped if w[0] == 3100]
    small = spark.createDataFrame([(i, v) for i, v in vectors if i != 3700], "vec_id long, embedding array<float>").repartition(5)
    x = topk_search.quantized(small)
    got = topk_search.top_k(x, x.where("vec_id % 100 = 0"), 10, block_rows=128, batch_bytes=300).collect()
    assert sorted(tuple(r) for r in got) == brute_top([v for v in vectors if v[0] != 3700], 10)
    assert topk_search.top_k(x, x.where("vec_id < 0"), 10).collect() == []


def test_top_k_of_repeated_rows_and_empty_table(spark):
    schema = "vec_id long, embedding array<float>"
    x = topk_search.quantized(spark.createDataFrame([(0, [1.0]), (1, [0.5]), (1, [0.5]), (2, [-1.0])], schema))
    rows = topk_search.top_k(x, x.where("vec_id = 0"), 10).collect()
    assert sorted((r.rank, r.vec_id, r.score) for r in rows) == [(1, 1, 1024 * 512), (2, 1, 1024 * 512), (3, 2, -1024 * 1024)]
    none = topk_search.quantized(spark.createDataFrame([], schema))
    assert topk_search.top_k(none, none, 3).collect() == []


def test_threshold_stops_early():
    rng = np.random.default_rng(1)
    values = rng.integers(-50, 50, (2000, 4))
    values[7] = [1000, 1000, -1000, 1000]
    block = topk_search._Block(np.arange(2000), values)
    scored = []
    plain = block.scores
    block.scores = lambda rows, query: (scored.append(len(rows)), plain(rows, query))[1]
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    scores, ids = block.search(-1, np.array([1, 1, -1, 1]), none, 1)
    assert ids.tolist() == [7] and sum(scored) < 100


def test_audit_locates_damage(spark):
    rng = random.Random(3)
    left = [(f, i * 700, rng.randbytes(300).hex()) for f in ("a", "b", "c") for i in range(400)] + [(None, 5, "null file"), ("d", None, None)]
    right = [r for r in left if r[:2] != ("a", 7000)]
    right[5] = (*right[5][:2], "other")
    right += [("e", 0, "new"), ("b", 1400, "second at one offset")]

    def listed(rows):
        return spark.createDataFrame(rows, "file string, offset long, content string").select(
            "file", "offset", F.octet_length("content").alias("length"), fixity.record_digest(F.col("content")).alias("digest"), F.lit("x").alias("node"), F.lit(1).alias("n"))

    found = sorted((r.file, r.offset, r.kind) for r in fixity.audit(listed(left), listed(right), 4096, 4).collect())
    assert found == [("a", 3500, "changed"), ("a", 7000, "missing"), ("b", 1400, "changed"), ("e", 0, "extra")]
    assert fixity.audit(listed(left), listed(left[::-1]), 4096, 4).collect() == []
    assert len(fixity.audit(listed(left), listed([]), 4096, 4).collect()) == len(left)
    twice = fixity.audit(listed(left), listed(left + left[:1]), 4096, 4).collect()
    assert [(r.file, r.offset, r.kind) for r in twice] == [("a", 0, "changed")]


def test_equal_branches_are_not_followed(spark):
    rows = [("a", i * 100, hashlib.sha256(str(i).encode()).hexdigest()) for i in range(2000)]
    frame = lambda r: spark.createDataFrame(r, "file string, offset long, digest string").withColumn("length", F.lit(100))
    levels = fixity.tree(fixity.entries(frame(rows)), 3, 1000, 8)
    assert [x.count() for x in levels] == [200, 25, 4, 1]


CALLS = "conv_id long, call_id string, position long, name string, arguments string, depends_on array<string>"
RESULTS = "call_id string, position long, content string"
SCHEMAS = "name string, params array<struct<name:string,type:string,required:boolean>>"


def test_tool_calls(spark):
    chain = [(2, f"k{i}", 100 - i, "f", '{"a": 1}', [f"k{i - 1}"] if i else []) for i in range(20)]
    calls = [
        (1, "x", 1, "f", '{ "b":[2, {"z":1,"y":null}], "a": 1 }', ["y"]), (1, "y", 2, "f", '{"a":"s"}', ["gone"]), (1, "z", 0, "f", "{bad", ["x", "y", "y"]),
        (1, "c1", 0, "g", "{}", ["c2"]), (1, "c2", 0, "f", "[1]", ["c1"]), (1, "w", 9, "f", '{"a":2.5}', ["c1", "y"]), (1, None, 3, None, None, None), (1, "self", 4, "f", '{"c":true}', ["self"]),
    ] + chain
    results = [("x", 9, 'late "quoted"'), ("x", 8, "early"), ("nobody", 1, "?"), (None, 1, "?"), ("y", 1, None)]
    schemas = [("f", [("a", "integer", True), ("b", "array", False)])]
    frame = spark.createDataFrame(calls, CALLS).select("*", *[F.lit(1).alias(c) for c in ("level", "errors", "params", "content", "end")])
    rows = tool_calls.link_tool_calls(frame, spark.createDataFrame(results, RESULTS), spark.createDataFrame(schemas, SCHEMAS)).collect()
    got = {r.call_id: r for r in rows}
    assert len(rows) == len(calls)
    assert {k: got[k].level for k in ("x", "y", "z", "c1", "c2", "w", "self", None)} == {"x": 1, "y": 0, "z": 2, "c1": None, "c2": None, "w": None, "self": None, None: 0}
    assert {k for k, r in got.items() if r.cyclic} == {"c1", "c2", "w", "self"}
    assert [got[f"k{i}"].level for i in range(20)] == list(range(20)) == [got[f"k{i}"].place for i in range(20)]
    assert got["x"].message == '{"arguments":{"a":1,"b":[2,{"y":null,"z":1}]},"id":"x","name":"f","result":"early"}' and got["x"].n_results == 2
    assert got["y"].message == '{"arguments":{"a":"s"},"id":"y","name":"f","result":null}' and got["y"].errors == ["type of a"]
    assert got["z"].errors == ["malformed"] and got["c2"].errors == ["malformed"] and got[None].errors == ["malformed"]
    assert got["c1"].errors == ["unknown tool"] and got["w"].errors == ["type of a"]
    assert got["self"].errors == ["missing a", "unknown c"] and got["x"].errors == []
    for r in rows:
        assert json.dumps(json.loads(r.message), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r.message
    places = [r.call_id for r in sorted((r for r in rows if r.conv_id == 1), key=lambda r: r.place)]
    assert places.index("y") < places.index("x") < places.index("z") and set(places[-4:]) == {"c1", "c2", "w", "self"}


def test_tool_calls_of_empty_tables(spark):
    none = [spark.createDataFrame([], s) for s in (CALLS, RESULTS, SCHEMAS)]
    assert tool_calls.link_tool_calls(*none).collect() == []


def test_equal_calls_share_their_result(spark):
    calls = spark.createDataFrame([(1, "x", 1, "f", "{}", []), (1, "x", 1, "f", "{}", ["x"]), (1, "v", 2, "f", "{}", ["x"])], CALLS)
    rows = tool_calls.link_tool_calls(calls, spark.createDataFrame([("x", 1, "r")], RESULTS), spark.createDataFrame([], SCHEMAS)).collect()
    assert len(rows) == 3 and all('"result":"r"' in r.message for r in rows if r.call_id == "x")


def test_a_turn_without_role_is_a_result(spark, tmp_path):
    rows = [(2, 0, "user", "ask"), (2, 1, "assistant", "call"), (2, 2, None, "answer")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    (found,) = tool_calls.op5_tool_calls(spark, str(tmp_path)).collect()
    assert found.n_results == 1 and '"result":"answer"' in found.message
