"""Rules of single operators, by hand-made rows."""

from pyspark.sql import functions as F

from lakesearch.functions import file_types as T
from lakesearch.functions.filters import compile_filter
from lakesearch.operators import analysis as Q, changes as C, conversations as H, retrieval as R, vectors as V
from lakesearch.functions.numbering import numbered


def _rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_name_status(spark):
    feed = spark.createDataFrame([("r", 1, "A\ta"), ("r", 2, "R90\told\tnew"), ("r", 3, "M"), ("r", 4, "C50\tx\ty"),
                                  ("r", 5, "R100\tonly"), ("r", 6, "")], "repo_name string, seq int, line string")
    out = _rows(C.parse_name_status(feed).select("seq", "status", "path"), "seq", "ord")
    assert out == [(1, "A", "a"), (2, "D", "old"), (2, "M", "new"), (4, "C50", "x"), (5, "R100", "only")]


def test_renames_pair_equal_content_only(spark):
    old = spark.createDataFrame([("r", f"old{i}", "same") for i in range(5)] + [("r", "gone", "b"), ("r", "kept", "c")],
                                "repo_name string, path string, blob string")
    new = spark.createDataFrame([("r", f"new{i}", "same") for i in range(3)] + [("r", "fresh", "z"), ("r", "kept", "d")],
                                "repo_name string, path string, blob string")
    out = C.detect_renames(C.snapshot_diff(old, new)).collect()
    moved = {r.path: r.old_path for r in out if r.old_path}
    assert sorted(moved) == ["new0", "new1", "new2"] and len(set(moved.values())) == 3
    assert {r.path: r.status for r in out if not r.old_path} == {
        **{f"old{i}": "D" for i in range(5)}, "gone": "D", "fresh": "A", "kept": "M"}


def test_commit_ranges(spark):
    zero = "0" * 40
    events = [(1, "push", None, '{"before":"b","after":"a"}'), (2, "push", "s", '{"before":"%s"}' % zero),
              (3, "push", None, "{}"), (4, "pull_request", "s", '{"pull_request":{"base":{"sha":"b"},"merge_commit_sha":null}}'),
              (5, "tag", "s", "{}"), (6, "push", None, '{"before":"b"}'), (7, "push", None, "{bad")]
    df = spark.createDataFrame(events, "event_id int, event_name string, env_sha string, payload string")
    out = {r.event_id: (r.base, r.head, r.error) for r in C.resolve_commit_range(df).collect()}
    assert out[1] == ("b", "a", None) and out[2] == ("s^", "s", None) and out[4] == ("b", "s", None)
    assert out[3][2] == out[7][2] == "base and head missing" and out[5][2] == "Unsupported event type: tag"
    assert out[6][2] == "head missing"


def test_file_types(spark):
    cases = [("a/x.PY", "", "py"), ("a/.bashrc", "", ""), ("x.", "", ""), ("a.tar.gz", "", "gz"),
             ("run", "#!/usr/bin/env python3\nx", "python"), ("run.sh", "#!/bin/zsh", "bash"), ("run.sh", "echo", "sh"),
             ("dir.d/file", "", ""), ("x.md", "#!/bin/bash", "md")]
    df = spark.createDataFrame(cases, "p string, c string, want string")
    for r in df.select("p", "want", T.file_type(F.col("p"), F.col("c")).alias("got")).collect():
        assert r.got == r.want, r.p


def test_analysis(spark):
    df = spark.createDataFrame([(1, 'find class FooBar in "src/main.py"'), (2, ""), (3, None), (4, "where is main.py"),
                                (5, "where could it be")], "query_id int, query string")
    out = {r.query_id: r for r in Q.analyze_query(df).collect()}
    assert out[1].query_type == "code_search" and out[1].specific_targets == ["FooBar", "main.py", "src/main.py"]
    assert "find" in out[1].entities and "in" not in out[1].entities
    assert out[4].query_type == "file_search" and out[5].query_type == "code_search"
    for blank in (2, 3):
        assert (out[blank].query_type, out[blank].confidence, out[blank].search_strategies) == (
            "conceptual", 0.1, ["semantic_repository_search"])


def test_filter_tree(spark):
    df = spark.createDataFrame([(1, "A.py", 0.5, ["f"]), (2, "b.md", None, None), (3, "c.py", 0.9, ["g"])],
                               "id int, path string, c double, fns array<string>")

    def ids(tree):
        return [r.id for r in df.where(compile_filter(tree, df.schema)).orderBy("id").collect()]

    assert ids({}) == ids(None) == [1, 2, 3]
    assert ids({"path": {"$regex": r"(?i)\.PY$"}}) == [1, 3]
    assert ids({"c": {"$gte": 0.5, "$lt": 0.9}}) == [1]
    assert ids({"fns": {"$in": ["g", "h"]}}) == [3]
    assert ids({"$or": [{"path": "b.md"}, {"c": {"$lt": 0.6}}]}) == [1, 2]
    assert ids({"absent": 1}) == [] and ids({"$or": []}) == []


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("cast(id as string) as id", "id % 2 = 0 as live").write.parquet(path)
    df = spark.read.parquet(path)
    plan = df.where(compile_filter({"live": True}, df.schema))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "live" in plan.split("PushedFilters: [")[1].split("]")[0]


def _vector_rows(spark, rows):
    return spark.createDataFrame(rows, "id string, namespace string, file_path string, content string, "
                                       "function_names array<string>, class_names array<string>")


def test_match_terms_equals_the_stated_predicate(spark):
    import re
    rows = [("1", "n", "src/My-File.py", "call foo() now", ["foo"], []), ("2", "n", "a/b.md", "prefix_foo only", [], ["Bar"]),
            ("3", "n", "x", "a++b and C++ code", None, None), ("4", "n", "FOO/y", None, [], []),
            ("5", "m", "src/My-File.py", "foo bar baz", [], []), ("6", "n", "p", "été foo.bar x", [], [])]
    terms = ["foo", "Foo", "my-file.py", "Bar", "foo bar", "++", "foo.bar", "b.md", "y", "été", ".py", "foo bar baz"]
    wanted = spark.createDataFrame([("n", s, t) for t in terms for s in (Q.DIRECT, Q.FILES)],
                                   "namespace string, strategy string, term string")
    got = {(r.strategy, r.term, r.id) for r in R.match_terms(_vector_rows(spark, rows), wanted).collect()}
    want = set()
    for number, ns, path, content, functions, classes in rows:
        for term in terms:
            if ns != "n":
                continue
            in_path = term.lower() in path.lower()
            if in_path:
                want.add((Q.FILES, term, number))
            if in_path or (content and re.search(r"\b" + re.escape(term) + r"\b", content, re.I)) \
                    or term in (functions or []) or term in (classes or []):
                want.add((Q.DIRECT, term, number))
    assert got == want


def test_dedupe_and_ranking(spark):
    rows = [(1, "file_search", "n", 0, "semantic_repository_search", 2, 0.7, 0, 1, "b", "p", 1, 0.9),
            (1, "file_search", "n", 0, "direct_entity_search", 0, 0.9, 0, 2, "a", "p", 1, 0.5),
            (1, "file_search", "n", 0, "file_structure_search", 3, 0.95, 0, 1, "c", "q", 1, 0.5),
            (1, "file_search", "m", 1, "direct_entity_search", 0, 0.9, 0, 1, "d", "p", 1, 0.99)]
    df = spark.createDataFrame(rows, "query_id int, query_type string, namespace string, namespace_ord int, strategy string, "
                                     "strategy_ord int, confidence double, term_pos int, rank int, id string, "
                                     "file_path string, line_start int, score double")
    unique = R.dedupe_first_seen(df)
    assert {r.id for r in unique.collect()} == {"a", "c"}
    assert {r.id for r in R.dedupe_first_seen(df, include_namespace=True).collect()} == {"a", "c", "d"}
    ranked = R.final_top10(R.boosted_rank(unique)).orderBy("final_rank").collect()
    # Equal raw scores: the boosted rank decides.
    assert [(r.id, round(r.rank_score, 4)) for r in ranked] == [("a", 0.675), ("c", 0.665)]


def test_namespaces_fall_back_to_the_defaults(spark):
    none = spark.createDataFrame([], "namespace string")
    asked = spark.createDataFrame([(1, ["org/a", "", "b"]), (2, None)], "query_id int, repositories array<string>")
    mapping = spark.createDataFrame([("org/a", "a")], "repo_name string, namespace string")
    out = _rows(R.resolve_namespaces(asked, none, mapping, ["x", "y"]).select("query_id", "namespace_ord", "namespace"), "query_id", "namespace_ord")
    assert out == [(1, 0, "a"), (1, 1, "b"), (2, 0, "x"), (2, 1, "y")]


def test_numbering_over_ranges(spark):
    rows = spark.range(2000).selectExpr("case when id % 3 = 0 then 'hot' else 'k' || id % 5 end as k", "2000 - id as o")
    out = numbered(rows.repartition(6), ["k"], ["o"]).collect()
    groups = {}
    for r in out:
        groups.setdefault(r.k, []).append((r.o, r.position))
    for found in groups.values():
        assert [p for _, p in sorted(found)] == list(range(len(found)))


def test_activation_and_upsert(spark):
    table = spark.createDataFrame([("1", "n", "r", "c1", True), ("2", "n", "r", "c2", False), ("3", "n", "s", "c1", True)],
                                  "id string, namespace string, repo_name string, commit_sha string, live boolean")
    after, report = V.activate_commit(table, spark.createDataFrame([("r", "c2")], "repo_name string, commit_sha string"))
    assert {r.id: r.live for r in after.collect()} == {"1": False, "2": True, "3": True}
    assert tuple(report.first()) == ("r", 1, 1)
    new = spark.createDataFrame([("1", "n", "r", "c3", True, 1), ("1", "n", "r", "c4", True, 2), ("1", "z", "r", "c3", True, 1)],
                                "id string, namespace string, repo_name string, commit_sha string, live boolean, o int")
    out = {(r.namespace, r.id): r.commit_sha for r in V.upsert_by_id(table, new, "o").collect()}
    assert out == {("n", "1"): "c4", ("n", "2"): "c2", ("n", "3"): "c1", ("z", "1"): "c3"}


def test_code_blocks(spark):
    text = "a `x` b\n```py\np = 1\n```\nc\n```\nq\n``` and `y`"
    df = spark.createDataFrame([(1, 0, text)], "conv_id int, turn int, text string")
    assert [(r.language, r.code) for r in H.extract_code_blocks(df).orderBy("block").collect()] == [("py", "p = 1\n"), ("text", "q\n")]
    assert [r.code for r in H.extract_inline_code(df).orderBy("span").collect()] == ["x", "y"]
