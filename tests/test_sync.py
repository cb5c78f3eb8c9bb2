"""The add → modify → rename → delete scenario on a table on disk, in batch and as a stream."""

import pytest

from lakesearch.operators.changes import parse_name_status
from lakesearch.plans import sync as S
from lakesearch.session import work_path
from lakesearch.sources.files import append_error_log, decode_lossy, read_error_log
from lakesearch.sources.vector_table import read_vectors, read_vectors_pruned, write_vectors
from lakesearch.streaming.feeds import stream_change_feed

REPO = "007"
FILES = "repo_name string, file_path string, content string, size_bytes bigint"


def _files(spark, **contents):
    return spark.createDataFrame([(REPO, p.replace("__", "."), t, len(t)) for p, t in contents.items()], FILES)


def _changes(spark, *lines):
    return parse_name_status(spark.createDataFrame(
        [(REPO, i, line) for i, line in enumerate(lines)], "repo_name string, seq int, line string"))


def _table(spark, path):
    return {(r.file_path, r.id): r.content for r in read_vectors(spark, path).collect()}


@pytest.fixture
def table(spark):
    path = work_path(spark, "table")
    other = S.prepare_sync(
        _changes(spark, "A\tkeep.md"), _files(spark, keep__md="# Keep\n\nthis"))
    write_vectors(other.records, path, 4)
    return path


def test_scenario(spark, table):
    def run(files, *lines):
        S.apply_sync_to_table(table, S.prepare_sync(_changes(spark, *lines), files), 4)
        return {k: v for k, v in _table(spark, table).items() if k[0] != "keep.md"}

    added = run(_files(spark, a__md="# T\n\nfirst"), "A\ta.md")
    assert [p for p, _ in added] == ["a.md"]
    again = run(_files(spark, a__md="# T\n\nfirst"), "A\ta.md")
    assert again == added
    changed = run(_files(spark, a__md="# T\n\nsecond"), "M\ta.md")
    assert len(changed) == 1 and not changed.keys() & added.keys()
    renamed = run(_files(spark, b__md="# T\n\nsecond"), "R100\ta.md\tb.md")
    assert [p for p, _ in renamed] == ["b.md"] and not renamed.keys() & changed.keys()
    assert run(_files(spark, b__md="x"), "D\tb.md") == {}
    assert [p for p, _ in _table(spark, table)] == ["keep.md"]
    emptied = run(_files(spark, x__md="x"), "D\tkeep.md")
    assert emptied == {} and _table(spark, table) == {}


def test_pruned_read_keeps_names_and_skips_vectors(spark, table):
    rows = read_vectors_pruned(spark, table, [REPO])
    assert [r.namespace for r in rows.collect()] == [REPO] and "embedding" not in rows.columns
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "embedding" not in plan.split("ReadSchema")[1]


def test_missing_file_and_oversize_batch(spark):
    files = _files(spark, a__txt="one two three four five", b__txt="one")
    sync = S.prepare_sync(_changes(spark, "A\ta.txt", "M\tb.txt", "A\tlost.txt"), files, max_tokens=3)
    assert sync.records.count() == 0
    failures = {(r.file_path, r.operation) for r in sync.failures.collect()}
    assert failures == {("lost.txt", "process"), ("a.txt", "upsert"), ("b.txt", "upsert")}
    report = S.sync_report(sync).first()
    assert (report.processed, report.skipped, report.errors, report.deleted_files, report.chunks_upserted) == (2, 1, 2, 2, 0)
    safe = S.prepare_sync(_changes(spark, "A\ta.txt", "D\tb.txt"), files, max_tokens=3, safe=True)
    assert {r.file_path for r in safe.deletes.collect()} == {"b.txt"}


def test_stream_equals_batch(spark, table):
    files = _files(spark, a__md="# A\n\nx", c__md="# C\n\ny")
    changes = _changes(spark, "A\ta.md", "A\tc.md", "D\tkeep.md")
    feed = work_path(spark, "feed")
    for seq in range(3):
        changes.where(f"seq = {seq}").coalesce(1).write.mode("append").parquet(feed)
    stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(feed)
    stream_change_feed(stream, files, table, work_path(spark, "checkpoint"), buckets=4).awaitTermination()
    batch = S.prepare_sync(changes, files)
    assert set(_table(spark, table)) == {(r.file_path, r.id) for r in batch.records.collect()}


def test_error_log_round_trip(spark):
    path = work_path(spark, "log")
    errors = spark.createDataFrame([("a", "process", "m", "a"), ("b", "delete", "m", None), ("c", "upsert", "m", "X"),
                                    ("", "upsert", "m", "A")], "file_path string, operation string, message string, status string")
    append_error_log(errors, path)
    append_error_log(errors.limit(1), path)
    assert sorted((r.status, r.path) for r in read_error_log(spark, path).collect()) == [
        ("A", "a"), ("A", "a"), ("M", "b"), ("M", "c")]


def test_undecodable_bytes_are_dropped(spark):
    rows = spark.createDataFrame([(b"ab\xff\xfec\xc3\xa9",)], "content binary")
    assert rows.select(decode_lossy(rows.content)).first()[0] == "abcé"


def test_first_sync_makes_a_table_that_searches_read(spark, tmp_path):
    """Files on disk to a new table, then every strategy over it."""
    from pyspark.sql import functions as F

    from lakesearch.functions.identity import hash_embedding
    from lakesearch.operators import retrieval as R
    from lakesearch.plans.search import agentic_search
    from lakesearch.sources.files import read_files

    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "app.py").write_text("class Widget:\n    def build_widget(self):\n        if self:\n            return 1\n")
    (tmp_path / "readme.md").write_text("# Title\n\nAbout the widget.\n")
    files = read_files(spark, str(tmp_path), "org/r")
    assert {r.file_path for r in files.collect()} == {"src/app.py", "readme.md"}
    changes = parse_name_status(spark.createDataFrame([("org/r", 0, "A\tsrc/app.py"), ("org/r", 1, "A\treadme.md")],
                                                      "repo_name string, seq int, line string"))
    path = work_path(spark, "new")
    S.apply_sync_to_table(path, S.prepare_sync(changes, files), 4)
    vectors = read_vectors(spark, path)
    rows = {r.file_path: r for r in vectors.collect()}
    assert rows["src/app.py"].function_names == ["build_widget"] and rows["src/app.py"].class_names == ["Widget"]
    assert rows["src/app.py"].code_complexity == 0.1 and rows["readme.md"].live
    embed = lambda text: lambda frame: frame.withColumn("qvec", hash_embedding(F.col(text)))
    requests = spark.createDataFrame([(1, "find class Widget and function build_widget", "org/r"), (2, "Where is src/app.py located", None)],
                                     "query_id int, query string, repo string").withColumn("repositories", F.lit(None).cast("array<string>"))
    profiles = spark.createDataFrame([("org/r", ["widget", "class"], [".py", ".md"], ["src"])],
                                     "namespace string, keywords array<string>, file_types array<string>, structure_clues array<string>")
    mapping = spark.createDataFrame([], "repo_name string, namespace string")
    found = agentic_search(requests, vectors, profiles, mapping, embed("probe_text"), embed("query")).collect()
    assert {(r.query_id, r.file_path) for r in found} >= {(1, "src/app.py"), (2, "src/app.py")}
    assert "direct_entity_search" in {r.strategy for r in found} or len({r.strategy for r in found}) > 1
    live = R.search_live(vectors, requests.select("query_id", F.lit("org/r").alias("namespace"), hash_embedding(F.col("query")).alias("qvec")), live=True)
    assert live.where("query_id = 1").count() == 2


def test_push_reads_only_the_partitions_it_touches(spark, table):
    from lakesearch.sources.vector_table import only_partitions
    touched = spark.createDataFrame([(REPO, 1)], "namespace string, bucket int")
    plan = only_partitions(read_vectors(spark, table), touched)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert f"(namespace#" in filters and "= 007)" in filters and "= 1)" in filters


def test_repositories_named_or_not(spark):
    from lakesearch.operators.retrieval import resolve_namespaces
    vectors = spark.createDataFrame([("n1",), ("n2",)], "namespace string")
    mapping = spark.createDataFrame([("org/a", "n1")], "repo_name string, namespace string")
    requests = spark.createDataFrame([(1, None, None), (2, ["org/a", "org/b"], None), (3, [""], None), (4, [], "org/a"), (5, [" "], "org/a")],
                                     "query_id int, repositories array<string>, repo string")
    got = {}
    for r in resolve_namespaces(requests, vectors, mapping, ["home"]).orderBy("query_id", "namespace_ord").collect():
        got.setdefault(r.query_id, []).append(r.namespace)
    assert got == {1: ["n1", "n2"], 2: ["n1", "org/b"], 3: ["home"], 4: ["n1"], 5: ["home"]}
