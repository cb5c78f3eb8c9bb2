"""The versioned vector table: whole versions, reads from the manifest, batches applied once."""

import pytest

from lakesearch.session import work_path
from lakesearch.sources import vector_table as V

SCHEMA = "id string, namespace string, file_path string, content string"


def rows_of(df):
    return sorted(tuple(r) for r in df.select("id", "namespace", "file_path", "content").collect())


def test_stopped_write_leaves_the_old_version_whole(spark):
    path = work_path(spark, "versions")
    first = [("a", "ns1", "x.py", "one"), ("b", "ns2", "y.py", "two"), ("c", "007", "z.py", "three")]
    V.write_vectors(spark.createDataFrame(first, SCHEMA), path, 4)
    change = spark.createDataFrame([("a2", "ns1", "x.py", "new")], SCHEMA)

    def stop():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        V.write_vectors(change, path, 4, before_commit=stop)
    assert rows_of(V.read_vectors(spark, path)) == sorted(first)
    assert V.write_vectors(change, path, 4) == 2
    assert rows_of(V.read_vectors(spark, path)) == sorted([("a2", "ns1", "x.py", "new")] + first[1:])
    emptied = spark.createDataFrame([(None, "ns2", "y.py", None)], SCHEMA)
    V.write_vectors(emptied, path, 4)
    assert rows_of(V.read_vectors(spark, path)) == sorted([("a2", "ns1", "x.py", "new"), first[2]])
    assert V.read_vectors(spark, path).schema["namespace"].dataType.simpleString() == "string"


def test_pruned_read_takes_only_files_of_its_namespaces(spark):
    path = work_path(spark, "versions")
    rows = [(f"id{i}", f"ns{i % 5}", f"f{i}.py", f"c{i}") for i in range(50)]
    V.write_vectors(spark.createDataFrame(rows, SCHEMA), path, 4)
    pruned = V.read_vectors_pruned(spark, path, ["ns1", "ns3"])
    files = pruned.inputFiles()
    assert files and all("namespace=ns1" in f or "namespace=ns3" in f for f in files)
    assert sorted(tuple(r) for r in pruned.select("id", "namespace", "file_path", "content").collect()) == sorted(r for r in rows if r[1] in ("ns1", "ns3"))
    assert "embedding" not in pruned.columns


def test_replayed_batch_writes_no_version(spark):
    from tests.test_sync import _changes, _files  # noqa: F401
    from lakesearch.plans import sync as S
    path = work_path(spark, "versions")
    sync = S.prepare_sync(_changes(spark, "A\tsrc/app.py"), _files(spark, src__app__py="def f():\n    return 1\n"))
    assert S.apply_sync_to_table(path, sync, 4, stream=("feed", 0))
    version = V.current_commit(spark, path)["version"]
    assert not S.apply_sync_to_table(path, sync, 4, stream=("feed", 0))
    assert V.current_commit(spark, path)["version"] == version and V.current_commit(spark, path)["streams"] == {"feed": 0}


def test_rows_of_a_new_table_are_made_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = spark.range(20).selectExpr("cast(id as string) as id", "'n' || id % 3 as namespace", "'f' || id as file_path", "'x' as content")
    V.write_vectors(rows.mapInArrow(count, rows.schema), str(tmp_path / "t"), 2)
    assert made.value == 20
    assert V.read_vectors(spark, str(tmp_path / "t")).count() == 20
