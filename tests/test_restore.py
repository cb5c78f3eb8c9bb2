"""Archives on disk: listing, checksums, restore, activation; and models behind a sync."""

import hashlib
import json

from lakesearch.operators.changes import parse_name_status
from lakesearch.operators.embedding import embed_texts
from lakesearch.plans.restore import restore_archive
from lakesearch.plans.sync import prepare_sync
from lakesearch.sources import files as S


def _archive(root, repo, sha, part, ids, broken=False):
    folder = root / "vectors" / repo / sha
    folder.mkdir(parents=True, exist_ok=True)
    body = json.dumps({"vectors": [{"id": i, "values": [1.0, 2.0], "metadata": {
        "namespace": "n", "repo_name": repo, "file_path": f"{i}.py", "commit_sha": sha, "content": i,
        "line_start": 1, "live": False}} for i in ids]}).encode()
    digest = hashlib.sha256(body + (b"x" if broken else b"")).hexdigest()
    (folder / f"archive{part}.json").write_bytes(body)
    (folder / f"checksums{part}.json").write_text(json.dumps({"archive_sha256": digest}))


def test_restore(spark, tmp_path):
    _archive(tmp_path, "org/r", "c2", "", ["a", "b"])
    _archive(tmp_path, "org/r", "c2", "-1", ["c"])
    _archive(tmp_path, "org/s", "c1", "", ["d"], broken=True)
    blobs, sums = S.read_archive_blobs(spark, str(tmp_path)), S.read_checksums(spark, str(tmp_path))
    assert [(r.repo_name, r.commit_sha) for r in S.list_archives(blobs).collect()] == [("org/r", "c2"), ("org/s", "c1")]
    stored = spark.createDataFrame(
        [("a", [9.0, 9.0], "n", "org/r", "a.py", "c1", "old", 1, True), ("z", [1.0], "n", "org/r", "z.py", "c1", "z", 1, True),
         ("d", [1.0], "n", "org/s", "d.py", "c0", "kept", 1, True)],
        "id string, embedding array<float>, namespace string, repo_name string, file_path string, commit_sha string, "
        "content string, line_start int, live boolean")
    table, report = restore_archive(stored, blobs, sums, "2024-01-02T03:04:05",
                                    spark.createDataFrame([("org/r", "c2")], "repo_name string, commit_sha string"))
    rows = {r.id: (r.content, r.commit_sha, r.live, r.restored_at) for r in table.collect()}
    stamp = "2024-01-02T03:04:05"
    assert rows == {"a": ("a", "c2", True, stamp), "b": ("b", "c2", True, stamp), "c": ("c", "c2", True, stamp),
                    "z": ("z", "c1", False, None), "d": ("kept", "c0", True, None)}
    found = {(r.repo_name, r.vectors_restored, r.activated_count, r.deactivated_count, r.error) for r in report.collect()}
    assert found == {("org/r", 3, 3, 1, None), (None, None, None, None, "checksum mismatch")}


def test_sync_with_a_model(spark):
    def load_model():
        return lambda texts: [[float(len(t)), 1.0] for t in texts]

    files = spark.createDataFrame([("r", "a.txt", "hello", 5), ("r", "b.txt", "one two three", 13)],
                                  "repo_name string, file_path string, content string, size_bytes bigint")
    changes = parse_name_status(spark.createDataFrame([("r", 0, "A\ta.txt"), ("r", 1, "A\tb.txt")],
                                                      "repo_name string, seq int, line string"))
    sync = prepare_sync(changes, files, lambda rows, text: embed_texts(rows, load_model, text))
    assert {r.file_path: r.embedding for r in sync.records.collect()} == {"a.txt": [5.0, 1.0], "b.txt": [13.0, 1.0]}
