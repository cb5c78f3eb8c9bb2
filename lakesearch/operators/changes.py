"""Change detection: from version-control feeds to (status, path) rows.

Everything here is a projection of one feed line, except the snapshot operators,
which join on path or on content hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakesearch.functions.text import strip
from lakesearch.session import staged


def _change(status: Column, path: Column) -> Column:
    return F.struct(status.alias("status"), path.alias("path"))


def _explode_changes(feed: DataFrame, parts: Column, keep: list[str]) -> DataFrame:
    """Rows of (keep..., ord, status, path) from the columns of one feed line."""
    status, first, second = (F.try_element_at(parts, F.lit(i)) for i in (1, 2, 3))
    rows = (F.when(status.startswith("R") & second.isNotNull(),
                   F.array(_change(F.lit("D"), first), _change(F.lit("M"), second)))
            .when(first.isNotNull() & (first != ""), F.array(_change(status, first))))
    return (feed.select(*keep, F.posexplode(rows).alias("ord", "change"))
            .select(*keep, "ord", "change.status", "change.path"))


def parse_name_status(feed: DataFrame, line: str = "line", keep: tuple[str, ...] = ("repo_name", "seq")) -> DataFrame:
    """Tab-separated name-status lines. A rename is a delete of the old path plus a
    modify of the new one; lines with fewer than two columns yield nothing."""
    return _explode_changes(feed, F.split(strip(F.col(line)), "\t"), list(keep))


def parse_change_file(feed: DataFrame, line: str = "line",
                      keep: tuple[str, ...] = ("repo_name", "seq")) -> tuple[DataFrame, DataFrame]:
    """Whitespace-separated change list, at most three parts a line.

    Returns (changes, errors): a rename without a new path is an error row.
    """
    parts = F.split(strip(F.col(line)), r"\s+", 3)
    malformed = parts[0].startswith("R") & (F.size(parts) < 3)
    changes = _explode_changes(feed.where(~malformed), parts, list(keep))
    errors = feed.where(malformed).select(
        *keep, F.concat(F.lit("Malformed rename line: "), strip(F.col(line))).alias("message"))
    return changes, errors


def parse_file_tokens(feed: DataFrame, token: str = "token",
                      keep: tuple[str, ...] = ("repo_name", "seq")) -> tuple[DataFrame, DataFrame]:
    """``A:path`` tokens, split at the first colon; a bare path is a modify.

    Returns (changes, errors): prefixes other than A, M and D are error rows.
    """
    tok = F.col(token)
    colon = F.instr(tok, ":")
    status = F.when(colon > 0, F.upper(strip(F.substring(tok, F.lit(1), colon - 1)))).otherwise("M")
    path = F.when(colon > 0, F.substring(tok, colon + 1, F.length(tok))).otherwise(tok)
    parsed = feed.select(*keep, status.alias("status"), path.alias("path"), tok.alias("token"))
    valid = F.col("status").isin("A", "M", "D")
    changes = parsed.where(valid).drop("token")
    errors = parsed.where(~valid).select(
        *keep, F.concat(F.lit("Invalid status prefix: "), F.col("token")).alias("message"))
    return changes, errors


# Fixed value: a submodule line of a diff.
SUBMODULE_LINE = r"^Submodule\s+([^\s]+)\s+([0-9a-f]{7,})\.\.([0-9a-f]{7,})"


def parse_submodule_diff(feed: DataFrame, line: str = "line", keep: tuple[str, ...] = ()) -> DataFrame:
    """Submodule pointer lines → (sub_path, old_sha, new_sha, change)."""
    text = strip(F.col(line))
    path, old, new = (F.regexp_extract(text, SUBMODULE_LINE, i) for i in (1, 2, 3))
    change = (F.when(F.col("old_sha").rlike("^0+$"), "added")
              .when(F.col("new_sha").rlike("^0+$"), "deleted").otherwise("changed"))
    return (feed.select(*keep, path.alias("sub_path"), old.alias("old_sha"), new.alias("new_sha"))
            .where(F.col("sub_path") != "").withColumn("change", change))


def snapshot_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """File-level A/M/D between two trees (repo_name, path, blob).

    One full outer join on (repo_name, path). An empty old side is a bulk load.
    """
    sides = old.select("repo_name", "path", F.col("blob").alias("old_blob")).join(
        new.select("repo_name", "path", F.col("blob").alias("new_blob")), ["repo_name", "path"], "full_outer")
    status = (F.when(F.col("old_blob").isNull(), "A").when(F.col("new_blob").isNull(), "D")
              .when(F.col("old_blob") != F.col("new_blob"), "M"))
    return sides.select("repo_name", "path", status.alias("status"), "old_blob", "new_blob").where("status is not null")


def detect_renames(diff: DataFrame) -> DataFrame:
    """Turn an added path whose content equals a deleted one into a modify of the new path.

    Adds and deletes with equal content are paired by rank in path order. Each rank is
    one pair, so a blob shared by very many files never yields more rows than it has
    files. The ranks come from a distributed sort: see ``_rank_in_blob``. The difference
    is small beside the trees it came from and is read three times, so it is written once.
    """
    diff = staged(diff, "diff")
    added = _rank_in_blob(diff.where("status = 'A'"), "new_blob")
    deleted = _rank_in_blob(diff.where("status = 'D'"), "old_blob")
    pairs = added.join(deleted.withColumnRenamed("path", "old_path"), ["repo_name", "blob", "rank"])
    moved = pairs.select("repo_name", "path", "old_path")
    return (diff.join(moved, ["repo_name", "path"], "left")
            .select("repo_name", "path",
                    F.when((F.col("status") == "A") & F.col("old_path").isNotNull(), "M")
                    .otherwise(F.col("status")).alias("status"),
                    F.when(F.col("status") == "A", F.col("old_path")).alias("old_path")))


RANK_BUCKETS = 256


def _rank_in_blob(changes: DataFrame, blob: str) -> DataFrame:
    """(repo_name, blob, path, rank): rank within the blob, split so that no single task
    sorts a whole blob.

    Paths are hashed to buckets; ranks are local to (blob, bucket) and shifted by the
    sizes of the buckets before. The order is (bucket, path), the same on both sides of
    the pairing, and only the small bucket counts are ranked per blob.
    """
    rows = changes.select("repo_name", F.col(blob).alias("blob"), "path",
                          F.pmod(F.xxhash64("path"), F.lit(RANK_BUCKETS)).alias("bucket"))
    local = Window.partitionBy("repo_name", "blob", "bucket").orderBy("path")
    before = (Window.partitionBy("repo_name", "blob").orderBy("bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    shifts = (rows.groupBy("repo_name", "blob", "bucket").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    return (rows.withColumn("local_rank", F.row_number().over(local))
            .join(shifts, ["repo_name", "blob", "bucket"])
            .select("repo_name", "blob", "path", (F.col("local_rank") + F.col("shift")).alias("rank")))


def expand_submodules(pointers: DataFrame, trees: DataFrame) -> DataFrame:
    """File changes below moved submodule pointers, paths prefixed with the submodule path.

    ``pointers``: (sub_path, old_sha, new_sha, change); ``trees``: (sub_path, sha, path,
    blob); both with ``repo_name``, the superproject, where there are several. An added pointer lists every file of the new tree, a deleted one every file of
    the old tree, a changed one the file-level difference with renames expanded.
    """
    owner = ["repo_name", "sub_path"] if "repo_name" in pointers.columns else ["sub_path"]

    def files(sha: str, kinds: list[str]) -> DataFrame:
        wanted = pointers.where(F.col("change").isin(kinds)).select(*owner, F.col(sha).alias("sha")).distinct()
        return trees.join(wanted, [*owner, "sha"])

    added = files("new_sha", ["added"]).select(*owner, "path", F.lit("A").alias("status"))
    deleted = files("old_sha", ["deleted"]).select(*owner, "path", F.lit("D").alias("status"))
    moved = pointers.where("change = 'changed'").select(*owner, "old_sha", "new_sha").distinct()
    key = F.concat_ws("\x01", *owner, "old_sha", "new_sha")
    sides = [trees.join(moved.withColumn("of", key).withColumn("sha", F.col(sha)), [*owner, "sha"])
             .select(F.col("of").alias("repo_name"), "path", "blob") for sha in ("old_sha", "new_sha")]
    parts = F.split("repo_name", "\x01")
    changed = (detect_renames(snapshot_diff(*sides))
               .select(*[parts[i].alias(f"of_{c}") for i, c in enumerate(owner)], "path", "status")
               .withColumnsRenamed({f"of_{c}": c for c in owner}))
    rows = added.unionByName(deleted).unionByName(changed)
    return rows.select(*owner, F.concat_ws("/", "sub_path", "path").alias("path"), "status")


NO_COMMIT = "0" * 40


def resolve_commit_range(events: DataFrame) -> DataFrame:
    """CI events (event_name, env_sha, payload) → base, head or an error message."""
    def field(path: str) -> Column:
        return F.get_json_object("payload", path)

    def filled(value: Column) -> Column:
        return F.nullif(value, F.lit(""))

    push, pull = F.col("event_name") == "push", F.col("event_name") == "pull_request"
    base = F.when(push, field("$.before")).when(pull, field("$.pull_request.base.sha"))
    head = (F.when(push, F.coalesce(filled(F.col("env_sha")), filled(field("$.after"))))
            .when(pull, F.coalesce(filled(field("$.pull_request.merge_commit_sha")), filled(F.col("env_sha")))))
    parsed = events.select("*", F.nullif(filled(base), F.lit(NO_COMMIT)).alias("raw_base"), head.alias("raw_head"))
    error = (F.when(~(push | pull), F.concat(F.lit("Unsupported event type: "), F.col("event_name")))
             .when(F.col("raw_head").isNull() & F.col("raw_base").isNull(), "base and head missing")
             .when(F.col("raw_head").isNull(), "head missing"))
    valid = error.isNull()
    return parsed.select(
        *events.columns,
        F.when(valid, F.coalesce("raw_base", F.concat("raw_head", F.lit("^")))).alias("base"),
        F.when(valid, F.col("raw_head")).alias("head"), error.alias("error")).drop("payload")


def collapse_changes(changes: DataFrame) -> DataFrame:
    """Last status per (repo_name, path); later ``seq``, then later ``ord``, wins.

    ``max_by`` combines on the map side, so a path that changes very often costs one
    row per task in the shuffle.
    """
    order = F.struct("seq", "ord")
    return (changes.groupBy("repo_name", "path")
            .agg(F.max_by("status", order).alias("status"), F.max("seq").alias("seq")))


def build_sync_plan(changes: DataFrame, files: DataFrame) -> DataFrame:
    """What to do per change: (repo_name, seq, status, path, do_delete, do_process, error).

    ``files`` needs (repo_name, file_path). Renames not yet expanded are dropped.
    """
    named = files.select("repo_name", F.col("file_path").alias("path"))
    present = named.join(changes.select("repo_name", "path"), ["repo_name", "path"], "left_semi").distinct().withColumn("present", F.lit(True))
    status, found = F.col("status"), F.coalesce("present", F.lit(False))
    return (changes.where(~status.startswith("R")).join(present, ["repo_name", "path"], "left")
            .select("repo_name", "seq", "status", "path",
                    ((status == "D") | (found & status.isin("A", "M"))).alias("do_delete"),
                    ((status != "D") & found).alias("do_process"),
                    F.when((status != "D") & ~found,
                           F.concat(F.lit("File marked as "), status, F.lit(" but not found: "), F.col("path")))
                    .alias("error")))
