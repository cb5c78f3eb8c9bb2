"""Maintenance of the vector table: deletes, upserts, restore, activation, statistics.

Deletes and upserts are anti joins on (namespace, key). The changed side is a push or an
archive; how it is joined is left to the optimizer, which knows its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def delete_by_file(vectors: DataFrame, paths: DataFrame) -> DataFrame:
    """Without the rows of the given (namespace, repo_name, file_path)."""
    return vectors.join(paths.select("namespace", "repo_name", "file_path"), ["namespace", "repo_name", "file_path"],
                        "left_anti").select(*vectors.columns)


def delete_by_id(vectors: DataFrame, ids: DataFrame) -> DataFrame:
    return vectors.join(ids.select("namespace", "id"), ["namespace", "id"], "left_anti").select(*vectors.columns)


def upsert_by_id(vectors: DataFrame, records: DataFrame, order: str | None = None) -> DataFrame:
    """Insert or replace by (namespace, id). With ``order``, the last of several records wins."""
    if order:
        others = [c for c in records.columns if c not in ("namespace", "id")]
        records = (records.groupBy("namespace", "id").agg(F.max_by(F.struct(*others), order).alias("r"))
                   .select("namespace", "id", "r.*").drop(order))
    return delete_by_id(vectors, records).unionByName(records, allowMissingColumns=True)


def fetch_by_ids(vectors: DataFrame, ids: DataFrame) -> DataFrame:
    return vectors.join(ids.select("namespace", "id"), ["namespace", "id"], "left_semi").select(*vectors.columns)


def namespace_stats(vectors: DataFrame) -> DataFrame:
    return vectors.groupBy("namespace").agg(
        F.count(F.lit(1)).alias("total_vectors"), F.max(F.size("embedding")).alias("dimension"))


def list_namespaces(vectors: DataFrame) -> DataFrame:
    return vectors.select("namespace").distinct()


def health_summary(vectors: DataFrame) -> DataFrame:
    """Two steps, so that counting namespaces needs no set of names in one task."""
    return namespace_stats(vectors).agg(
        F.coalesce(F.sum("total_vectors"), F.lit(0)).alias("total_vectors"),
        F.count(F.lit(1)).alias("namespaces")).select(F.lit("healthy").alias("status"), "total_vectors", "namespaces")


def verify_checksum(blobs: DataFrame, checksums: DataFrame) -> DataFrame:
    """Add ``valid`` to archives (path, content BINARY) by their recorded SHA-256."""
    actual = F.sha2("content", 256)
    return blobs.join(checksums.select("path", "archive_sha256"), "path", "left").withColumn(
        "valid", F.coalesce(actual == F.col("archive_sha256"), F.lit(False))).drop("archive_sha256")


def restore_vectors(vectors: DataFrame, archived: DataFrame, restored_at: str) -> tuple[DataFrame, DataFrame]:
    """(table, report): upsert archived vectors, stamped with the given ISO time.

    Of several vectors with one id the last of the last document wins. Metadata that the table
    does not have is added to it as new columns where an archive holds any.
    """
    if "place" in archived.columns:
        archived = archived.withColumn("order", F.struct(*[c for c in ("path", "place") if c in archived.columns])).drop("path", "place")
    known = {*vectors.columns, "id", "order"}
    extra = [c for c in archived.columns if c not in known]
    held = archived.agg(*[F.count(c).alias(c) for c in extra]).first() if extra else ()
    archived = archived.drop(*[c for c, n in zip(extra, held) if not n])
    stamped = archived.withColumn("restored_at", F.lit(restored_at))
    base = vectors if "restored_at" in vectors.columns \
        else vectors.withColumn("restored_at", F.lit(None).cast("string"))
    report = stamped.groupBy("repo_name", "commit_sha").agg(F.count(F.lit(1)).alias("vectors_restored"))
    return upsert_by_id(base, stamped, "order" if "order" in stamped.columns else None), report


def activate_commit(vectors: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(table, report): make the target commit of each repository live and all others not.

    ``targets``: (repo_name, commit_sha), one commit per repository. The report counts
    rows live before (all are switched off first) and rows of the target commit.
    """
    wanted = targets.select("repo_name", F.col("commit_sha").alias("live_sha"))
    rows = vectors.join(wanted, "repo_name", "left")
    hit, touched = F.col("commit_sha") == F.col("live_sha"), F.col("live_sha").isNotNull()
    table = rows.withColumn("live", F.when(touched & F.coalesce(hit, F.lit(False)), True)
                            .when(touched & F.col("live"), False).otherwise(F.col("live"))).select(*vectors.columns)
    report = rows.where(touched).groupBy("repo_name").agg(
        F.count_if("live").alias("deactivated_count"), F.count_if(hit).alias("activated_count"))
    return table, report
