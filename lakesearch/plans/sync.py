"""The sync plan: changes → plan → chunks → records → new vector table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lakesearch.operators.changes import build_sync_plan, collapse_changes
from lakesearch.operators.chunking import chunk_files
from lakesearch.operators.embedding import embed_gate, hash_embed, reject_empty_vectors, sync_record
from lakesearch.operators.vectors import delete_by_file, upsert_by_id
from lakesearch.session import staged
from lakesearch.sources.vector_table import BUCKETS, current_commit, only_partitions, read_vectors, with_bucket, write_vectors

RECORD_ORDER = ["file_path", "chunk_index"]
FAILURE_COLUMNS = ["repo_name", "file_path", "operation", "message", "status"]


@dataclass(frozen=True)
class Sync:
    """What one sync does. ``deletes`` and ``records`` change the table; the rest reports."""

    plan: DataFrame
    deletes: DataFrame
    records: DataFrame
    failures: DataFrame
    rejected: DataFrame


def prepare_sync(changes: DataFrame, files: DataFrame, embed: Callable[[DataFrame, str], DataFrame] = hash_embed,
                 max_tokens: int | None = None, safe: bool = False) -> Sync:
    """Only files named by a change are read past the join and chunked.

    Plan and records are written once: they feed the table, the report and the failures,
    and the model behind ``embed`` must not run again. ``safe`` deletes old chunks only of files
    that could be processed or are gone.
    """
    plan = staged(build_sync_plan(collapse_changes(changes), files), "plan")
    todo = plan.where("do_process").select("repo_name", F.col("path").alias("file_path"), "status")
    limits = {} if max_tokens is None else {"max_tokens": max_tokens}
    chunks = chunk_files(files.join(todo, ["repo_name", "file_path"]))
    made = staged(sync_record(embed_gate(chunks, embed, **limits)), "records")
    records, rejected = reject_empty_vectors(made, RECORD_ORDER)
    deletes = plan.where("do_delete").select(F.col("repo_name").alias("namespace"), "repo_name",
                                             F.col("path").alias("file_path"), "status")
    if safe:
        lost = rejected.select("repo_name", "file_path")
        deletes = deletes.join(lost, ["repo_name", "file_path"], "left_anti").unionByName(
            deletes.where("status = 'D'")).distinct()
    return Sync(plan, deletes, records, sync_failures(plan, rejected), rejected)


def sync_failures(plan: DataFrame, rejected: DataFrame, delete_errors: DataFrame | None = None) -> DataFrame:
    """Failures of all stages; any row marks the run as failed."""
    process = plan.where("error is not null").select(
        "repo_name", F.col("path").alias("file_path"), F.lit("process").alias("operation"),
        F.col("error").alias("message"), "status")
    rows = process.unionByName(rejected.select(*FAILURE_COLUMNS))
    return rows if delete_errors is None else rows.unionByName(delete_errors.select(*FAILURE_COLUMNS))


def sync_report(sync: Sync) -> DataFrame:
    """Per repository: processed, skipped, errors, deleted files, upserted chunks."""
    files = sync.plan.groupBy("repo_name").agg(
        F.count_if("do_process").alias("processed"), F.count_if(F.col("error").isNotNull()).alias("skipped"),
        F.count_if("do_delete").alias("deleted_files"))
    batches = (sync.rejected.select("repo_name", "batch").distinct()
               .groupBy("repo_name").agg(F.count(F.lit(1)).alias("failed_batches")))
    upserted = sync.records.groupBy("repo_name").agg(F.count(F.lit(1)).alias("chunks"))
    zero = F.lit(0).cast("bigint")
    return files.join(batches, "repo_name", "left").join(upserted, "repo_name", "left").select(
        "repo_name", "processed", "skipped", (F.col("skipped") + F.coalesce("failed_batches", zero)).alias("errors"),
        "deleted_files", F.coalesce("chunks", zero).alias("chunks_upserted"))


def apply_sync(vectors: DataFrame, sync: Sync) -> DataFrame:
    """The table after the sync: deletes first, then the new records, replaced by id."""
    return upsert_by_id(delete_by_file(vectors, sync.deletes), sync.records)


def apply_sync_to_table(path: str, sync: Sync, buckets: int = BUCKETS, stream: tuple[str, int] | None = None,
                        before_commit=None) -> bool:
    """Apply a sync to a table on disk as a new version, writing only the (namespace, bucket)
    partitions of changed files.

    ``stream`` is (stream id, batch id): a batch whose id the current version already records
    for its stream is skipped, and the id is recorded in the same commit as the rows, so a
    replayed batch writes nothing. Returns whether a version was written.
    """
    spark = sync.plan.sparkSession
    head = current_commit(spark, path)
    if stream is not None and head is not None and head.get("streams", {}).get(stream[0], -1) >= stream[1]:
        return False
    touched = with_bucket(sync.deletes.select("namespace", "file_path").unionByName(
        sync.records.select("namespace", "file_path")), buckets).select("namespace", "bucket").distinct()
    touched = staged(touched, "touched")
    if head is not None:
        stored = only_partitions(read_vectors(spark, path), touched).drop("bucket")
    else:  # the first sync of a new table
        stored = sync.records.limit(0)
    rewritten = staged(with_bucket(apply_sync(stored, sync), buckets), "rewritten")
    rewritten = rewritten.select(*sync.records.columns, "bucket", *[c for c in rewritten.columns if c not in (*sync.records.columns, "bucket")])
    # A partition that lost its last row is named by one row without id, and so emptied.
    emptied = touched.join(rewritten.select("namespace", "bucket").distinct(), ["namespace", "bucket"], "left_anti")
    write_vectors(rewritten.unionByName(emptied, allowMissingColumns=True), path, buckets,
                  streams=None if stream is None else {stream[0]: stream[1]}, before_commit=before_commit)
    return True
