"""Structured Streaming forms of the change feed, the CI events and the error log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lakesearch.operators.changes import resolve_commit_range
from lakesearch.operators.embedding import hash_embed
from lakesearch.plans.sync import apply_sync_to_table, prepare_sync
from lakesearch.sources.files import ERROR_SCHEMA
from lakesearch.sources.vector_table import BUCKETS


def stream_change_feed(changes: DataFrame, files: DataFrame, table: str, checkpoint: str,
                       embed: Callable[[DataFrame, str], DataFrame] = hash_embed,
                       buckets: int = BUCKETS) -> StreamingQuery:
    """Apply each micro-batch of (repo_name, seq, ord, status, path) to the vector table.

    A batch is a sync: its changes are collapsed per path, its record ids depend on the
    content alone, and deletes come before upserts. The table's commit records the last batch
    id of this stream (keyed by its checkpoint) with the rows, so a batch replayed after a
    failure is skipped without writing a file.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_sync_to_table(table, prepare_sync(batch, files, embed), buckets, stream=(checkpoint, batch_id))

    return (changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_commit_ranges(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Commit ranges of a stream of CI events (event_id, ts, event_name, env_sha, payload).

    Events delivered again within ``delay`` are dropped; state older than that is freed.
    """
    once = events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])
    return resolve_commit_range(once)


def parse_errors(lines: DataFrame) -> DataFrame:
    """(ts, line) → (ts, file_path, operation, message, status); malformed lines are dropped."""
    return (lines.select("ts", F.from_json("line", ERROR_SCHEMA).alias("e")).select("ts", "e.*")
            .where("operation is not null"))


def stream_error_counts(errors: DataFrame, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Errors per operation and tumbling window. In update mode (``write_updates``) a window is given out
    whenever it has changed, the last ones included; in append mode once it is closed."""
    return (errors.withWatermark("ts", delay).groupBy(F.window("ts", window).alias("w"), "operation")
            .agg(F.count(F.lit(1)).alias("errors"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "operation", "errors"))


def write_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run a stream over what its source holds now, into Parquet files."""
    (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start(path).awaitTermination())


def write_updates(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run an aggregating stream over what its source holds now; each micro-batch writes the rows
    that it changed into a folder of its own, so a batch replayed after a failure replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    (stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def read_updates(spark: SparkSession, path: str, key: list[str]) -> DataFrame:
    """The last state of each ``key`` among the updates below ``path``."""
    rows = spark.read.parquet(path)
    last = F.max_by(F.struct(*[c for c in rows.columns if c not in (*key, "batch")]), "batch")
    return rows.groupBy(*key).agg(last.alias("row")).select(*key, "row.*")
