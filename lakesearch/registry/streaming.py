"""Streaming queries: the derived feeds are written as files and streamed from there."""

from pyspark.sql import functions as F

from lakesearch.registry import vectors as V
from lakesearch.registry.changes import ORACLES as CHANGE_ORACLES
from lakesearch.registry.chunking import files
from lakesearch.registry.fixtures import cte, fixture
from lakesearch.session import work_path
from lakesearch.sources.vector_table import read_vectors, write_vectors
from lakesearch.streaming import feeds as M


FEED_FILES = 4


def _stream(spark, name, *frames):
    """Each frame is appended to a folder, which is then read as a stream."""
    path = work_path(spark, name)
    for frame in frames:
        frame.write.mode("append").parquet(path)
    return spark.readStream.schema(frames[0].schema).parquet(path)


def stream_change_feed(spark, sf):
    """The changes of the sync query, in two micro-batches."""
    path = work_path(spark, "vectors")
    write_vectors(V._stored(spark, sf), path, V.BUCKETS)
    changes = V.sync_changes(spark, sf)
    feed = work_path(spark, "feed")
    for half in (0, 1):  # one path's changes are in one file, and a trigger takes the files of one half
        changes.where(F.col("seq") % 2 == half).repartition(FEED_FILES, "repo_name", "path").write.mode("append").parquet(feed)
    stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", FEED_FILES).parquet(feed)
    M.stream_change_feed(stream, files(spark, sf).drop("doc_id"), path, work_path(spark, "checkpoint"),
                         buckets=V.BUCKETS).awaitTermination()
    return V.table_summary(read_vectors(spark, path))


def stream_commit_ranges(spark, sf):
    """Every event comes twice."""
    events = fixture(spark, sf, "ci_events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = work_path(spark, "ranges")
    M.write_available(M.stream_commit_ranges(_stream(spark, "events", events, events)), out, work_path(spark, "checkpoint"))
    return spark.read.parquet(out).drop("ts")


def stream_error_counts(spark, sf):
    lines = fixture(spark, sf, "error_lines").select(F.col("ts").cast("timestamp").alias("ts"), "line")
    out = work_path(spark, "counts")
    M.write_updates(M.stream_error_counts(M.parse_errors(_stream(spark, "errors", lines))), out, work_path(spark, "checkpoint"))
    return M.read_updates(spark, out, ["window_start", "window_end", "operation"])


QUERIES = {f.__name__: f for f in (stream_change_feed, stream_commit_ranges, stream_error_counts)}

ORACLES = {
    "stream_change_feed": V.sync_sql(8192) + V.SUMMARY_SQL,
    "stream_commit_ranges": CHANGE_ORACLES["resolve_commit_range"],
    "stream_error_counts": cte("error_lines") + """, e as (select ts, line ->> 'operation' as operation from error_lines where json_valid(line)),
w as (select time_bucket(interval '1 hour', ts) as window_start, operation, count(*) as errors from e group by all)
select window_start, window_start + interval '1 hour' as window_end, operation, errors from w""",
}
