"""Source and sink queries: each writes data derived from the tables and reads it back."""

from pyspark.sql import functions as F

from lakesearch.functions.text import lines_of
from lakesearch.registry import vectors as V
from lakesearch.registry.fixtures import cte, fixture, table
from lakesearch.session import work_path
from lakesearch.sources import files as S
from lakesearch.sources.vector_table import read_vectors_pruned, write_vectors


def read_files(spark, sf):
    """Documents as text files of at most 200 lines per language, read whole."""
    path = work_path(spark, "files")
    lines = table(spark, sf, "documents").select("lang", F.explode(lines_of(F.col("text"))).alias("value"))
    lines.write.partitionBy("lang").option("maxRecordsPerFile", 200).text(path)
    found = S.read_files(spark, path, "docs", "*.txt")
    lang = F.regexp_extract("file_path", "lang=([^/]+)/", 1)
    return found.groupBy(lang.alias("lang")).agg(
        F.sum(F.size(lines_of(F.col("content"))) - 1).alias("lines"), F.sum(F.length("content")).alias("chars"))


def read_change_list(spark, sf):
    path = work_path(spark, "changes")
    fixture(spark, sf, "change_lines").select(F.when(F.col("seq") % 8 == 0, "  ").otherwise(F.col("line"))).write.text(path)
    return S.read_change_list(spark, path)


def read_error_log(spark, sf):
    path = work_path(spark, "errors")
    fixture(spark, sf, "error_lines").select("line").write.text(path)
    return S.read_error_log(spark, path)


def append_error_log(spark, sf):
    """Two appends to one log."""
    path = work_path(spark, "errors")
    rows = fixture(spark, sf, "error_lines").selectExpr(
        "concat('f', event_id) as file_path", "'process' as operation", "line as message",
        "case when event_id % 2 = 0 then 'A' end as status", "event_id")
    S.append_error_log(rows.where("event_id % 3 = 0"), path)
    S.append_error_log(rows.where("event_id % 3 <> 0"), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def read_archive(spark, sf):
    return S.read_archive(V.archives(spark, sf)).select(
        "id", "namespace", "repo_name", "file_path", "commit_sha", "line_start", "live",
        F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double")), 4).alias("total"))


def list_archives(spark, sf):
    return S.list_archives(fixture(spark, sf, "archive_paths").select("path"))


def read_vectors_pruned_query(spark, sf):
    path = work_path(spark, "vectors")
    write_vectors(fixture(spark, sf, "vectors"), path, V.BUCKETS)
    return read_vectors_pruned(spark, path, ["ns1", "ns4", "ns7"]).select("id", "namespace", "file_path", "line_start", "content")


QUERIES = {f.__name__: f for f in (read_files, read_change_list, read_error_log, append_error_log, read_archive, list_archives)}
QUERIES["read_vectors_pruned"] = read_vectors_pruned_query

ORACLES = {
    "read_files": """select lang, sum(len(string_split(text, chr(10))))::bigint as lines,
  sum(length(text) + 1)::bigint as chars from documents group by all""",
    "read_change_list": cte("change_lines") + "select line from change_lines where seq % 8 <> 0",
    "read_error_log": cte("error_lines") + """select case when upper(line ->> 'status') = 'A' then 'A' when upper(line ->> 'status') = 'D' then 'D' else 'M' end as status,
  line ->> 'file_path' as path from error_lines where json_valid(line)""",
    "append_error_log": cte("error_lines") + """select '{"file_path":"f' || event_id || '","operation":"process","message":' || to_json(line)
  || case when event_id % 2 = 0 then ',"status":"A"' else '' end || '}' as line from error_lines""",
    "read_archive": cte("vectors") + """select id, namespace, repo_name, file_path, commit_sha, line_start, live,
  round(list_sum(embedding::double[]), 4) as total from vectors""",
    "list_archives": cte("archive_paths") + """select distinct repo_name, commit_sha, 'vectors/' || repo_name || '/' || commit_sha || '/' as prefix from archive_paths""",
    "read_vectors_pruned": cte("vectors") + "select id, namespace, file_path, line_start, content from vectors where namespace in ('ns1', 'ns4', 'ns7')",
}
