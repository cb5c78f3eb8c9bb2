"""Readers and writers of plain files: sources, change lists, error logs, archives."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakesearch.functions.text import is_blank, strip


def decode_lossy(content: Column) -> Column:
    """Bytes as UTF-8 text without the undecodable ones."""
    return F.replace(F.make_valid_utf8(content.cast("string")), F.lit("�"), F.lit(""))


def below(spark: SparkSession, root: str, path: Column) -> Column:
    """A file's path relative to ``root``, as change lists name it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    whole = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()
    bare = "/" + re.sub(r"^[a-z0-9]+:/+", "", whole).strip("/") + "/"
    local = F.concat(F.lit("/"), F.regexp_replace(path, "^[a-z0-9]+:/+", ""))
    return F.when(local.startswith(bare), F.substring(local, len(bare) + 1, 2**31 - 1)).otherwise(path)


def read_files(spark: SparkSession, root: str, repo_name: str, glob: str = "*") -> DataFrame:
    """Whole files below ``root`` as (repo_name, file_path, content, size_bytes), paths relative to ``root``."""
    blobs = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", glob).load(root))
    return blobs.select(F.lit(repo_name).alias("repo_name"), below(spark, root, F.col("path")).alias("file_path"),
                        decode_lossy(F.col("content")).alias("content"), F.col("length").alias("size_bytes"))


def read_change_list(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines of a change list, as (line)."""
    return spark.read.text(path).select(strip(F.col("value")).alias("line")).where(~is_blank(F.col("line")))


ERROR_SCHEMA = "file_path string, operation string, message string, status string"


def read_error_log(spark: SparkSession, path: str) -> DataFrame:
    """Errors to retry as (status, path): malformed lines and lines without a path are
    skipped, an absent or unknown status counts as M."""
    status = F.upper(F.coalesce("status", F.lit("M")))
    return (spark.read.schema(ERROR_SCHEMA).option("mode", "DROPMALFORMED").json(path)
            .where("file_path is not null and file_path <> ''")
            .select(F.when(status.isin("A", "M", "D"), status).otherwise("M").alias("status"),
                    F.col("file_path").alias("path")))


def append_error_log(errors: DataFrame, path: str) -> None:
    """Append (file_path, operation, message, status) rows; a null status is left out."""
    errors.select("file_path", "operation", "message", "status").write.mode("append").json(path)


#: Metadata of the vector table that an archive may hold.
METADATA = """namespace string, repo_name string, file_path string, file_type string, language string, chunk_index int,
    chunk_type string, chunk_id string, content string, line_start int, line_end int, line_range string, token_count int,
    embedded boolean, should_embed boolean, status string, commit_sha string, live boolean, code_complexity double,
    function_names array<string>, class_names array<string>"""


def read_archive_blobs(spark: SparkSession, root: str, glob: str = "archive*.json") -> DataFrame:
    """Archive files as (path, content BINARY). An archive may come in several parts, each a
    document with its own checksum, so that a large one is read by several tasks."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
            .load(root).select("path", "content"))


def read_checksums(spark: SparkSession, root: str) -> DataFrame:
    """(path of the archive, archive_sha256) from the ``checksums*.json`` files beside them."""
    rows = (spark.read.schema("archive_sha256 string").option("multiLine", "true")
            .option("recursiveFileLookup", "true").option("pathGlobFilter", "checksums*.json").json(root))
    return rows.select(F.regexp_replace(F.col("_metadata.file_path"), r"checksums([^/]*)\.json$", "archive$1.json")
                       .alias("path"), "archive_sha256")


def read_archive(blobs: DataFrame, metadata: str = METADATA) -> DataFrame:
    """Vectors of archive documents: (path, place, id, embedding, metadata fields).

    ``metadata`` (DDL) names the fields to read; ``place`` is a vector's place in its document.
    """
    kinds = F.from_json(F.lit("{}"), metadata)
    inner = blobs.select(kinds.alias("m")).schema["m"].dataType.simpleString()
    document = F.from_json(F.col("content").cast("string"), f"vectors array<struct<id: string, `values`: array<float>, metadata: {inner}>>")
    return (blobs.select("path", F.posexplode(document["vectors"]).alias("place", "v"))
            .select("path", "place", "v.id", F.col("v.values").alias("embedding"), "v.metadata.*"))


def list_archives(paths: DataFrame, repo_name: str | None = None) -> DataFrame:
    """Distinct commits below ``vectors/<repo>/``, newest sha first within each repository."""
    found = paths.select(F.regexp_extract("path", "vectors/(.+)/([^/]+)/[^/]+$", 1).alias("repo_name"),
                         F.regexp_extract("path", "vectors/(.+)/([^/]+)/[^/]+$", 2).alias("commit_sha")).distinct()
    found = found.where(F.col("commit_sha") != "")
    if repo_name is not None:
        found = found.where(F.col("repo_name") == repo_name)
    return found.withColumn("prefix", F.concat(F.lit("vectors/"), "repo_name", F.lit("/"), "commit_sha", F.lit("/"))) \
        .orderBy("repo_name", F.desc("commit_sha"))
