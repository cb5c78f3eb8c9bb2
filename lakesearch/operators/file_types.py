"""File typing and routing: projections of (file_path, content), no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakesearch.functions import file_types as T


def detect_file_type(files: DataFrame) -> DataFrame:
    return files.withColumn("file_type", T.file_type(F.col("file_path"), F.col("content")))


def detect_code_language(files: DataFrame) -> DataFrame:
    return files.withColumn("language", T.code_language(F.col("file_path")))


def detect_index_language(files: DataFrame) -> DataFrame:
    return files.withColumn("index_language", T.index_language(F.col("file_path")))


def route_chunker(files: DataFrame) -> DataFrame:
    return files.withColumn("route", T.chunk_route(F.col("file_path")))
