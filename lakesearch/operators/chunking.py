"""Chunking operators: files (repo_name, file_path, content, size_bytes) → chunks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from lakesearch.functions import chunkers as K
from lakesearch.functions.file_types import chunk_route, code_language, file_type
from lakesearch.functions.text import count_tokens, is_blank, let


def chunks_of(path: Column, content: Column, size_bytes: Column, route: Column, kind: Column) -> Column:
    """The chunks of one file by its route; a file that yields none gets a summary."""
    structured = (F.when(route == "code", K.code_chunks(content))
                  .when(route == "markdown", K.markdown_chunks(content))
                  .when(route == "json", K.json_chunks(content))
                  .when(route == "yaml", K.yaml_chunks(content)))
    parsed = F.when(~is_blank(content), F.coalesce(structured, K.sentence_chunks(content)))
    return F.when(route == "table", K.table_preview(path, content)).otherwise(
        let(parsed, lambda c: F.when(F.size(c) > 0, c).otherwise(K.summary_chunk(path, kind, size_bytes, content))))


def explode_chunks(files: DataFrame, chunks: str = "chunks") -> DataFrame:
    """One row per chunk, numbered from 0; blank chunks are dropped but keep their number."""
    others = [c for c in files.columns if c != chunks]
    return (files.select(*others, F.posexplode(chunks).alias("chunk_index", "content"))
            .where(~is_blank(F.col("content"))))


def chunk_files(files: DataFrame, tokens: Callable[[Column], Column] = count_tokens) -> DataFrame:
    """All chunk rows of the files, with type, language, route, line span and token count.
    ``tokens`` may be a ``token_counter`` of an external tokenizer.

    Spans are found per file before the chunks are exploded, so no chunk row carries its
    file's text. One projection and one generator: no shuffle, no second scan.
    """
    path, content = F.col("file_path"), F.col("content")
    typed = files.select("*", file_type(path, content).alias("file_type"), code_language(path).alias("language"),
                         chunk_route(path).alias("route"))
    chunks = chunks_of(path, content, F.col("size_bytes"), F.col("route"), F.col("file_type"))
    located = let(K.search_lines(content), lambda lines: F.transform(
        chunks, lambda c: F.struct(c.alias("content"), K.line_span(c, lines).alias("span"))))
    kept = [c for c in files.columns if c not in ("content", "size_bytes")]
    return (typed.select(*kept, "file_type", "language", "route", F.posexplode(located).alias("chunk_index", "c"))
            .select(*kept, "file_type", "language", "route", "chunk_index", F.col("c.content").alias("content"),
                    F.col("c.span.first").alias("line_start"), F.col("c.span.last").alias("line_end"),
                    tokens(F.col("c.content")).alias("token_count"), F.lit(True).alias("should_embed"))
            .where(~is_blank(F.col("content"))))


def line_range(first: Column, last: Column) -> Column:
    return F.concat(F.lit("L"), first, F.lit("-L"), last)


def chunk_detail(files: DataFrame) -> DataFrame:
    """Content, type, first and last line and language of each chunk; a file that could not
    be read (null content) gives one ``error`` chunk."""
    readable = chunk_files(files.where("content is not null")).select(
        "repo_name", "file_path", "chunk_index", "content",
        K.chunk_kind(F.col("content"), F.col("language")).alias("type"),
        F.col("line_start").alias("start_line"), F.col("line_end").alias("end_line"), "language")
    broken = files.where("content is null").select(
        "repo_name", "file_path", F.lit(0).alias("chunk_index"),
        F.concat(F.lit("Error reading "), F.substring_index("file_path", "/", -1)).alias("content"),
        F.lit("error").alias("type"), F.lit(0).alias("start_line"), F.lit(0).alias("end_line"),
        F.lit("").alias("language"))
    return readable.unionByName(broken)


def chunk_stats(chunks: DataFrame) -> DataFrame:
    """Files, chunks and tokens per route and language.

    Chunk rows are first reduced per file, which the hash of the file spreads evenly, so
    the distinct count of files needs no set per group.
    """
    per_file = chunks.groupBy("route", "language", "repo_name", "file_path").agg(
        F.count(F.lit(1)).alias("n"), F.sum("token_count").alias("tokens"))
    return per_file.groupBy("route", "language").agg(
        F.count(F.lit(1)).alias("files"), F.sum("n").alias("chunks"), F.sum("tokens").alias("tokens"))
