"""Embedding and record assembly."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lakesearch.functions import identity as I
from lakesearch.functions.chunkers import MAX_TOKENS
from lakesearch.functions.file_types import index_language
from lakesearch.functions.numbering import numbered
from lakesearch.functions.text import is_blank, sorted_set
from lakesearch.operators.chunking import line_range
from lakesearch.operators.vectors import upsert_by_id

SYNC_BATCH, RESTORE_BATCH = 10, 100
MODEL_BATCH = 256

Model = Callable[[list[str]], list[list[float]]]


def embed_texts(rows: DataFrame, load_model: Callable[[], Model], text: str = "content",
                batch: int = MODEL_BATCH) -> DataFrame:
    """Add ``embedding`` and ``embed_error`` by an external model, in Arrow batches.

    ``load_model`` runs once per task. Blank texts and empty answers are errors of their
    row and leave an empty vector.
    """
    schema = T.StructType([*rows.schema.fields, T.StructField("embedding", T.ArrayType(T.FloatType())),
                           T.StructField("embed_error", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for frame in frames:
            texts = frame[text].fillna("")
            asked = texts.str.strip() != ""
            vectors: list[list[float]] = []
            for start in range(0, int(asked.sum()), batch):
                part = texts[asked].iloc[start:start + batch].tolist()
                got = model(part)
                if len(got) != len(part):
                    raise ValueError(f"the model gave {len(got)} vectors for {len(part)} texts")
                vectors.extend(got)
            answers = iter(vectors)
            out = [next(answers) if a else [] for a in asked]
            errors = ["Empty text provided for embedding" if not a else None if len(v) else "Received empty embedding"
                      for a, v in zip(asked, out)]
            yield frame.assign(embedding=out, embed_error=errors)

    return rows.mapInPandas(run, schema)


def hash_embed(rows: DataFrame, text: str = "content") -> DataFrame:
    """Fill in the hash embedding where no embedding is present; a null text gets none."""
    stand_in = I.hash_embedding(F.col(text))
    present = F.coalesce("embedding", stand_in) if "embedding" in rows.columns else stand_in
    return rows.withColumn("embedding", F.coalesce(present, F.array().cast("array<float>")))


def embed_gate(chunks: DataFrame, embed: Callable[[DataFrame, str], DataFrame] = hash_embed,
               max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Embed chunks that ask for it and fit the model; the others keep an empty vector.

    The text is nulled for the others, so one pass over the chunks serves both.
    """
    fits = F.col("should_embed") & (F.col("token_count") <= max_tokens) & ~is_blank(F.col("content"))
    rows = embed(chunks.withColumn("embed_text", F.when(fits, F.col("content"))), "embed_text")
    return rows.withColumn("embedded", F.size("embedding") > 0).drop("embed_text", "embed_error")


def content_chunk_id(chunks: DataFrame) -> DataFrame:
    made = I.content_chunk_id(F.col("repo_name"), F.col("file_path"), F.col("content"))
    given = F.nullif(F.col("id"), F.lit("")) if "id" in chunks.columns else F.lit(None)
    return chunks.withColumn("id", F.coalesce(given, made))


def stable_record_id(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("id", I.stable_record_id(F.col("repo_name"), F.col("file_path"), F.col("chunk_index"),
                                                      F.col("content")))


def positional_id(rows: DataFrame, order: list[str]) -> DataFrame:
    """``<repo>_<sha>_<n>`` by position in the batch, where no id is given."""
    given = F.nullif(F.col("id"), F.lit("")) if "id" in rows.columns else F.lit(None)
    placed = numbered(rows, ["repo_name", "commit_sha"], order)
    return placed.withColumn("id", F.coalesce(given, F.concat_ws("_", "repo_name", "commit_sha", "position"))) \
        .drop("position")


# How a chunk names what it defines, and what makes it complex. The characters before are spelled out,
# as engines differ in what a word boundary is.
_BEFORE = r"(?:^|[^\p{L}\p{N}_])"
FUNCTION_NAME = _BEFORE + r"(?:def|function|fn|func)\s+([A-Za-z_][A-Za-z0-9_]*)"
CLASS_NAME = _BEFORE + r"class\s+([A-Za-z_][A-Za-z0-9_]*)"
BRANCH = _BEFORE + r"(?:if|elif|for|while|case|switch|catch|except)[\s(:{]"
BRANCHES_OF_COMPLEX = 10.0


def defined_names(content: Column, pattern: str) -> Column:
    return sorted_set(F.regexp_extract_all(content, F.lit(pattern), F.lit(1)))


def code_complexity(content: Column) -> Column:
    """Branches of a chunk as a share of those of a complex one, 1.0 at most."""
    return F.least(F.lit(1.0), F.regexp_count(content, F.lit(BRANCH)) / F.lit(BRANCHES_OF_COMPLEX))


def sync_record(chunks: DataFrame) -> DataFrame:
    """The record of the sync path; ``chunks`` are embedded and carry ``status``. It has all columns that the
    searches read; a synced chunk is live."""
    sha = F.col("commit_sha") if "commit_sha" in chunks.columns else F.lit(None).cast("string")
    return stable_record_id(chunks).select(
        "id", F.col("repo_name").alias("namespace"), "repo_name", "file_path", "file_type", "language", "chunk_index",
        F.when(F.col("should_embed"), "content").otherwise("summary").alias("chunk_type"),
        F.col("id").alias("chunk_id"), "content", "line_start", "line_end",
        line_range(F.col("line_start"), F.col("line_end")).alias("line_range"),
        "embedded", "should_embed", "status", "token_count", sha.alias("commit_sha"), F.lit(True).alias("live"),
        code_complexity(F.col("content")).alias("code_complexity"),
        defined_names(F.col("content"), FUNCTION_NAME).alias("function_names"),
        defined_names(F.col("content"), CLASS_NAME).alias("class_names"), "embedding")


def enriched_record(chunks: DataFrame, enrichment: DataFrame, timestamps: DataFrame | None = None) -> DataFrame:
    """Base metadata plus optional enhanced fields, with defaults for what is missing.

    ``enrichment``: (repo_name, file_path, chunk_index, semantic_types, functions, classes,
    complexity, token_count, language, content_length), any of the last seven null.
    ``timestamps``: (repo_name, file_path, modified).
    """
    extra = enrichment.select(
        "repo_name", "file_path", "chunk_index", "semantic_types", "functions", "classes", "complexity",
        F.col("token_count").alias("tokens"), F.col("language").alias("language_detected"), "content_length",
        F.lit(True).alias("enriched"))
    rows = content_chunk_id(chunks).drop("language", "token_count").join(
        extra, ["repo_name", "file_path", "chunk_index"], "left")
    rows = rows.join(timestamps, ["repo_name", "file_path"], "left") if timestamps is not None \
        else rows.withColumn("modified", F.lit(None).cast("string"))

    def filled(name: str, default: Column) -> Column:
        return F.when(F.col("enriched"), F.coalesce(name, default))

    return rows.select(
        "id", "repo_name", "file_path", "chunk_index", F.coalesce("content", F.lit("")).alias("content"),
        F.coalesce("summary", F.lit("")).alias("chunk_summary"), F.col("id").alias("chunk_id"),
        index_language(F.col("file_path")).alias("language"), F.coalesce("modified", F.lit("")).alias("timestamp"),
        F.coalesce("line_start", F.lit(0)).alias("line_start"), F.coalesce("line_end", F.lit(0)).alias("line_end"),
        F.coalesce("chunk_type", F.lit("code")).alias("chunk_type"),
        filled("semantic_types", F.lit("")).alias("semantic_types"), filled("functions", F.lit("")).alias("functions"),
        filled("classes", F.lit("")).alias("classes"), filled("complexity", F.lit(0.0)).alias("code_complexity"),
        filled("tokens", F.lit(0)).alias("token_count"), filled("language_detected", F.lit("")).alias("language_detected"),
        filled("content_length", F.length(F.coalesce("content", F.lit("")))).alias("content_length"), "embedding")


def upsert_batches(records: DataFrame, order: list[str], size: int = SYNC_BATCH) -> DataFrame:
    """Number the records of each repository into batches of ``size``, in ``order``."""
    return numbered(records, ["repo_name"], order).withColumn(
        "batch", F.floor(F.col("position") / size)).drop("position")


def reject_empty_vectors(records: DataFrame, order: list[str], size: int = SYNC_BATCH) -> tuple[DataFrame, DataFrame]:
    """(kept, errors): a content record with an empty vector fails its whole batch.

    Batches are numbered on the keys alone; if no record is bad, nothing is joined away.
    One error per distinct (file, status) of a failed batch.
    """
    bad = (F.col("chunk_type") == "content") & (F.coalesce(F.size("embedding"), F.lit(0)) <= 0)
    keys = upsert_batches(records.select("repo_name", "id", "file_path", "status", *[
        c for c in order if c not in ("repo_name", "id", "file_path", "status")], bad.alias("bad")), order, size)
    failed = keys.groupBy("repo_name", "batch").agg(F.max("bad").alias("bad"), F.min(
        F.when(F.col("bad"), F.struct(*order, F.col("file_path").alias("cause")))).alias("first_bad")).where("bad")
    lost = keys.drop("bad").join(failed, ["repo_name", "batch"])
    errors = lost.select("repo_name", "batch", "file_path", "status", F.col("first_bad.cause").alias("cause")) \
        .distinct().select("repo_name", "batch", F.coalesce("file_path", F.lit("<unknown>")).alias("file_path"),
                F.lit("upsert").alias("operation"),
                F.concat(F.lit("Attempted to upsert empty embedding: "), "cause").alias("message"), "status")
    kept = records.join(lost.select("repo_name", "id"), ["repo_name", "id"], "left_anti")
    return kept, errors


def store_many(vectors: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(table, report): upsert enriched records by id and report how many were stored."""
    return upsert_by_id(vectors, records, "stored_order"), records.agg(F.count(F.lit(1)).alias("stored"))
