"""Conversations and the repository catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakesearch.functions.text import strip

KEEP = 50
TITLE, SAVED_TITLE = 30, 50
WARN_LENGTH, ERROR_LENGTH, LENGTH_LIMIT = 3000, 3500, 4000


def fold_conversation(turns: DataFrame) -> DataFrame:
    """One row per conversation with its turns in order."""
    message = F.struct("turn", "role", F.col("text").alias("content"))
    return turns.groupBy("conv_id").agg(F.transform(
        F.array_sort(F.collect_list(message)),
        lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))


def conversation_title(turns: DataFrame) -> DataFrame:
    """Title at start (first user query) and at save (first message, cut with dots)."""
    first_query = F.min_by("text", F.when(F.col("role") == "user", F.col("turn")))
    first = F.min_by("text", "turn")
    return turns.groupBy("conv_id").agg(first_query.alias("query"), first.alias("first")).select(
        "conv_id", F.left(strip(F.col("query")), F.lit(TITLE)).alias("title"),
        F.concat(F.left("first", F.lit(SAVED_TITLE)),
                 F.when(F.length("first") > SAVED_TITLE, "...").otherwise("")).alias("saved_title"))


def upsert_conversation(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Replace conversations in place by id; new ones go to the front.

    Both sides have (user_id, conv_id, pos, title). A later incoming row of one user
    comes before an earlier one, so new rows get positions below the smallest stored.
    """
    key = ["user_id", "conv_id"]
    latest = incoming.groupBy(*key).agg(F.max("pos").alias("new_pos"), F.max_by("title", "pos").alias("new_title"))
    start = stored.groupBy("user_id").agg(F.min("pos").alias("start"))
    both = stored.join(latest, key, "full_outer").join(start, "user_id", "left")
    return both.select(
        *key, F.coalesce("pos", F.coalesce("start", F.lit(0)) - 1 - F.col("new_pos")).alias("pos"),
        F.coalesce("new_title", "title").alias("title"))


def keep_recent_conversations(stored: DataFrame, k: int = KEEP) -> DataFrame:
    """The first ``k`` conversations of each user."""
    order = Window.partitionBy("user_id").orderBy("pos", "conv_id")
    return stored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


FENCE = r"(?s)```(\w+)?\n(.*?)```"


def extract_code_blocks(messages: DataFrame) -> DataFrame:
    """Fenced blocks of each message: (conv_id, turn, block, language, code)."""
    languages = F.regexp_extract_all("text", F.lit(FENCE), F.lit(1))
    codes = F.regexp_extract_all("text", F.lit(FENCE), F.lit(2))
    blocks = F.arrays_zip(languages.alias("language"), codes.alias("code"))
    language = F.col("found.language")
    return messages.select("conv_id", "turn", F.posexplode(blocks).alias("block", "found")).select(
        "conv_id", "turn", "block", F.when(F.coalesce(language, F.lit("")) == "", "text").otherwise(language)
        .alias("language"), F.col("found.code").alias("code"))


def extract_inline_code(messages: DataFrame) -> DataFrame:
    """Single-backtick spans outside fences: (conv_id, turn, span, code)."""
    outside = F.regexp_replace("text", FENCE, "")
    return messages.select("conv_id", "turn", F.posexplode(
        F.regexp_extract_all(outside, F.lit("`([^`]+)`"), F.lit(1))).alias("span", "code"))


def length_band(text: Column) -> Column:
    return (F.when(F.length(text) > ERROR_LENGTH, "error")
            .when(F.length(text) > WARN_LENGTH, "warning").otherwise("normal"))


def message_length_band(messages: DataFrame) -> DataFrame:
    return messages.select("conv_id", "turn", F.length("text").alias("n_chars"), length_band(F.col("text")).alias("band"),
                           (F.length("text") > LENGTH_LIMIT).alias("over_limit"))


def request_from_message(messages: DataFrame) -> DataFrame:
    """User messages with a selected ``repo`` → request rows; no selection means all."""
    query = strip(F.col("text"))
    chosen = F.coalesce("repo", F.lit(""))
    return messages.where(query != "").select(
        "conv_id", "turn", query.alias("query"),
        F.when(chosen != "", F.array(chosen)).otherwise(F.array().cast("array<string>")).alias("repositories"))


def repository_catalogue(repos: DataFrame, prefix: str = "") -> DataFrame:
    """Distinct names in first-seen order, with a display name free of ``prefix``."""
    distinct = repos.groupBy("name").agg(F.min("pos").alias("pos"))
    name = F.col("name")
    display = F.when(name.startswith(prefix), F.substring(name, len(prefix) + 1, 2**31 - 1)).otherwise(name)
    return distinct.select("name", "pos", display.alias("display_name"))
