"""Context, prompt and answer rows built from ranked matches.

Matches are already cut to a handful per query, so the per-query lists stay short. The
chunk text is joined here, for the surviving matches only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SEPARATOR = "\n\n---\n\n"

PLAIN_TEMPLATE = (
    "Answer the developer question below from the listed snippets of code and documentation only.\n\n"
    "Question:\n{question}\n\nSnippets:\n{context}\n\n"
    "Name the files you rely on. If the snippets do not hold the answer, say that it is not in the index.\n")
MARKDOWN_TEMPLATE = (
    "Help a developer understand these repositories.\n\n**Question:** {question}\n\n"
    "**Code and documentation:**\n{context}\n\n"
    "Answer directly, with code examples and practical detail where they help.")


def attach_content(matches: DataFrame, vectors: DataFrame) -> DataFrame:
    """Add content and repo_name to ranked matches (the scan reads those columns only)."""
    return matches.join(vectors.select("namespace", "id", "content", "repo_name"), ["namespace", "id"], "left")


def _joined_blocks(matches: DataFrame, block: Column, rank: str) -> DataFrame:
    blocks = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("rank"), block.alias("block"))))
    return matches.groupBy("query_id").agg(
        F.array_join(F.transform(blocks, lambda b: b["block"]), SEPARATOR).alias("context"))


def context_plain(matches: DataFrame, rank: str = "rank") -> DataFrame:
    """``[File: path]`` blocks in rank order; matches without content are left out."""
    block = F.concat(F.lit("[File: "), F.coalesce("file_path", F.lit("unknown")), F.lit("]\n"), F.col("content"))
    return _joined_blocks(matches.where("content is not null"), block, rank)


def context_markdown(matches: DataFrame, rank: str = "final_rank") -> DataFrame:
    """File, repository and fenced content per match, with defaults for what is missing."""
    block = F.concat(
        F.lit("**File:** "), F.coalesce("file_path", F.lit("N/A")),
        F.lit("\n**Repository:** "), F.coalesce("repo_name", "namespace", F.lit("N/A")),
        F.lit("\n\n```\n"), F.coalesce("content", F.lit("Content not available.")), F.lit("\n```"))
    return _joined_blocks(matches, block, rank)


def build_prompt(requests: DataFrame, contexts: DataFrame, template: str = PLAIN_TEMPLATE) -> DataFrame:
    """(query_id, query, prompt) for the queries that have a context."""
    head, rest = template.split("{question}")
    middle, tail = rest.split("{context}")
    prompt = F.concat(F.lit(head), F.col("query"), F.lit(middle), F.col("context"), F.lit(tail))
    return requests.join(contexts, "query_id").select("query_id", "query", prompt.alias("prompt"))


def answer_footer(targets: DataFrame, matches: DataFrame) -> DataFrame:
    """(query_id, footer): where was searched and how many results were used."""
    places = targets.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("places"), F.min_by("namespace", "namespace_ord").alias("first_place"))
    results = matches.groupBy("query_id").agg(F.count(F.lit(1)).alias("results"))
    where = (F.when(F.col("places") == 1, F.concat(F.lit("Repository: "), F.col("first_place")))
             .when(F.col("places") > 1, F.concat(F.lit("Searched "), F.col("places"), F.lit(" repositories"))))
    found = F.when(F.col("results") > 0, F.concat(F.col("results"), F.lit(" relevant results")))
    return (places.join(results, "query_id", "left")
            .select("query_id", F.concat_ws(" • ", where, found).alias("footer")))


def no_match_rows(requests: DataFrame, matches: DataFrame) -> DataFrame:
    """(query_id, message) for the queries without any match."""
    return requests.join(matches.select("query_id").distinct(), "query_id", "left_anti").select(
        "query_id", F.concat(F.lit("No matches found for: '"), F.coalesce("query", F.lit("")), F.lit("'"))
        .alias("message"))


def attach_answers(requests: DataFrame, matches: DataFrame, footers: DataFrame, answers: DataFrame) -> DataFrame:
    """(query_id, content): the external answer with its footer, else a message."""
    results = matches.groupBy("query_id").agg(F.count(F.lit(1)).alias("results"))
    query = F.concat(F.lit("'"), F.coalesce("query", F.lit("")), F.lit("'"))
    missing = F.concat(F.lit("Response generation unavailable. Found "), F.col("results"),
                       F.lit(" relevant matches for: "), query)
    footed = F.when(F.coalesce("footer", F.lit("")) != "",
                    F.concat(F.col("answer"), F.lit("\n\n---\n*"), F.col("footer"), F.lit("*"))) \
        .otherwise(F.col("answer"))
    content = (F.when(F.col("results").isNull(), F.concat(F.lit("No matches found for: "), query))
               .when(F.col("answer").isNull(), missing).otherwise(footed))
    return (requests.join(results, "query_id", "left").join(footers, "query_id", "left")
            .join(answers.select("query_id", "answer"), "query_id", "left")
            .select("query_id", content.alias("content")))
