"""End-to-end searches composed from the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from lakesearch.operators import retrieval as R
from lakesearch.operators.analysis import analyze_query
from lakesearch.operators.embedding import Model, embed_texts
from lakesearch.session import spread, staged

Embed = Callable[[DataFrame], DataFrame]


def text_embedder(load_model: Callable[[], Model], text: str) -> Embed:
    """An ``Embed`` that asks the model once per distinct text: most probe texts recur in
    every namespace. Texts the model gives no vector for drop out of the search."""
    def embed(rows: DataFrame) -> DataFrame:
        answers = embed_texts(rows.select(text).distinct(), load_model, text)
        vectors = staged(answers.where("embed_error is null").select(text, F.col("embedding").alias("qvec")), "qvecs")
        return rows.join(vectors, text)

    return embed


def plan_probes(requests: DataFrame, vectors: DataFrame, profiles: DataFrame, mapping: DataFrame,
                embed: Embed, defaults: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(probes, targets): embedded probes, and the (query, namespace) rows behind them.

    Both are written once: every search step reads them, and the model must not be asked
    the same texts again. Probes carry what searches use and their text; the analysis of a
    question, which is the same for all its probes, stays in ``targets``.
    """
    asked = spread(requests.where(F.coalesce("query", F.lit("")) != ""))
    targets = staged(R.resolve_namespaces(analyze_query(asked), vectors, mapping, defaults), "targets")
    embedded = embed(R.expand_probe_text(R.strategy_probes(targets, profiles)))
    probes = staged(embedded.select(*R.PROBE_COLUMNS, "term", "probe_text", "need", "k", "qvec"), "probes")
    return probes, targets


def agentic_search(requests: DataFrame, vectors: DataFrame, profiles: DataFrame, mapping: DataFrame,
                   embed: Embed, embed_query: Embed, defaults: list[str] = ()) -> DataFrame:
    """Analysis → namespaces → probes → matches → de-duplication → ten best per query."""
    return searched(requests, vectors, profiles, mapping, embed, embed_query, defaults)[0]


def searched(requests: DataFrame, vectors: DataFrame, profiles: DataFrame, mapping: DataFrame,
             embed: Embed, embed_query: Embed, defaults: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(matches of ``agentic_search``, targets), for answers that also tell where was searched.

    ``embed`` adds ``qvec`` to probes by their text, ``embed_query`` to requests. The ten best are written once, as the
    fallback reads them twice, and their size then decides how they are joined. A query that has a match has one among them.
    """
    probes, targets = plan_probes(requests, vectors, profiles, mapping, embed, defaults)
    matches = R.boosted_rank(R.dedupe_first_seen(R.union_provenance(vectors, probes, profiles)))
    basic = embed_query(targets.select("query_id", "query", "query_type", "namespace", "namespace_ord")).drop("query")
    return R.fallback_basic(staged(R.final_top10(matches), "best"), vectors, basic, R.final_top10), targets


def all_namespace_search(requests: DataFrame, vectors: DataFrame) -> DataFrame:
    """Clamp → best per namespace → score threshold → best over all namespaces.

    ``requests``: (query_id, query, top_k, per_ns_k, min_score, qvec); blank questions are
    left out here and reported by ``clamp_request``.
    """
    valid = R.clamp_request(requests).where("error is null").drop("error", "query")
    matches = R.topk_per_namespace(vectors, R.in_every_namespace(valid, vectors))
    return R.topk_merged(R.min_score_filter(matches))
