"""Retrieval: probes against the vector table, and the ranking of their matches.

Tables: ``vectors`` (id, namespace, file_path, line_start, code_complexity, content,
function_names, class_names, live, embedding, ...), ``requests`` (query_id, query, qvec,
...), probes and matches as described per function.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakesearch.functions.filters import compile_filter
from lakesearch.functions.numbering import numbered
from lakesearch.functions.text import escape_regex, sorted_set, strip
from lakesearch.operators.analysis import CONTEXTUAL, DIRECT, FILES, SEMANTIC
from lakesearch.operators.topk import top_k
from lakesearch.operators.vectors import list_namespaces
from lakesearch.session import staged

CARRIED = ["id", "file_path", "line_start"]

# Bits a vector has and a probe may need.
TYPE_OK, LOW_COMPLEXITY, HIGH_COMPLEXITY = 1, 2, 4
COMPLEXITY_SPLIT = 0.7


# ---- plain vector search -------------------------------------------------------------

def clamp_request(requests: DataFrame) -> DataFrame:
    """Bounds and defaults of a request; a blank question becomes an error row."""
    def clamp(name: str, default: int, most: int) -> Column:
        return F.greatest(F.lit(1), F.least(F.lit(most), F.coalesce(F.col(name), F.lit(default))))

    score = F.expr("try_cast(min_score as double)")
    query = strip(F.coalesce("query", F.lit("")))
    return requests.withColumns({
        "query": query, "top_k": clamp("top_k", 10, 50), "per_ns_k": clamp("per_ns_k", 5, 20),
        "min_score": F.when(score.between(0, 1), score),
        "error": F.when(query == "", "Question is required and cannot be empty")})


def map_repo_namespace(repos: DataFrame, mapping: DataFrame, column: str = "repo_name") -> DataFrame:
    """Short namespace of known repositories; others keep their name."""
    known = mapping.select(F.col("repo_name").alias(column), F.col("namespace").alias("short"))
    return (repos.join(known, column, "left")
            .withColumn("namespace", F.coalesce("short", column)).drop("short"))


def resolve_namespaces(requests: DataFrame, vectors: DataFrame, mapping: DataFrame,
                       defaults: list[str] = ()) -> DataFrame:
    """One row per (request, namespace to search), with ``namespace_ord``.

    Repositories come from ``repositories`` or, if that is empty, from a single ``repo``. Requested ones are mapped;
    none requested means all present; none present, or only blank names requested, the ``defaults``.
    """
    listed = F.coalesce("repositories", F.array().cast("array<string>"))
    if "repo" in requests.columns:
        single = F.array_compact(F.array(F.nullif(strip(F.col("repo")), F.lit(""))))
        listed = F.when(F.size(listed) > 0, listed).otherwise(single)
    named_ = F.filter(listed, lambda r: r.isNotNull() & (strip(r) != ""))
    asked = requests.withColumns({"listed": F.size(listed), "asked": named_}).drop("repositories", "repo")
    standard = F.array(*[F.lit(d) for d in defaults]).cast("array<string>")
    # Written, so that joins know how few they are.
    present = staged(numbered(list_namespaces(vectors).withColumn("all", F.lit(0)), ["all"], ["namespace"], "namespace_ord").select(
        F.col("namespace").alias("repo"), F.col("namespace_ord").cast("int").alias("namespace_ord")), "namespaces")
    nothing = present.isEmpty()
    chosen = F.when(F.size("asked") > 0, F.col("asked")).when((F.col("listed") > 0) | F.lit(nothing), standard)
    given = asked.where(chosen.isNotNull()).select("*", F.posexplode(chosen).alias("namespace_ord", "repo"))
    everywhere = asked.where(chosen.isNull())
    rows = given.unionByName(_times(everywhere, present))
    named = map_repo_namespace(rows, mapping, "repo")
    return named.withColumn("namespace", F.when(F.size("asked") > 0, F.col("namespace")).otherwise(F.col("repo"))) \
        .drop("asked", "listed", "repo")


TIMES_PARTS = 16


def _times(rows: DataFrame, others: DataFrame) -> DataFrame:
    """Each of ``rows`` with each of ``others``, which is the result asked for, as a hash join on parts:
    ``rows`` fall into parts, and ``others`` are repeated once per part."""
    part = F.pmod(F.xxhash64("query_id"), F.lit(TIMES_PARTS)).cast("int").alias("part")
    return rows.select("*", part).join(
        others.select("*", F.explode(F.sequence(F.lit(0), F.lit(TIMES_PARTS - 1))).alias("part")), "part").drop("part")


def in_every_namespace(requests: DataFrame, vectors: DataFrame) -> DataFrame:
    """One row per (request, namespace)."""
    return _times(requests, list_namespaces(vectors))


def search_scoped(vectors: DataFrame, probes: DataFrame, key: list[str],
                  carry: list[str] = CARRIED) -> DataFrame:
    """Top-k of whole namespaces. ``probes`` has namespace, k, qvec and maybe ``need``."""
    need = F.col("need") if "need" in probes.columns else F.lit(0)
    bits = F.col("bits") if "bits" in vectors.columns else F.lit(0)
    return top_k(vectors.select(F.col("namespace").alias("scope"), "namespace", bits.cast("int").alias("bits"),
                                *carry, "embedding"),
                 probes.withColumn("scope", F.col("namespace"))
                 .withColumn("need", need.cast("int")).withColumn("k", F.col("k").cast("int")), key)


def topk_per_namespace(vectors: DataFrame, requests: DataFrame) -> DataFrame:
    """Best ``per_ns_k`` of every (query_id, namespace) row of ``requests``."""
    return search_scoped(vectors, requests.withColumnRenamed("per_ns_k", "k"), ["query_id", "namespace"])


def min_score_filter(matches: DataFrame) -> DataFrame:
    """Applied after the per-namespace cut; a null or zero threshold keeps all."""
    threshold = F.coalesce("min_score", F.lit(0.0))
    return matches.where((threshold == 0) | (F.col("score") >= threshold))


def topk_merged(matches: DataFrame) -> DataFrame:
    """Best ``top_k`` per query over all namespaces."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "namespace", "id")
    return matches.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= F.col("top_k"))


def search_similar(vectors: DataFrame, requests: DataFrame, k: int = 5, filter_tree: dict | None = None) -> DataFrame:
    """Search of one namespace per request, after an optional metadata filter."""
    kept = vectors.where(compile_filter(filter_tree, vectors.schema)) if filter_tree else vectors
    place = "namespace_ord" if "namespace_ord" in requests.columns else "namespace"
    return search_scoped(kept, requests.withColumn("k", F.lit(k)), ["query_id", place])


def search_live(vectors: DataFrame, requests: DataFrame, k: int = 5, live: bool = False) -> DataFrame:
    return search_similar(vectors, requests, k, {"live": True} if live else None)


def search_basic(vectors: DataFrame, requests: DataFrame, k: int = 5) -> DataFrame:
    """Top k of each requested namespace, no global cut; blank namespaces are skipped."""
    return search_similar(vectors, requests.where("namespace is not null and namespace <> ''"), k)


# ---- probe planning ------------------------------------------------------------------

# Words added to a contextual probe by query class.
CLASS_WORDS = {"example": ["example", "demo", "usage", "how to"],
               "debugging": ["error", "fix", "debug", "issue"],
               "implementation": ["implement", "create", "build"]}
# Confidence and number of results of each strategy, and the boosts of their ranks.
CONFIDENCE = {DIRECT: 0.9, CONTEXTUAL: 0.8, SEMANTIC: 0.7, FILES: 0.95}
RESULTS = {DIRECT: 3, CONTEXTUAL: 5, SEMANTIC: 7, FILES: 3}
DIRECT_BOOST, FILES_BOOST = 1.5, 1.4
FILE_INDICATORS = [".py", ".js", ".html", ".css", ".md", ".json"]


def _no_words() -> Column:
    return F.array().cast("array<string>")


def contextual_keywords(analysis: DataFrame) -> DataFrame:
    """Profile keywords related to the query's terms, plus words of its class.

    Needs ``keywords`` (the profile's) beside the analysis columns.
    """
    terms = F.concat("intent_keywords", "entities")
    related = F.filter(F.coalesce("keywords", _no_words()), lambda k: F.exists(
        terms, lambda t: F.contains(F.lower(k), F.lower(t)) | F.contains(F.lower(t), F.lower(k))))
    extra = _no_words()
    for kind, words in CLASS_WORDS.items():
        extra = F.when(F.col("query_type") == kind, F.array(*[F.lit(w) for w in words])).otherwise(extra)
    return analysis.withColumn("contextual_keywords", sorted_set(F.concat(related, extra)))


def file_patterns(analysis: DataFrame) -> DataFrame:
    """Entities that look like paths; if there are none, query words with a file extension."""
    paths = F.filter("entities", lambda e: F.contains(e, F.lit(".")) | F.contains(e, F.lit("/")))
    words = F.filter(F.split(strip(F.lower("query")), r"\s+"), lambda w: F.exists(
        F.array(*[F.lit(x) for x in FILE_INDICATORS]), lambda x: F.contains(w, x)))
    return analysis.withColumn("file_patterns", F.when(F.size(paths) > 0, paths).otherwise(words))


def strategy_probes(analysis: DataFrame, profiles: DataFrame) -> DataFrame:
    """The strategies to run for each (query, namespace) row of ``analysis``.

    Adds strategy, strategy_ord, confidence, k, need and ``terms``: the terms to search
    one by one, or null for a strategy that searches once.
    """
    rows = file_patterns(contextual_keywords(analysis.join(profiles, "namespace", "left")))

    def strategy(name: str, order: int, need: Column, terms: Column) -> Column:
        return F.struct(F.lit(name).alias("strategy"), F.lit(order).alias("strategy_ord"),
                        F.lit(CONFIDENCE[name]).alias("confidence"), F.lit(RESULTS[name]).alias("k"),
                        need.alias("need"), terms.alias("terms"))

    band = (F.when(F.col("complexity") == "simple", LOW_COMPLEXITY)
            .when(F.col("complexity") == "complex", HIGH_COMPLEXITY).otherwise(0))
    once = F.lit(None).cast("array<string>")
    plan = F.array_compact(F.array(
        F.when(F.size("specific_targets") > 0, strategy(DIRECT, 0, F.lit(0), F.col("specific_targets"))),
        F.when(F.size("contextual_keywords") > 0, strategy(CONTEXTUAL, 1, F.lit(TYPE_OK), once)),
        strategy(SEMANTIC, 2, band + TYPE_OK, once),
        F.when(F.col("query_type") == "file_search",
               strategy(FILES, 3, F.lit(0), F.col("file_patterns")))))
    return rows.drop("confidence").select("*", F.inline(plan))


def expand_probe_text(probes: DataFrame) -> DataFrame:
    """One row per text to embed: adds term, term_pos and probe_text, drops ``terms``."""
    terms = F.coalesce("terms", F.array(F.lit(None).cast("string")))
    rows = probes.select(*[c for c in probes.columns if c != "terms"],
                         F.posexplode(terms).alias("term_pos", "term"))
    name = F.col("strategy")
    first = F.slice(F.coalesce("keywords", _no_words()), 1, 3)
    text = (F.when(name == DIRECT, F.concat_ws(" ", "term", "query"))
            .when(name == CONTEXTUAL, F.concat(F.col("query"), F.lit(" "), F.array_join("contextual_keywords", " ")))
            .when(name == SEMANTIC, F.concat(F.col("query"), F.lit(" "), F.array_join(first, " ")))
            .otherwise(F.concat_ws(" ", F.lit("file"), "term")))
    return rows.withColumn("probe_text", text)


# ---- probe execution -----------------------------------------------------------------

PROBE_KEY = ["query_id", "namespace_ord", "strategy", "term_pos"]
PROBE_COLUMNS = ["query_id", "query_type", "namespace", "namespace_ord", "strategy", "strategy_ord",
                 "confidence", "term_pos"]
PATH_KEY = 8
WORD = r"[\p{L}\p{N}_]+"
NO_WORD = r"[^\p{L}\p{N}_]"
HIT = ["namespace", "strategy", "term", "id"]


def with_bits(vectors: DataFrame, profiles: DataFrame) -> DataFrame:
    """Mark what each vector offers to dense probes: its file type and complexity band."""
    types = profiles.select("namespace", "file_types")
    path = F.lower("file_path")
    type_ok = F.coalesce(F.size("file_types"), F.lit(0)).isin(-1, 0) | F.exists(
        "file_types", lambda t: path.endswith(F.lower(t)))
    level = F.col("code_complexity")
    bits = (F.when(type_ok, TYPE_OK).otherwise(0) + F.when(level < COMPLEXITY_SPLIT, LOW_COMPLEXITY).otherwise(0)
            + F.when(level >= COMPLEXITY_SPLIT, HIGH_COMPLEXITY).otherwise(0))
    return vectors.join(types, "namespace", "left").withColumn("bits", bits).drop("file_types")


def match_terms(vectors: DataFrame, terms: DataFrame) -> DataFrame:
    """(namespace, strategy, term, id) of every vector a term selects.

    ``terms``: (namespace, strategy, term). A direct term selects by path substring, by
    whole word in the content, or by exact function or class name; a file term by path
    substring only. Each test is an equi-join on a piece of the term, so a term meets
    only vectors that share that piece, and the work is linear in the text scanned:

    * path: the first ``PATH_KEY`` characters of the term against all substrings of that
      length (and of the lengths below, for shorter terms) of each distinct path;
    * content: the first word of the term against the distinct words of the content, or the
      first character of a term without words.
    """
    # Written, as four joins read them and the probes they come from are many more.
    terms = staged(terms.where("term <> ''").select("namespace", "strategy", "term").distinct()
                   .withColumn("low", F.lower("term")), "terms")
    wanted = vectors.join(terms.select("namespace").distinct(), "namespace", "left_semi")

    paths = wanted.select("namespace", "file_path").distinct().withColumn("low_path", F.lower("file_path"))
    pieces = F.array_distinct(F.flatten(F.transform(
        F.sequence(F.lit(1), F.length("low_path")),
        lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(PATH_KEY), F.length("low_path") - i + 1)),
                              lambda n: F.substring("low_path", i, n)))))
    by_path = (paths.where("low_path <> ''").withColumn("piece", F.explode(pieces))
               .join(terms.withColumn("piece", F.left("low", F.lit(PATH_KEY))), ["namespace", "piece"])
               .where((F.length("low") <= PATH_KEY) | F.contains("low_path", "low"))
               .select("namespace", "strategy", "term", "file_path"))
    in_path = (wanted.select("namespace", "file_path", "id").join(by_path, ["namespace", "file_path"])
               .select("namespace", "strategy", "term", "id"))

    direct = terms.where(F.col("strategy") == DIRECT)
    # A term without any word is looked up by its first character. The exploded rows are narrow;
    # content is fetched for the candidates that a word alone does not decide.
    low = F.lower("content")
    words = F.array_union(F.regexp_extract_all(low, F.lit(WORD), F.lit(0)), F.regexp_extract_all(low, F.lit(NO_WORD), F.lit(0)))
    first = F.regexp_extract("low", WORD, 0)
    found = (wanted.select("namespace", "id", F.explode(words).alias("word"))
             .join(direct.withColumn("word", F.when(first != "", first).otherwise(F.left("low", F.lit(1)))), ["namespace", "word"]))
    pattern = F.concat(F.lit(r"(?i)\b"), escape_regex(F.col("term")), F.lit(r"\b"))
    in_doubt = (found.where(F.col("low") != F.col("word")).join(wanted.select("namespace", "id", "content"), ["namespace", "id"])
                .where(F.rlike(F.col("content"), pattern)))
    alone = found.where((F.col("low") == F.col("word")) & F.rlike("low", F.lit(WORD)))
    single = (found.where((F.col("low") == F.col("word")) & ~F.rlike("low", F.lit(WORD)))
              .join(wanted.select("namespace", "id", "content"), ["namespace", "id"]).where(F.rlike(F.col("content"), pattern)))
    in_content = alone.select(*HIT).unionByName(in_doubt.select(*HIT)).unionByName(single.select(*HIT))

    names = F.array_union(F.coalesce("function_names", _no_words()), F.coalesce("class_names", _no_words()))
    in_names = (wanted.select("namespace", "id", F.explode(names).alias("term"))
                .join(direct, ["namespace", "term"]).select("namespace", "strategy", "term", "id"))
    return in_path.unionByName(in_content).unionByName(in_names).distinct()


def search_terms(vectors: DataFrame, probes: DataFrame, key: list[str] = PROBE_KEY,
                 carry: list[str] = CARRIED) -> DataFrame:
    """Top-k of each term probe among the vectors its term selects."""
    def scope() -> Column:
        return F.concat_ws("\x01", "namespace", "strategy", "term")

    hits = staged(match_terms(vectors, probes.select("namespace", "strategy", "term")), "term_hits")
    # A vector is joined once, however many terms select it.
    by_vector = hits.groupBy("namespace", "id").agg(F.collect_list(scope()).alias("scopes"))
    chosen = vectors.select("namespace", *carry, "embedding").join(by_vector, ["namespace", "id"])
    return top_k(chosen.select(F.explode("scopes").alias("scope"), "namespace", F.lit(0).alias("bits"), *carry, "embedding"),
                 probes.withColumn("scope", scope()).drop("term"), key)


def _term_strategy(vectors: DataFrame, probes: DataFrame, name: str) -> DataFrame:
    return search_terms(vectors, probes.where(F.col("strategy") == name)
                        .select(*PROBE_COLUMNS, "term", "need", "k", "qvec"))


def search_direct_entity(vectors: DataFrame, probes: DataFrame) -> DataFrame:
    return _term_strategy(vectors, probes, DIRECT)


def search_file_structure(vectors: DataFrame, probes: DataFrame) -> DataFrame:
    return _term_strategy(vectors, probes, FILES)


def _dense_strategy(vectors: DataFrame, probes: DataFrame, profiles: DataFrame, names: list[str]) -> DataFrame:
    return search_scoped(with_bits(vectors, profiles), probes.where(F.col("strategy").isin(names))
                         .select(*PROBE_COLUMNS, "need", "k", "qvec"), PROBE_KEY)


def search_contextual(vectors: DataFrame, probes: DataFrame, profiles: DataFrame) -> DataFrame:
    return _dense_strategy(vectors, probes, profiles, [CONTEXTUAL])


def search_semantic(vectors: DataFrame, probes: DataFrame, profiles: DataFrame) -> DataFrame:
    return _dense_strategy(vectors, probes, profiles, [SEMANTIC])


def union_provenance(vectors: DataFrame, probes: DataFrame, profiles: DataFrame) -> DataFrame:
    """Matches of all strategies, with strategy, namespace and confidence.

    Both dense strategies share one pass over the vectors, both term strategies another.
    """
    dense = _dense_strategy(vectors, probes, profiles, [CONTEXTUAL, SEMANTIC])
    by_term = search_terms(vectors, probes.where(F.col("strategy").isin(DIRECT, FILES))
                           .select(*PROBE_COLUMNS, "term", "need", "k", "qvec"))
    return dense.unionByName(by_term)


# ---- ranking -------------------------------------------------------------------------

FIRST_SEEN = ["namespace_ord", "strategy_ord", "term_pos", "rank"]


def dedupe_first_seen(matches: DataFrame, include_namespace: bool = False) -> DataFrame:
    """One match per (query, file_path:line_start), the first in search order.

    Matches are dealt by query, and so not again for the ranking of a query's matches. A query has a handful
    for each of its probes.
    """
    key = ["query_id", F.coalesce("file_path", F.lit("")), F.coalesce("line_start", F.lit(0))]
    if include_namespace:
        key.append(F.col("namespace"))
    order = Window.partitionBy(*key).orderBy(*FIRST_SEEN)
    return (matches.repartition("query_id").withColumn("seen_no", F.row_number().over(order))
            .where("seen_no = 1").drop("seen_no"))


def boosted_rank(matches: DataFrame) -> DataFrame:
    """score × confidence, raised for direct hits and for file hits of file questions."""
    score, confidence = F.col("score"), F.coalesce("confidence", F.lit(0.5))
    rank_score = (F.when(F.col("strategy") == DIRECT, score * DIRECT_BOOST * confidence)
                  .when((F.col("query_type") == "file_search") & (F.col("strategy") == FILES),
                        score * FILES_BOOST * confidence)
                  .otherwise(score * confidence))
    return matches.withColumn("rank_score", rank_score)


def final_top10(matches: DataFrame, k: int = 10) -> DataFrame:
    """Ten best per query by raw score; the boosted rank and search order break ties."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("rank_score"), *FIRST_SEEN)
    return matches.withColumn("final_rank", F.row_number().over(order)).where(F.col("final_rank") <= k)


def fallback_basic(matches: DataFrame, vectors: DataFrame, requests: DataFrame,
                   rank: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Add basic-search matches for the requests that have no match at all.

    ``requests``: (query_id, query_type, namespace, namespace_ord, qvec). ``rank``, by which ``matches`` were ranked and
    cut per query, is applied to the added ones, which are then written; the others are not dealt again.
    """
    unmatched = staged(requests.join(matches.select("query_id").distinct(), "query_id", "left_anti"), "unmatched")
    basic = search_basic(vectors, unmatched).withColumns({
        "strategy": F.lit("basic_vector_search"), "strategy_ord": F.lit(4), "term_pos": F.lit(0)})
    if rank is None:
        return matches.unionByName(basic, allowMissingColumns=True)
    # A null id equals none: it has matches and is searched again, and all its matches are ranked together.
    added = matches.where("query_id is null").unionByName(basic, allowMissingColumns=True)
    return matches.where("query_id is not null").unionByName(staged(rank(added), "basic"), allowMissingColumns=True)
