"""Question analysis queries, over every derived question."""

from pyspark.sql import functions as F

from lakesearch.operators import analysis as Q
from lakesearch.registry.fixtures import cte, fixture


def _joined(df, *names):
    return df.withColumns({n: F.array_join(n, "|") for n in names})


def _questions(spark, sf):
    return fixture(spark, sf, "questions")


def classify_query(spark, sf):
    return _questions(spark, sf).select("query_id", Q.query_type(F.col("query")).alias("query_type"))


def extract_entities(spark, sf):
    return _joined(_questions(spark, sf).select("query_id", Q.entities(F.col("query")).alias("entities")), "entities")


def extract_targets(spark, sf):
    return _joined(_questions(spark, sf).select("query_id", Q.specific_targets(F.col("query")).alias("targets")), "targets")


def determine_scope(spark, sf):
    q = F.col("query")
    return _questions(spark, sf).select("query_id", Q.scope(q, Q.entities(q)).alias("scope"))


def assess_complexity(spark, sf):
    q = F.col("query")
    return _questions(spark, sf).select("query_id", Q.complexity(q, Q.entities(q)).alias("complexity"))


def intent_keywords(spark, sf):
    return _joined(_questions(spark, sf).select("query_id", Q.intent_keywords(F.col("query")).alias("keywords")), "keywords")


def plan_strategies(spark, sf):
    q = F.col("query")
    found = _questions(spark, sf).select("query_id", Q.query_type(q).alias("kind"), Q.entities(q).alias("entities"),
                                         Q.specific_targets(q).alias("targets"))
    return _joined(found.select("query_id", Q.search_strategies(
        F.col("kind"), F.col("entities"), F.col("targets")).alias("strategies")), "strategies")


def analyze_query(spark, sf):
    return _joined(Q.analyze_query(_questions(spark, sf)), "entities", "specific_targets", "intent_keywords",
                   "search_strategies")


QUERIES = {f.__name__: f for f in (classify_query, extract_entities, extract_targets, determine_scope,
                                   assess_complexity, intent_keywords, plan_strategies, analyze_query)}


def _text(value):
    return "'" + value.replace("'", "''") + "'"


def _any(words):
    return "(" + " or ".join(f"contains(lower(query), {_text(w)})" for w in words) + ")"


def _all(patterns, group):
    return "list_sort(list_distinct(flatten([" + ", ".join(
        f"regexp_extract_all(query, {_text(p)}, {group})" for p in patterns) + "])))"


_SCORES = "[" + ", ".join("+".join(
    f"len(regexp_extract_all(lower(query), {_text(p)}))" for p in ps) for ps in Q.CLASS_PATTERNS.values()) + "]"
_NAMES = "[" + ", ".join(_text(n) for n in Q.CLASS_PATTERNS) + "]"

ANALYSIS = f""", parts as (
  select query_id, query, {_SCORES} as scores, {_all(Q.TARGET_PATTERNS, 1)} as targets,
    list_sort(list_distinct(list_transform(list_filter(
      flatten([{", ".join(f"regexp_extract_all(query, {_text(p)})" for p in Q.ENTITY_PATTERNS)}]),
      lambda e: length(e) > 2 and lower(e) not in ({", ".join(_text(w) for w in Q.STOP_WORDS)})),
      lambda e: trim(e, '()')))) as entities,
    list_filter([{", ".join(_text(t) for t in Q.INTENT_TERMS)}], lambda t: contains(lower(query), t)) as keywords,
    len(regexp_extract_all(query, '\\S+')) as words
  from questions),
typed as (select *, case when list_max(scores) > 0 then {_NAMES}[list_position(scores, list_max(scores))]
  when {_any(Q.FIND_WORDS)} then case when {_any(Q.FIND_EXTENSIONS)} then 'file_search' else 'code_search' end
  else 'conceptual' end as kind from parts),
analysis as (select query_id, query, kind, entities, targets, keywords,
  case when {_any(Q.WIDE_WORDS)} then 'cross-cutting' when {_any(Q.MODULE_WORDS)} then 'module'
    when len(entities) = 1 and {_any(Q.UNIT_WORDS)} then 'file' when len(entities) > 3 then 'cross-cutting' else 'module' end as scope,
  case when words <= 5 and len(entities) <= 1 then 'simple' when words > 15 or len(entities) > 4 then 'complex'
    else 'medium' end as complexity,
  concat_ws('|', case when kind = 'file_search' then '{Q.FILES}' end, case when len(targets) > 0 then '{Q.DIRECT}' end,
    '{Q.SEMANTIC}', case when kind = 'code_search' then '{Q.DIRECT}' end,
    case when kind in ('functional', 'implementation', 'example', 'debugging') then '{Q.CONTEXTUAL}' end,
    case when len(entities) > 1 then '{Q.CONTEXTUAL}' end) as strategies from typed)
"""
_BASE = cte("questions") + ANALYSIS

ORACLES = {
    "classify_query": _BASE + "select query_id, kind as query_type from analysis",
    "extract_entities": _BASE + "select query_id, array_to_string(entities, '|') as entities from analysis",
    "extract_targets": _BASE + "select query_id, array_to_string(targets, '|') as targets from analysis",
    "determine_scope": _BASE + "select query_id, scope from analysis",
    "assess_complexity": _BASE + "select query_id, complexity from analysis",
    "intent_keywords": _BASE + "select query_id, array_to_string(keywords, '|') as keywords from analysis",
    "plan_strategies": _BASE + "select query_id, strategies from analysis",
    "analyze_query": _BASE + f"""select query_id, query, kind as query_type, array_to_string(entities, '|') as entities,
  array_to_string(targets, '|') as specific_targets, array_to_string(keywords, '|') as intent_keywords,
  case when query = '' then 'file' else scope end as scope, complexity, strategies as search_strategies,
  case when query = '' then 0.1e0 else 0.9e0 end as confidence, '' as repository_context from analysis""",
}
