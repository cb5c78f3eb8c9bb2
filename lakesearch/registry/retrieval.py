"""Retrieval queries.

Plain searches use every vector as a query against every namespace. Planned searches use
every question; a probe's vector is the embedding numbered by its query, strategy and
term position, standing in for the external model.
"""

from pyspark.sql import functions as F

from lakesearch.functions.filters import compile_filter
from lakesearch.functions.similarity import SHOWN_DIGITS, cosine_score as cosine_column
from lakesearch.operators import retrieval as R
from lakesearch.operators.analysis import CONTEXTUAL, DIRECT, FILES, SEMANTIC, analyze_query
from lakesearch.plans import search
from lakesearch.registry.analysis import ANALYSIS
from lakesearch.registry.fixtures import cte, fixture, table
from lakesearch.session import spread

# ---- inputs --------------------------------------------------------------------------


def vectors(spark, sf):
    return fixture(spark, sf, "vectors")


def _own_queries(spark, sf):
    """Every vector as a query, with request bounds that vary from row to row."""
    return table(spark, sf, "embeddings").selectExpr(
        "vec_id as query_id", "'question ' || vec_id as query", "cast(vec_id % 60 - 5 as int) as top_k",
        "cast(vec_id % 30 - 2 as int) as per_ns_k", "cast((vec_id % 40 - 4) / 100.0e0 as string) as min_score",
        "embedding as qvec")


def _per_namespace(spark, sf):
    present = vectors(spark, sf).select("namespace").distinct()
    names = present.agg(F.collect_list("namespace")).scalar()
    return (_own_queries(spark, sf).select("query_id", "qvec", F.lit(10).alias("top_k"), F.lit(5).alias("per_ns_k"),
                                           ((F.col("query_id") % 40) / F.lit(100.0)).alias("min_score"))
            .withColumn("namespace", F.explode(names)))


def _home_namespace(spark, sf):
    """Every vector as a query of one namespace, the one after its own."""
    return table(spark, sf, "embeddings").selectExpr(
        "vec_id as query_id", "'ns' || ((label + 1) % 10) as namespace", "embedding as qvec")


def requests(spark, sf):
    """Questions asking for no repository, one, or two."""
    return fixture(spark, sf, "questions").withColumn("repositories", F.expr(
        "case query_id % 3 when 0 then cast(array() as array<string>) when 1 then array('org/ns' || (query_id % 10)) "
        "else array('org/ns1', 'org/ns' || (query_id % 5)) end"))


def profiles(spark, sf):
    return fixture(spark, sf, "profiles")


def mapping(spark, sf):
    return fixture(spark, sf, "repo_namespaces")


def embedder(spark, sf):
    """Stand-in model: a probe's vector is the embedding with its number."""
    stored = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("qvec"))
    total = stored.agg(F.count(F.lit(1))).scalar()

    def embed(probes):
        order = F.col("strategy_ord") * 7 + F.col("term_pos") if "strategy_ord" in probes.columns else F.lit(0)
        return (probes.withColumn("vec_id", F.pmod(F.col("query_id") * 31 + order, total))
                .join(stored, "vec_id").drop("vec_id"))

    return embed


def _targets(spark, sf):
    asked = spread(requests(spark, sf).where("query <> ''"))
    return R.resolve_namespaces(analyze_query(asked), vectors(spark, sf), mapping(spark, sf))


def _probes(spark, sf):
    return search.plan_probes(requests(spark, sf), vectors(spark, sf), profiles(spark, sf), mapping(spark, sf),
                              embedder(spark, sf))[0]


def _matches(spark, sf):
    return R.union_provenance(vectors(spark, sf), _probes(spark, sf), profiles(spark, sf))


_FOUND = ["query_id", "namespace", "strategy", "term_pos", "rank", "id", "score"]


# ---- queries -------------------------------------------------------------------------

def cosine_score(spark, sf):
    """Every vector against the first vector of its namespace."""
    rows = vectors(spark, sf)
    first = rows.groupBy("namespace").agg(F.min_by("embedding", "vec_id").alias("qvec"))
    return rows.join(first, "namespace").select("id", cosine_column(F.col("qvec"), F.col("embedding")).alias("score"))


def topk_per_namespace(spark, sf):
    return R.topk_per_namespace(vectors(spark, sf), _per_namespace(spark, sf)).select(
        "query_id", "namespace", "rank", "id", "score")


def topk_merged(spark, sf):
    found = R.topk_per_namespace(vectors(spark, sf), _per_namespace(spark, sf))
    return R.topk_merged(found).select("query_id", "rank", "namespace", "id", "score")


def min_score_filter(spark, sf):
    found = R.topk_per_namespace(vectors(spark, sf), _per_namespace(spark, sf))
    return R.min_score_filter(found).select("query_id", "namespace", "id", "score")


def clamp_request(spark, sf):
    return R.clamp_request(fixture(spark, sf, "raw_requests"))


FILTER = {"$or": [{"file_path": {"$regex": r"(?i).*FILE_1.*\.py$"}}, {"content": {"$regex": r"(?i)\bwidget 7\b"}},
                  {"function_names": {"$in": ["fn_1", "fn_3"]}}, {"missing_field": "x"}],
          "code_complexity": {"$lt": 0.7, "$gte": 0.2}, "live": True, "commit_sha": {"$in": ["c0", "c2"]}}


def metadata_filter(spark, sf):
    rows = vectors(spark, sf)
    return rows.where(compile_filter(FILTER, rows.schema)).select("id", "file_path", "content", "code_complexity")


def search_live(spark, sf):
    return R.search_live(vectors(spark, sf), _home_namespace(spark, sf), live=True).select(
        "query_id", "namespace", "rank", "id", "score")


def search_similar(spark, sf):
    tree = {"class_names": {"$in": ["Cls1", "Cls2", "Cls4"]}, "code_complexity": {"$gte": 0.3}}
    return R.search_similar(vectors(spark, sf), _home_namespace(spark, sf), 4, tree).select(
        "query_id", "namespace", "rank", "id", "score")


def search_basic(spark, sf):
    asked = _home_namespace(spark, sf).withColumn(
        "namespace", F.when(F.col("query_id") % 9 == 0, "").otherwise(F.col("namespace")))
    return R.search_basic(vectors(spark, sf), asked).select("query_id", "namespace", "rank", "id", "score")


def map_repo_namespace(spark, sf):
    rows = vectors(spark, sf).select("id", "repo_name")
    return R.map_repo_namespace(rows, mapping(spark, sf))


def resolve_namespaces(spark, sf):
    return R.resolve_namespaces(requests(spark, sf), vectors(spark, sf), mapping(spark, sf)).drop("query")


def _planned(spark, sf):
    return _targets(spark, sf).join(profiles(spark, sf), "namespace", "left")


def contextual_keywords(spark, sf):
    return R.contextual_keywords(_planned(spark, sf)).select(
        "query_id", "namespace_ord", F.array_join("contextual_keywords", "|").alias("keywords"))


def file_patterns(spark, sf):
    return R.file_patterns(analyze_query(fixture(spark, sf, "questions"))).select(
        "query_id", F.array_join("file_patterns", "|").alias("patterns"))


def strategy_probes(spark, sf):
    return R.strategy_probes(_targets(spark, sf), profiles(spark, sf)).select(
        "query_id", "namespace_ord", "namespace", "strategy", "confidence", "k", "need",
        F.array_join("terms", "|").alias("terms"))


def expand_probe_text(spark, sf):
    return R.expand_probe_text(R.strategy_probes(_targets(spark, sf), profiles(spark, sf))).select(
        "query_id", "namespace_ord", "strategy", "term_pos", "term", "probe_text")


def search_direct_entity(spark, sf):
    return R.search_direct_entity(vectors(spark, sf), _probes(spark, sf)).select(*_FOUND)


def search_contextual(spark, sf):
    return R.search_contextual(vectors(spark, sf), _probes(spark, sf), profiles(spark, sf)).select(*_FOUND)


def search_semantic(spark, sf):
    return R.search_semantic(vectors(spark, sf), _probes(spark, sf), profiles(spark, sf)).select(*_FOUND)


def search_file_structure(spark, sf):
    return R.search_file_structure(vectors(spark, sf), _probes(spark, sf)).select(*_FOUND)


def union_provenance(spark, sf):
    return _matches(spark, sf).select(*_FOUND, "confidence")


def dedupe_first_seen(spark, sf):
    return R.dedupe_first_seen(_matches(spark, sf)).select("query_id", "namespace", "strategy", "file_path",
                                                           "line_start", "id", "score")


def boosted_rank(spark, sf):
    return R.boosted_rank(R.dedupe_first_seen(_matches(spark, sf))).select(
        "query_id", "id", "strategy", F.round("rank_score", 9).alias("rank_score"))


_TOP = ["query_id", "final_rank", "namespace", "strategy", "id", "file_path", "line_start", "score"]


def final_top10(spark, sf):
    return R.final_top10(R.boosted_rank(R.dedupe_first_seen(_matches(spark, sf)))).select(*_TOP)


def fallback_basic(spark, sf):
    """File-structure matches alone, so that most questions need the fallback."""
    files = R.search_file_structure(vectors(spark, sf), _probes(spark, sf))
    asked = embedder(spark, sf)(_targets(spark, sf).select("query_id", "query_type", "namespace", "namespace_ord"))
    return R.fallback_basic(files, vectors(spark, sf), asked).select(
        "query_id", "namespace", "strategy", "term_pos", "rank", "id", "score")


def _planned_search(search_plan, spark, sf):
    return search_plan(requests(spark, sf), vectors(spark, sf), profiles(spark, sf), mapping(spark, sf),
                       embedder(spark, sf), embedder(spark, sf))


def agentic(spark, sf):
    return _planned_search(search.agentic_search, spark, sf)


def searched(spark, sf):
    return _planned_search(search.searched, spark, sf)


def agentic_search(spark, sf):
    return agentic(spark, sf).select(*_TOP)


def all_namespace_search(spark, sf):
    return search.all_namespace_search(_own_queries(spark, sf), vectors(spark, sf)).select(
        "query_id", "rank", "namespace", "id", "score")


def _shown(query):
    """Scores with the digits that results show."""
    def run(spark, sf):
        found = query(spark, sf)
        return found.withColumn("score", F.round("score", SHOWN_DIGITS)) if "score" in found.columns else found

    return run


QUERIES = {f.__name__: _shown(f) for f in (
    cosine_score, topk_per_namespace, topk_merged, min_score_filter, clamp_request, metadata_filter, search_live,
    search_similar, search_basic, map_repo_namespace, resolve_namespaces, contextual_keywords, strategy_probes,
    expand_probe_text, search_direct_entity, search_contextual, search_semantic, file_patterns, search_file_structure,
    union_provenance, dedupe_first_seen, boosted_rank, final_top10, fallback_basic, agentic_search,
    all_namespace_search)}

# ---- oracles -------------------------------------------------------------------------

_COSINE = "round(list_cosine_similarity(q.qvec::double[], v.embedding::double[]), 12)"

_ALL_PAIRS = cte("vectors") + f""", scored as (
  select q.vec_id as query_id, v.namespace, v.id, {_COSINE} as score
  from (select vec_id, embedding as qvec from embeddings) q, vectors v),
ranked as (select *, row_number() over (partition by query_id, namespace order by score desc, id) as r from scored),
top5 as (select query_id, namespace, r::int as rank, id, score from ranked where r <= 5)
"""


def _home(where, k, asked="true"):
    return cte("vectors") + f""", scored as (
  select q.vec_id as query_id, v.namespace, v.id, {_COSINE} as score
  from (select vec_id, label, embedding as qvec from embeddings) q
  join vectors v on v.namespace = 'ns' || ((q.label + 1) % 10) and ({where}) and ({asked})),
ranked as (select *, row_number() over (partition by query_id, namespace order by score desc, id) as r from scored)
select query_id, namespace, r::int as rank, id, score from ranked where r <= {k}"""


_TARGETS = """, present as (select list_sort(list_distinct(list(namespace))) as all_ns from vectors),
req as (select query_id, query, case query_id % 3 when 0 then []::varchar[] when 1 then ['org/ns' || (query_id % 10)]
  else ['org/ns1', 'org/ns' || (query_id % 5)] end as repos from questions),
asked as (select query_id, query, len(repos) > 0 as asked, unnest(case when len(repos) > 0 then repos else all_ns end) as repo,
  unnest(range(case when len(repos) > 0 then len(repos) else len(all_ns) end)) as namespace_ord from req, present),
targets as (select query_id, query, namespace_ord::int as namespace_ord,
  case when asked then coalesce(m.namespace, repo) else repo end as namespace
  from asked left join repo_namespaces m on m.repo_name = repo)
"""

_INPUTS = ("vectors", "questions", "profiles", "repo_namespaces")


def _case_words():
    return "case kind " + " ".join(f"when '{k}' then {v}" for k, v in R.CLASS_WORDS.items()) + " else [] end"


_PATTERNS = f"""case when len(list_filter(entities, lambda e: contains(e, '.') or contains(e, '/'))) > 0
    then list_filter(entities, lambda e: contains(e, '.') or contains(e, '/'))
    else list_filter(regexp_split_to_array(trim(lower(query)), '\\s+'), lambda w: {" or ".join(f"contains(w, '{x}')" for x in R.FILE_INDICATORS)}) end"""

_PLAN = _TARGETS + f""", planned as (
  select a.query_id, a.query, a.kind, a.complexity, a.targets, t.namespace, t.namespace_ord, p.file_types,
    coalesce(p.keywords, []) as profile_words,
    list_sort(list_distinct(list_concat(list_filter(coalesce(p.keywords, []), lambda k: len(list_filter(
      list_concat(a.keywords, a.entities), lambda t: contains(lower(k), lower(t)) or contains(lower(t), lower(k)))) > 0),
      {_case_words()}))) as ctx,
    {_PATTERNS.replace("query", "a.query")} as patterns
  from analysis a join targets t using (query_id) left join profiles p using (namespace) where a.query <> ''),
strategies as (
  select *, '{DIRECT}' as strategy, 0 as strategy_ord, 0.9e0 as confidence, 3 as k, 0 as need, targets as terms
  from planned where len(targets) > 0
  union all select *, '{CONTEXTUAL}', 1, 0.8e0, 5, 1, null from planned where len(ctx) > 0
  union all select *, '{SEMANTIC}', 2, 0.7e0, 7, 1 + case complexity when 'simple' then 2 when 'complex' then 4 else 0 end, null from planned
  union all select *, '{FILES}', 3, 0.95e0, 3, 0, patterns from planned where kind = 'file_search'),
probes as (
  select * exclude (terms), unnest(coalesce(terms, [null])) as term, unnest(range(len(coalesce(terms, [null]))))::int as term_pos
  from strategies)
"""

_SEARCH = _PLAN + f""", vecs as (select *, lower(file_path) as lp from vectors),
hits as (
  select distinct p.namespace, p.strategy, p.term, v.id
  from (select distinct namespace, strategy, term from probes where term is not null) p join vecs v using (namespace)
  where contains(v.lp, lower(p.term)) or (p.strategy = '{DIRECT}' and (list_contains(v.function_names, p.term)
    or list_contains(v.class_names, p.term)
    or regexp_matches(v.content, '(?i)\\b' || regexp_replace(p.term, '([^A-Za-z0-9_])', '\\\\\\1', 'g') || '\\b')))),
cand as (
  select p.*, v.id, v.file_path, v.line_start from probes p join hits h using (namespace, strategy, term)
    join vecs v on v.namespace = h.namespace and v.id = h.id
  union all
  select p.*, v.id, v.file_path, v.line_start from probes p join vecs v using (namespace)
  where p.term is null and p.strategy in ('{CONTEXTUAL}', '{SEMANTIC}')
    and (p.file_types is null or len(list_filter(p.file_types, lambda t: ends_with(v.lp, t))) > 0)
    and (p.need < 2 or (p.need = 3 and v.code_complexity < 0.7) or (p.need = 5 and v.code_complexity >= 0.7))),
qv as (select vec_id, embedding::double[] as qvec from embeddings),
ev as (select id, embedding::double[] as embedding from vectors),
scored as (
  select c.*, round(list_cosine_similarity(qv.qvec, ev.embedding), 12) as score
  from cand c join qv on qv.vec_id = (c.query_id * 31 + c.strategy_ord * 7 + c.term_pos) % (select count(*) from embeddings) join ev using (id)),
matches as (
  select *, row_number() over (partition by query_id, namespace_ord, strategy, term_pos order by score desc, id)::int as rank
  from scored qualify rank <= k)
"""

# A query may name one namespace twice: its probes are told apart by position.
_DEDUPE = """, seen as (
  select *, row_number() over (partition by query_id, file_path, line_start
    order by namespace_ord, strategy_ord, term_pos, rank) as n from matches qualify n = 1),
boosted as (select *, case when strategy = '{d}' then score * 1.5e0 * confidence
  when kind = 'file_search' and strategy = '{f}' then score * 1.4e0 * confidence else score * confidence end as rank_score from seen)
""".format(d=DIRECT, f=FILES)

_TOP10 = """, final as (select *, row_number() over (partition by query_id
  order by score desc, rank_score desc, namespace_ord, strategy_ord, term_pos, rank)::int as final_rank from boosted qualify final_rank <= 10)
"""

_BASIC = """, basic as (
  select t.query_id, t.namespace, t.namespace_ord, v.id, v.file_path, v.line_start,
    round(list_cosine_similarity(qv.qvec, ev.embedding), 12) as score
  from targets t join analysis a using (query_id) join vecs v using (namespace) join ev using (id)
    join qv on qv.vec_id = t.query_id * 31 % (select count(*) from embeddings)
  where t.query <> '' and t.query_id not in (select query_id from {found})),
basic5 as (select *, row_number() over (partition by query_id, namespace_ord order by score desc, id)::int as rank from basic qualify rank <= 5)
"""

BASE = cte(*_INPUTS) + ANALYSIS
_FOUND_SQL = "select query_id, namespace, strategy, term_pos, rank, id, score from matches"
_RESULT = "query_id, final_rank, namespace, strategy, id, file_path, line_start, score"

FINAL = BASE + _SEARCH + _DEDUPE + _TOP10

ORACLES = {
    "cosine_score": cte("vectors") + """, q as (select namespace, arg_min(embedding, vec_id) as qvec from vectors group by all)
select v.id, """ + _COSINE + " as score from vectors v join q using (namespace)",
    "topk_per_namespace": _ALL_PAIRS + "select * from top5",
    "topk_merged": _ALL_PAIRS + """, m as (select query_id, namespace, id, score,
  row_number() over (partition by query_id order by score desc, namespace, id)::int as place from top5)
select query_id, namespace, id, score, place as rank from m where place <= 10""",
    "min_score_filter": _ALL_PAIRS + """select query_id, namespace, id, score from top5
where query_id % 40 = 0 or score >= (query_id % 40) / 100.0e0""",
    "clamp_request": cte("raw_requests") + """select query_id, trim(query) as query,
  greatest(1, least(50, coalesce(top_k, 10))) as top_k, greatest(1, least(20, coalesce(per_ns_k, 5))) as per_ns_k,
  case when try_cast(min_score as double) between 0 and 1 then try_cast(min_score as double) end as min_score,
  case when trim(query) = '' then 'Question is required and cannot be empty' end as error from raw_requests""",
    "metadata_filter": cte("vectors") + r"""select id, file_path, content, code_complexity from vectors
where (regexp_matches(file_path, '(?i).*FILE_1.*\.py$') or regexp_matches(content, '(?i)\bwidget 7\b')
    or list_has_any(function_names, ['fn_1', 'fn_3']))
  and code_complexity < 0.7 and code_complexity >= 0.2 and live and commit_sha in ('c0', 'c2')""",
    "search_live": _home("v.live", 5),
    "search_similar": _home("list_has_any(v.class_names, ['Cls1', 'Cls2', 'Cls4']) and v.code_complexity >= 0.3", 4),
    "search_basic": _home("true", 5, "q.vec_id % 9 <> 0"),
    "map_repo_namespace": cte("vectors", "repo_namespaces") + """select v.id, v.repo_name, coalesce(m.namespace, v.repo_name) as namespace
from vectors v left join repo_namespaces m using (repo_name)""",
    "resolve_namespaces": cte(*_INPUTS) + _TARGETS + "select query_id, namespace_ord, namespace from targets",
    "contextual_keywords": BASE + _PLAN + "select query_id, namespace_ord, array_to_string(ctx, '|') as keywords from planned",
    "file_patterns": cte("questions") + ANALYSIS + f"select query_id, array_to_string({_PATTERNS}, '|') as patterns from analysis",
    "strategy_probes": BASE + _PLAN + """select query_id, namespace_ord, namespace, strategy, confidence, k, need,
  array_to_string(terms, '|') as terms from strategies""",
    "expand_probe_text": BASE + _PLAN + f"""select query_id, namespace_ord, strategy, term_pos, term, case strategy
  when '{DIRECT}' then term || ' ' || query when '{CONTEXTUAL}' then query || ' ' || array_to_string(ctx, ' ')
  when '{SEMANTIC}' then query || ' ' || array_to_string(profile_words[1:3], ' ') else 'file ' || term end as probe_text from probes""",
    "search_direct_entity": BASE + _SEARCH + _FOUND_SQL + f" where strategy = '{DIRECT}'",
    "search_contextual": BASE + _SEARCH + _FOUND_SQL + f" where strategy = '{CONTEXTUAL}'",
    "search_semantic": BASE + _SEARCH + _FOUND_SQL + f" where strategy = '{SEMANTIC}'",
    "search_file_structure": BASE + _SEARCH + _FOUND_SQL + f" where strategy = '{FILES}'",
    "union_provenance": BASE + _SEARCH + "select query_id, namespace, strategy, term_pos, rank, id, score, confidence from matches",
    "dedupe_first_seen": BASE + _SEARCH + _DEDUPE + "select query_id, namespace, strategy, file_path, line_start, id, score from seen",
    "boosted_rank": BASE + _SEARCH + _DEDUPE + "select query_id, id, strategy, round(rank_score, 9) as rank_score from boosted",
    "final_top10": FINAL + f"select {_RESULT} from final",
    "fallback_basic": BASE + _SEARCH + f", files_found as (select * from matches where strategy = '{FILES}')"
                      + _BASIC.format(found="files_found") + """
select query_id, namespace, strategy, term_pos, rank, id, score from files_found
union all select query_id, namespace, 'basic_vector_search', 0, rank, id, score from basic5""",
    "all_namespace_search": cte("vectors") + f""", q as (select vec_id as query_id, embedding as qvec,
  greatest(1, least(50, vec_id % 60 - 5)) as top_k, greatest(1, least(20, vec_id % 30 - 2)) as per_ns_k,
  case when (vec_id % 40 - 4) >= 0 then (vec_id % 40 - 4) / 100.0e0 end as min_score from embeddings),
scored as (select q.query_id, q.top_k, q.per_ns_k, q.min_score, v.namespace, v.id, {_COSINE} as score from q, vectors v),
ranked as (select *, row_number() over (partition by query_id, namespace order by score desc, id) as r from scored qualify r <= per_ns_k),
merged as (select *, row_number() over (partition by query_id order by score desc, namespace, id)::int as rank
  from ranked where coalesce(min_score, 0) = 0 or score >= min_score)
select query_id, rank, namespace, id, score from merged where rank <= top_k""",
}

AGENTIC = FINAL + _BASIC.format(found="final") + f""", everything as (
  select {_RESULT}, namespace_ord from final
  union all
  select query_id, row_number() over (partition by query_id order by score desc, namespace_ord, rank)::int as fr, namespace,
    'basic_vector_search', id, file_path, line_start, score, namespace_ord from basic5 qualify fr <= 10)
"""
ORACLES["agentic_search"] = AGENTIC + f"select {_RESULT} from everything"

ALL_NAMESPACE = ORACLES["all_namespace_search"]

#: Queries that return scores.
_SCORED = ["cosine_score", "topk_per_namespace", "topk_merged", "min_score_filter", "search_live", "search_similar", "search_basic",
           "search_direct_entity", "search_contextual", "search_semantic", "search_file_structure", "union_provenance", "dedupe_first_seen",
           "final_top10", "fallback_basic", "all_namespace_search", "agentic_search"]
ORACLES.update({name: f"select * replace (round(score, {SHOWN_DIGITS}) as score) from ({ORACLES[name]})" for name in _SCORED})
