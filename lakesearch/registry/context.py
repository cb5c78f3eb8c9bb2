"""Context and answer queries, over the results of the two end-to-end searches."""

from pyspark.sql import functions as F

from lakesearch.operators import context as A
from lakesearch.plans.search import all_namespace_search
from lakesearch.registry import retrieval as base
from lakesearch.registry.fixtures import table


def _plain(spark, sf):
    vectors = base.vectors(spark, sf)
    # A sixth of the chunks has no content, a seventh no path.
    stored = vectors.withColumn("content", F.when(F.col("vec_id") % 6 != 0, F.col("content")))
    found = A.attach_content(all_namespace_search(base._own_queries(spark, sf), vectors), stored)
    return A.context_plain(found.withColumn(
        "file_path", F.when(~F.col("file_path").startswith("dir3"), F.col("file_path"))))


def context_plain(spark, sf):
    return _plain(spark, sf)


def _markdown(spark, sf):
    stored = base.vectors(spark, sf).withColumn("content", F.when(F.col("vec_id") % 6 != 0, F.col("content"))) \
        .withColumn("repo_name", F.when(F.col("vec_id") % 5 != 0, F.col("repo_name")))
    return A.context_markdown(A.attach_content(base.agentic(spark, sf), stored))


def context_markdown(spark, sf):
    return _markdown(spark, sf)


def build_prompt(spark, sf):
    return A.build_prompt(base.requests(spark, sf), _markdown(spark, sf), A.MARKDOWN_TEMPLATE)


def answer_footer(spark, sf):
    found, targets = base.searched(spark, sf)
    return A.answer_footer(targets, found)


def no_match_rows(spark, sf):
    return A.no_match_rows(base.requests(spark, sf).where("query <> ''"), base.agentic(spark, sf))


def attach_answers(spark, sf):
    """A part's type stands for the answer to its question; one question in four has none."""
    answers = table(spark, sf, "part").selectExpr(
        "p_partkey as query_id", "case when p_partkey % 4 <> 0 then p_type end as answer")
    found, targets = base.searched(spark, sf)
    return A.attach_answers(base.requests(spark, sf).where("query <> ''"), found, A.answer_footer(targets, found), answers)


QUERIES = {f.__name__: f for f in (context_plain, context_markdown, build_prompt, answer_footer, no_match_rows,
                                   attach_answers)}

_BLOCKS = """, blocks as (
  select e.query_id, string_agg('**File:** ' || e.file_path || chr(10) || '**Repository:** '
      || (case when v.vec_id % 5 <> 0 then v.repo_name else e.namespace end) || chr(10) || chr(10) || '```' || chr(10)
      || (case when v.vec_id % 6 <> 0 then v.content else 'Content not available.' end) || chr(10) || '```',
    chr(10) || chr(10) || '---' || chr(10) || chr(10) order by final_rank) as context
  from everything e join vectors v using (id) group by all)
"""
_FOOTERS = """, footers as (
  select query_id, concat_ws(' • ', case when count(distinct namespace_ord) = 1 then 'Repository: ' || arg_min(namespace, namespace_ord)
      else 'Searched ' || count(distinct namespace_ord) || ' repositories' end, any_value(n) || ' relevant results') as footer
  from targets left join (select query_id, count(*) as n from everything group by all) using (query_id)
  where query <> '' group by query_id)
"""


def _text(value):
    return "'" + value.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


_HEAD, _REST = A.MARKDOWN_TEMPLATE.split("{question}")
_MIDDLE, _TAIL = _REST.split("{context}")
_ALL_NAMESPACE = base.ALL_NAMESPACE

ORACLES = {
    "context_plain": _ALL_NAMESPACE.replace("select query_id, rank, namespace, id, score from merged where rank <= top_k", "") + """
, found as (select query_id, rank, id from merged where rank <= top_k)
select query_id, string_agg('[File: ' || (case when file_path not like 'dir3%' then file_path else 'unknown' end) || ']' || chr(10) || content,
  chr(10) || chr(10) || '---' || chr(10) || chr(10) order by rank) as context
from found join vectors using (id) where vec_id % 6 <> 0 group by query_id""",
    "context_markdown": base.AGENTIC + _BLOCKS + "select query_id, context from blocks",
    "build_prompt": base.AGENTIC + _BLOCKS + f"""select query_id, query,
  {_text(_HEAD)} || query || {_text(_MIDDLE)} || context || {_text(_TAIL)} as prompt from blocks join questions using (query_id)""",
    "answer_footer": base.AGENTIC + _FOOTERS + "select query_id, footer from footers",
    "no_match_rows": base.AGENTIC + """select query_id, 'No matches found for: ''' || query || '''' as message from questions
where query <> '' and query_id not in (select query_id from everything)""",
    "attach_answers": base.AGENTIC + _FOOTERS + """, counted as (select query_id, count(*) as n from everything group by all)
select q.query_id, case when n is null then 'No matches found for: ''' || query || ''''
  when p_partkey % 4 = 0 then 'Response generation unavailable. Found ' || n || ' relevant matches for: ''' || query || ''''
  else p_type || chr(10) || chr(10) || '---' || chr(10) || '*' || footer || '*' end as content
from questions q join part on p_partkey = query_id left join counted using (query_id) left join footers using (query_id)
where query <> ''""",
}
