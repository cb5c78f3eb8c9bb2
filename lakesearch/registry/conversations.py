"""Conversation and catalogue queries."""

from pyspark.sql import functions as F

from lakesearch.operators import conversations as H
from lakesearch.registry.fixtures import cte, fixture, table


def _messages(spark, sf):
    return fixture(spark, sf, "messages")


def fold_conversation(spark, sf):
    folded = H.fold_conversation(_messages(spark, sf))
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    return folded.select("conv_id", F.size("messages").alias("n"), F.array_join(lines, "\n").alias("messages"))


def conversation_title(spark, sf):
    return H.conversation_title(_messages(spark, sf))


def _saved(spark, sf):
    """One saved conversation per conversation id, spread over seven users."""
    titles = H.conversation_title(_messages(spark, sf))
    return titles.selectExpr("conv_id % 7 as user_id", "conv_id", "conv_id as pos", "saved_title as title")


def upsert_conversation(spark, sf):
    saved = _saved(spark, sf)
    stored = saved.where("conv_id % 3 <> 0")
    incoming = saved.where("conv_id % 2 = 0").withColumn("title", F.concat(F.lit("new "), "title"))
    return H.upsert_conversation(stored, incoming)


def keep_recent_conversations(spark, sf):
    return H.keep_recent_conversations(_saved(spark, sf))


def extract_code_blocks(spark, sf):
    return H.extract_code_blocks(_messages(spark, sf))


def extract_inline_code(spark, sf):
    return H.extract_inline_code(_messages(spark, sf))


def message_length_band(spark, sf):
    documents = table(spark, sf, "documents").selectExpr("doc_id as conv_id", "0 as turn", "text")
    return H.message_length_band(documents)


def request_from_message(spark, sf):
    asked = _messages(spark, sf).where("role = 'user'").withColumns({
        "text": F.when(F.col("conv_id") % 5 == 0, " \n ").otherwise(F.concat(F.lit(" \n"), "text")),
        "repo": F.when(F.col("turn") % 2 == 0, F.concat(F.lit("org/ns"), F.pmod("conv_id", F.lit(10))))})
    return H.request_from_message(asked).withColumn("repositories", F.array_join("repositories", "|"))


def repository_catalogue(spark, sf):
    repos = table(spark, sf, "documents").selectExpr("'Org_' || source as name", "doc_id as pos")
    return H.repository_catalogue(repos, "Org_")


QUERIES = {f.__name__: f for f in (
    fold_conversation, conversation_title, upsert_conversation, keep_recent_conversations, extract_code_blocks,
    extract_inline_code, message_length_band, request_from_message, repository_catalogue)}

_M = cte("messages")
_SAVED = _M + """, titled as (select conv_id, arg_min(text, turn) as first from messages group by all),
saved as (select conv_id % 7 as user_id, conv_id, conv_id as pos,
  left(first, 50) || case when length(first) > 50 then '...' else '' end as title from titled)
"""
_FENCE = r"'(?s)```(\w+)?\n(.*?)```'"

ORACLES = {
    "fold_conversation": _M + "select conv_id, count(*)::int as n, string_agg(role || ': ' || text, chr(10) order by turn) as messages from messages group by all",
    "conversation_title": _M + r"""select conv_id, left(trim(arg_min(text, turn) filter (role = 'user'), ' ' || chr(9) || chr(10) || chr(13)), 30) as title,
  left(arg_min(text, turn), 50) || case when length(arg_min(text, turn)) > 50 then '...' else '' end as saved_title
from messages group by conv_id""",
    "upsert_conversation": _SAVED + """, stored as (select * from saved where conv_id % 3 <> 0),
incoming as (select * from saved where conv_id % 2 = 0), start as (select user_id, min(pos) as start from stored group by all)
select user_id, conv_id, s.pos as pos, coalesce('new ' || i.title, s.title) as title
from stored s left join incoming i using (user_id, conv_id)
union all
select i.user_id, i.conv_id, coalesce(start, 0) - 1 - i.pos, 'new ' || i.title from incoming i left join start using (user_id)
where i.conv_id not in (select conv_id from stored)""",
    "keep_recent_conversations": _SAVED + """, placed as (select *, row_number() over (partition by user_id order by pos, conv_id)::int as place from saved)
select * from placed where place <= 50""",
    "extract_code_blocks": _M + f""", b as (select conv_id, turn, unnest(regexp_extract_all(text, {_FENCE}, 1)) as language,
  unnest(regexp_extract_all(text, {_FENCE}, 2)) as code, unnest(range(len(regexp_extract_all(text, {_FENCE}, 2))))::int as block from messages)
select conv_id, turn, block, case when coalesce(language, '') = '' then 'text' else language end as language, code from b""",
    "extract_inline_code": _M + f""", o as (select conv_id, turn, regexp_extract_all(regexp_replace(text, {_FENCE}, '', 'g'), '`([^`]+)`', 1) as spans from messages)
select conv_id, turn, unnest(range(len(spans)))::int as span, unnest(spans) as code from o""",
    "message_length_band": """select doc_id as conv_id, 0 as turn, length(text)::int as n_chars,
  case when length(text) > 3500 then 'error' when length(text) > 3000 then 'warning' else 'normal' end as band,
  length(text) > 4000 as over_limit from documents""",
    "request_from_message": _M + r"""select conv_id, turn, trim(text, ' ' || chr(10) || chr(9) || chr(13)) as query,
  case when turn % 2 = 0 then 'org/ns' || (conv_id % 10) else '' end as repositories
from messages where role = 'user' and conv_id % 5 <> 0""",
    "repository_catalogue": "select 'Org_' || source as name, min(doc_id) as pos, source as display_name from documents group by all",
}
