"""Chat formatting of tool calls, in DataFrame operations only.

Calls and results are joined by identifier. Calls are ordered topologically by their
references to other calls, a call's level being the longest chain of references below it. Arguments are checked against
the schema of their tool, and each call with its result is serialised as canonical JSON:
keys sorted at every depth, no blanks.

Only calls with references to known calls are ordered, as narrow rows; the
place within a conversation is numbered over ranges, so a conversation with a third of all
calls is not sorted in one task.

Defined cases: a call without id cannot be referred to and has no result; of several results with one id the
first by position counts, and ``n_results`` tells their number; equal calls share their result; references to unknown
calls are ignored; calls on a cycle, and those that wait for one, have no level, come last and are marked ``cyclic``;
null, malformed or non-object arguments are marked ``malformed`` and serialised as null; a tool without schema is
marked ``unknown tool``; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakesearch.functions.numbering import numbered
from lakesearch.functions.text import let
from lakesearch.llm.common import table
from lakesearch.session import staged


def topological_levels(calls: DataFrame) -> DataFrame:
    """(call_id, level) of the calls with references, level null where a cycle is in the way.

    ``calls`` has (call_id, depends_on array<string>); calls without known references are level 0 and not listed.
    Calls with one reference form chains, which are contracted by doubling: after n rounds each
    knows the call 2 ** n steps on, so a chain of any length takes the logarithm of its length. What remains is placed
    round by round: each call with several references whose targets all have a level.
    """
    known = calls.where("call_id is not null").select("call_id").distinct()
    edges = staged(calls.where("call_id is not null").select("call_id", F.explode("depends_on").alias("on")).distinct()
                   .join(known.withColumnRenamed("call_id", "on"), "on", "left_semi"), "edges")
    degree = edges.groupBy("call_id").agg(F.count(F.lit(1)).alias("n"), F.min("on").alias("on"))
    chain = staged(degree.where("n = 1").select("call_id", "on", F.lit(1).alias("steps")), "chain")
    far = lambda: chain.select(F.col("call_id").alias("on"), F.col("on").alias("next"), F.col("steps").alias("more"))
    for _ in range(chain.count().bit_length()):  # what is not at a chain's end by then runs in a circle
        if chain.join(far(), "on", "left_semi").isEmpty():
            break
        chain = staged(chain.join(far(), "on", "left").select(
            "call_id", F.coalesce("next", "on").alias("on"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")), "chain")
    chain = staged(chain.join(far(), "on", "left_anti").select("call_id", F.col("on").alias("end"), "steps"), "chain")

    several = degree.where("n > 1").select("call_id", "n")
    circles = degree.where("n = 1").select(F.col("call_id").alias("on")).join(chain.select(F.col("call_id").alias("on")), "on", "left_anti")
    waiting = staged(edges.join(several, "call_id").join(chain.withColumnRenamed("call_id", "on"), "on", "left").select(
        "call_id", "n", "on", F.coalesce("end", "on").alias("end"), F.coalesce("steps", F.lit(0)).alias("steps"))
        .join(circles, "on", "left_anti"), "waiting")
    roots = edges.select(F.col("on").alias("end")).distinct().join(edges.select(F.col("call_id").alias("end")).distinct(), "end", "left_anti")
    placed = staged(roots.select("end", F.lit(0).alias("level")), "placed")
    while True:
        ready = (waiting.join(placed, "end").groupBy("call_id", "n").agg(F.count(F.lit(1)).alias("done"), F.max(F.col("level") + F.col("steps")).alias("top"))
                 .where("done = n").select(F.col("call_id").alias("end"), (F.col("top") + 1).alias("level"))
                 .join(placed.select("end"), "end", "left_anti"))
        ready = staged(ready, "placed")
        if ready.isEmpty():
            break
        placed = staged(placed.unionByName(ready), "placed")
    ends = chain.join(placed, "end").select("call_id", (F.col("level") + F.col("steps")).alias("level"))
    levels = ends.unionByName(placed.select(F.col("end").alias("call_id"), "level").join(several, "call_id", "left_semi"))
    return degree.select("call_id").join(levels, "call_id", "left").select("call_id", F.col("level").cast("int").alias("level"))


def _kind(value: Column) -> Column:
    """JSON type of a variant, by the names that schemas use."""
    name = F.schema_of_variant(value)
    return (F.when(name == "STRING", "string").when(name == "BOOLEAN", "boolean").when(name == "BIGINT", "integer")
            .when(name.startswith("DECIMAL") | name.isin("DOUBLE", "FLOAT"), "number").when(name.startswith("OBJECT"), "object")
            .when(name.startswith("ARRAY"), "array").otherwise("null"))


def argument_errors(arguments: Column, params: Column) -> Column:
    """Sorted messages for an argument map<string,variant> against array<struct<name,type,required>>."""
    absent = F.filter(params, lambda p: p.required & ~F.map_contains_key(arguments, p["name"]))
    present = F.filter(params, lambda p: F.map_contains_key(arguments, p["name"]))
    odd = F.filter(present, lambda p: let(_kind(F.element_at(arguments, p["name"])), lambda k: (
        (k != p["type"]) & ~((k == "integer") & (p["type"] == "number")))))
    names = F.transform(params, lambda p: p["name"])
    extra = F.filter(F.map_keys(arguments), lambda k: ~F.array_contains(names, k))
    return F.array_sort(F.concat(F.transform(absent, lambda p: F.concat(F.lit("missing "), p["name"])),
                                 F.transform(odd, lambda p: F.concat(F.lit("type of "), p["name"])),
                                 F.transform(extra, lambda k: F.concat(F.lit("unknown "), k))))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """(conv_id, call_id, position, place, level, cyclic, n_results, errors, message).

    ``calls``: (conv_id, call_id, position, name, arguments, depends_on); ``results``: (call_id, position, content);
    ``schemas``: (name, params array<struct<name,type,required>>). ``place`` numbers the calls of a conversation from 0.
    """
    calls = calls.select("conv_id", "call_id", "position", F.col("name").alias("tool"), "arguments", "depends_on")
    answers = results.where("call_id is not null").groupBy("call_id").agg(
        F.count(F.lit(1)).alias("n_results"), F.min_by("content", F.struct("position", "content")).alias("content"))
    specs = schemas.select(F.col("name").alias("tool"), "params").groupBy("tool").agg(F.first("params").alias("params"))
    levels = topological_levels(calls).select("call_id", "level", F.lit(True).alias("bound"))
    linked = (calls.join(answers, "call_id", "left").join(specs, "tool", "left").join(levels, "call_id", "left")
              .withColumn("cyclic", F.col("bound").isNotNull() & F.col("level").isNull())
              .withColumn("level", F.when(F.col("bound").isNull(), 0).otherwise(F.col("level"))))
    parsed = F.try_parse_json("arguments")
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    checked = linked.withColumn("parsed", F.when(is_object, parsed)).withColumn(
        "errors", F.when(F.col("parsed").isNull(), F.array(F.lit("malformed"))).when(F.col("params").isNull(), F.array(F.lit("unknown tool")))
        .otherwise(argument_errors(F.col("parsed").cast("map<string,variant>"), F.col("params"))))
    null = F.lit("null")
    message = F.concat(
        F.lit('{"arguments":'), F.coalesce(F.to_json("parsed"), null), F.lit(',"id":'), _json(F.col("call_id")),
        F.lit(',"name":'), _json(F.col("tool")), F.lit(',"result":'), _json(F.col("content")), F.lit("}"))
    ready = checked.select("conv_id", "call_id", "position", "level", "cyclic", F.coalesce("n_results", F.lit(0).cast("long")).alias("n_results"),
                           "errors", message.alias("message"), F.col("level").isNull().alias("last"))
    placed = numbered(ready, ["conv_id"], ["last", "level", "position", "call_id", "message"], "place")
    return placed.select("conv_id", "call_id", "position", F.col("place").cast("long").alias("place"), "level", "cyclic",
                         "n_results", "errors", "message")


def _json(value: Column) -> Column:
    """A JSON string literal, or null."""
    whole = F.to_json(F.struct(value.alias("v")))
    return F.coalesce(F.when(value.isNotNull(), F.substring(whole, 6, 2**31 - 1).substr(F.lit(1), F.length(whole) - 6)), F.lit("null"))


#: Tools of the query's calls.
SCHEMAS = "values ('search', array(named_struct('name','query','type','string','required',true), named_struct('name','limit','type','integer','required',true))), " \
          "('lookup', array(named_struct('name','key','type','string','required',true), named_struct('name','exact','type','boolean','required',false))) as t(name, params)"


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every assistant turn is a call that asks with its whole text, every other turn the result of the turn before.

    Later turns of a conversation refer to the turn two before, turn 1 to turn 3, and in one conversation of five
    turn 5 and turn 7 refer to each other; every 11th call has broken arguments, every 7th names no known tool.
    """
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    ident = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    turn, key = F.col("turn"), F.col("conv_id") * 8 + F.col("turn")
    quoted = _json(F.col("text"))
    search = F.concat(F.lit('{ "query" : '), quoted, F.lit(', "limit": '),
                      F.when(key % 5 == 0, F.lit('"ten"')).otherwise((turn + 1).cast("string")), F.lit(" }"))
    find = F.concat(F.lit('{"key":'), quoted, F.when(key % 4 == 1, F.lit(', "exact":true')).when(key % 4 == 2, F.lit(', "deep":{"b":1, "a":[ ]}')).otherwise(""), F.lit("}"))
    is_search = F.col("conv_id") % 2 == 0
    back, ahead = ident(turn - 2), ident(turn + 2)
    calls = turns.where("role = 'assistant'").select(
        "conv_id", ident(turn).alias("call_id"), turn.alias("position"),
        F.when(key % 7 == 0, "other").when(is_search, "search").otherwise("lookup").alias("name"),
        F.when(key % 11 == 0, F.lit("{oops")).when(is_search, search).otherwise(find).alias("arguments"),
        F.when(turn == 1, F.array(ahead)).when((turn == 5) & (F.col("conv_id") % 5 == 0), F.array(back, ahead))
        .when(turn >= 4, F.array(back)).otherwise(F.array().cast("array<string>")).alias("depends_on"))
    results = turns.where("not (role <=> 'assistant')").select(ident(turn - 1).alias("call_id"), turn.alias("position"), F.col("text").alias("content"))
    linked = link_tool_calls(calls, results, spark.sql(f"select * from {SCHEMAS}"))
    return linked.withColumn("errors", F.array_join("errors", "; "))


SQL = """
with recursive m as (select conv_id, turn, role, coalesce(text, '') as text, conv_id * 8 + turn as k from conversations),
c as (select conv_id, turn, 'c' || conv_id || '-' || turn as call_id, k, text,
    case when k % 7 = 0 then 'other' when conv_id % 2 = 0 then 'search' else 'lookup' end as tool,
    case when turn = 1 then [turn + 2] when turn = 5 and conv_id % 5 = 0 then [turn - 2, turn + 2] when turn >= 4 then [turn - 2] else [] end as deps
  from m where role = 'assistant'),
e as (select distinct d.conv_id, d.turn, d.ref from (select conv_id, turn, unnest(deps) as ref from c) d join c on c.conv_id = d.conv_id and c.turn = d.ref),
walk as (select conv_id, turn, ref, 1 as depth from e
  union select w.conv_id, w.turn, e.ref, depth + 1 from walk w join e on e.conv_id = w.conv_id and e.turn = w.ref where depth < 12),
lv as (select conv_id, turn, max(depth) as depth from walk group by 1, 2),
r as (select conv_id, turn - 1 as turn, count(*) as n, min(text) as content from m where role <> 'assistant' group by 1, 2),
j as (select c.conv_id, c.call_id, c.turn as position, case when coalesce(depth, 0) < 12 then coalesce(depth, 0) end::int as level,
    coalesce(depth, 0) >= 12 as cyclic, coalesce(n, 0)::bigint as n_results,
    case when k % 11 = 0 then 'malformed' when k % 7 = 0 then 'unknown tool' when c.conv_id % 2 = 0 then (case when k % 5 = 0 then 'type of limit' else '' end)
      else (case when k % 4 = 2 then 'unknown deep' else '' end) end as errors,
    '{"arguments":' || case when k % 11 = 0 then 'null'
      when c.conv_id % 2 = 0 then '{"limit":' || (case when k % 5 = 0 then '"ten"' else (c.turn + 1)::varchar end) || ',"query":' || to_json(text)::varchar || '}'
      else '{' || (case when k % 4 = 1 then '"exact":true,' when k % 4 = 2 then '"deep":{"a":[],"b":1},' else '' end) || '"key":' || to_json(text)::varchar || '}' end
    || ',"id":' || to_json(c.call_id)::varchar || ',"name":' || to_json(tool)::varchar
    || ',"result":' || coalesce(to_json(r.content)::varchar, 'null') || '}' as message
  from c left join lv on lv.conv_id = c.conv_id and lv.turn = c.turn left join r on r.conv_id = c.conv_id and r.turn = c.turn)
select *, (row_number() over (partition by conv_id order by level is null, level, position, call_id, message) - 1)::bigint as place from j"""
