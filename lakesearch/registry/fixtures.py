"""Inputs derived from the supplied tables, in Spark SQL and in DuckDB SQL.

The reads are whole tables: no id subset, no prefix, no row cap. ``SQL[name]`` is
the text both engines share (``<<spark<|>duckdb>>`` alternatives are resolved per engine).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ["documents", "embeddings", "conversations", "events", "part", "pages"]

_EXT = """(case doc_id % 9 when 0 then '.md' when 1 then '.py' when 2 then '.txt' when 3 then '.json'
  when 4 then '.csv' when 5 then '.js' when 6 then '.yaml' when 7 then '.html' else '' end)"""

_MD = ("<<array_join(transform(split(text, chr(10)), (x, i) -> case when i % 4 = 0 then '# ' || x else x end), chr(10))"
       "<|>array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: case when (i - 1) % 4 = 0 then '# ' || x else x end), chr(10))>>")
_CODE = ("<<array_join(transform(split(text, chr(10)), (x, i) -> case i % 5 when 0 then 'def fn_' || i || '(): ' || x"
         " when 1 then 'import ' || x else x end), chr(10))"
         "<|>array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: case (i - 1) % 5 when 0 then"
         " 'def fn_' || (i - 1) || '(): ' || x when 1 then 'import ' || x else x end), chr(10))>>")

SQL = {
    "files": f"""
select source as repo_name, lang || '/doc_' || doc_id || {_EXT} as file_path, doc_id,
  case doc_id % 9
    when 0 then {_MD} when 1 then {_CODE} when 5 then {_CODE}
    when 3 then '{{"doc_id":' || doc_id || ',"meta":{{"lang":"' || lang || '","source":"' || source
                || '"}},"sizes":[' || n_chars || ',' || (n_chars % 7) || ']}}'
    when 4 then replace(text, ' ', ',')
    when 6 then 'doc_id: ' || doc_id || chr(10) || 'lang: ' || lang || chr(10) || 'source: ' || source
    when 8 then (case when doc_id % 2 = 0 then '#!/usr/bin/env python' else '#!/bin/bash' end) || chr(10) || text
    else text end as content
from documents""",
    "vectors": """
select 'v' || vec_id as id, 'ns' || label as namespace, 'org/ns' || label as repo_name,
  'dir' || (vec_id % 7) || '/file_' || (vec_id % 40)
     || (case vec_id % 4 when 0 then '.py' when 1 then '.md' when 2 then '.json' else '.html' end) as file_path,
  cast(vec_id % 3 as int) * 50 + 1 as line_start,
  (vec_id % 10) / 10.0e0 as code_complexity,
  'def fn_' || (vec_id % 5) || ' uses widget ' || (vec_id % 11) as content,
  <<array('fn_' || (vec_id % 5))<|>['fn_' || (vec_id % 5)]>> as function_names,
  <<array('Cls' || (vec_id % 6))<|>['Cls' || (vec_id % 6)]>> as class_names,
  vec_id % 2 = 0 as live, 'c' || (vec_id % 4) as commit_sha, vec_id, embedding
from embeddings""",
    "questions": """
select p_partkey as query_id, case p_partkey % 10
  when 0 then 'What is the purpose of ' || p_name
  when 1 then 'How does the ' || p_name || ' process work'
  when 2 then 'Show me an example of file_' || (p_partkey % 40) || '.py usage'
  when 3 then 'Compare ' || p_name || ' versus another option'
  when 4 then 'Fix the error in fn_' || (p_partkey % 5) || '() because it fails'
  when 5 then 'Build a new Cls' || (p_partkey % 6) || ' component for the backend api'
  when 6 then 'Where is file_' || (p_partkey % 40 + 3) || '.md located'
  when 7 then 'find class Cls' || (p_partkey % 6) || ' and function fn_' || (p_partkey % 5)
  when 8 then p_name else '' end as query
from part""",
    "snapshots": """
select source as repo_name, 'old' as side, lang || '/doc_' || doc_id as path, md5(text) as blob
from documents where doc_id % 10 <> 0
union all
select source, 'new', lang || (case when doc_id % 8 = 0 then '/moved_' else '/doc_' end) || doc_id,
  md5(case when doc_id % 7 = 0 then text || '!' else text end)
from documents where doc_id % 10 <> 1""",
    "change_lines": """
select doc_id as seq, source as repo_name, case doc_id % 6
  when 0 then 'A' || chr(9) || lang || '/doc_' || doc_id
  when 1 then 'M' || chr(9) || lang || '/doc_' || doc_id
  when 2 then 'D' || chr(9) || lang || '/doc_' || doc_id
  when 3 then 'R100' || chr(9) || lang || '/doc_' || doc_id || chr(9) || lang || '/moved_' || doc_id
  when 4 then 'T' || chr(9) || lang || '/doc_' || doc_id
  else 'M' end as line
from documents""",
    "change_tokens": """
select doc_id as seq, source as repo_name, (case doc_id % 6 when 0 then 'A:' when 1 then ' m:' when 2 then 'D:'
  when 3 then 'R:' when 4 then 'a:x:' else '' end) || lang || '/doc_' || doc_id as token
from documents""",
    "submodule_lines": """
select doc_id, 'Submodule libs/' || source || ' '
  || (case doc_id % 3 when 0 then '0000000' else left(md5('o' || doc_id), 7) end) || '..'
  || (case doc_id % 3 when 1 then '0000000' else left(md5('n' || doc_id), 7) end) || ' (x):' as line
from documents""",
    "ci_events": """
select event_id,
  case when event_type in ('view','click') then 'push'
       when event_type = 'purchase' then 'pull_request' else event_type end as event_name,
  case when event_id % 3 = 0 then null else md5('h' || event_id) end as env_sha,
  case when event_type = 'purchase'
    then '{"pull_request":{"base":{"sha":"' || md5('b' || event_id) || '"},"merge_commit_sha":'
         || (case when event_id % 2 = 0 then 'null' else '"' || md5('m' || event_id) || '"' end) || '}}'
    else '{"before":"' || (case event_id % 4 when 0 then '0000000000000000000000000000000000000000'
                                             when 1 then '' else md5('p' || event_id) end)
         || '","after":"' || (case when event_id % 5 = 0 then '' else md5('a' || event_id) end) || '"}'
  end as payload, ts
from events""",
    "error_lines": """
select event_id, ts, case when event_id % 10 = 0 then '{bad'
  else '{"file_path":"u' || user_id || '/f' || event_id || '","operation":"'
    || (case event_id % 3 when 0 then 'process' when 1 then 'delete' else 'upsert' end) || '","message":"m"'
    || (case event_id % 4 when 0 then '' when 1 then ',"status":"a"' when 2 then ',"status":"Z"' else ',"status":"D"' end)
    || '}' end as line
from events""",
    "messages": """
select conv_id, turn, role, case when role = 'assistant' and turn % 2 = 1
  then 'See `name_' || turn || '` and' || chr(10) || repeat(chr(96),3)
    || (case when conv_id % 2 = 0 then 'py' else '' end) || chr(10) || 'x = ' || conv_id || chr(10)
    || repeat(chr(96),3) || chr(10) || text
  else text end as text
from conversations""",
    "raw_requests": """
select event_id as query_id, (case when event_id % 13 = 0 then '  ' else event_type || ' ' || user_id end) as query,
  cast(floor(value) as int) as top_k, cast(event_id % 30 as int) as per_ns_k,
  (case when event_id % 11 = 0 then 'high' else cast(round(value / 100, 4) as <<string<|>varchar>>) end) as min_score
from events""",
    "archive_paths": """
select 'c' || (vec_id % 4) as commit_sha, 'org/ns' || label as repo_name,
  'vectors/org/ns' || label || '/c' || (vec_id % 4) || '/archive.json' as path
from embeddings""",
    "profiles": """
select namespace, <<split(keywords, ',')<|>string_split(keywords, ',')>> as keywords,
  <<split(file_types, ',')<|>string_split(file_types, ',')>> as file_types,
  <<split(clues, ',')<|>string_split(clues, ',')>> as structure_clues
from (values ('ns0', 'frontend,component,page,style', '.html,.md', 'pages'),
             ('ns1', 'backend,api,function,service', '.py,.json', 'dir1'),
             ('ns2', 'error,test,debug,query', '.py,.md', 'dir2'),
             ('ns3', 'data,model,class', '.json', 'dir3')) as t(namespace, keywords, file_types, clues)""",
    "repo_namespaces": """
select * from (values ('org/ns0', 'ns0'), ('org/ns1', 'ns1'), ('org/ns2', 'ns2'), ('org/ns3', 'ns3'))
  as t(repo_name, namespace)""",
}


def _dialect(text: str, side: int) -> str:
    return re.sub(r"<<(.*?)<\|>(.*?)>>", lambda m: m.group(1 + side), text, flags=re.S)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The derived input ``name`` as a Spark DataFrame."""
    text = _dialect(SQL[name], 0)
    used = [t for t in TABLES if re.search(rf"\bfrom {t}\b", text)]
    if not used:
        return spark.sql(text)
    text = text.replace("{", "{{").replace("}", "}}")
    text = re.sub(r"\bfrom (%s)\b" % "|".join(used), r"from {\1}", text)
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in used})


def cte(*names: str) -> str:
    """``with`` clause that defines the derived inputs for DuckDB."""
    return "with recursive " + ",\n".join(f"{n} as ({_dialect(SQL[n], 1)})" for n in names)
