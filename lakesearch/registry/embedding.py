"""Embedding and record queries. The chunks are the non-blank lines of every derived file."""

import hashlib

from pyspark.sql import functions as F

from lakesearch.functions.file_types import code_language, file_type
from lakesearch.functions.text import count_tokens, lines_of
from lakesearch.operators import embedding as E
from lakesearch.operators.chunking import explode_chunks
from lakesearch.registry.chunking import NL, WS, _ROUTED
from lakesearch.registry.fixtures import cte, fixture

KEY = ["repo_name", "file_path", "chunk_index"]


def chunk_lines(spark, sf):
    path, content = F.col("file_path"), F.col("content")
    typed = fixture(spark, sf, "files").select(
        "repo_name", "file_path", "doc_id", file_type(path, content).alias("file_type"),
        code_language(path).alias("language"), lines_of(content).alias("chunks"))
    number = F.col("chunk_index") + 1
    return explode_chunks(typed).select(
        "*", number.alias("line_start"), number.alias("line_end"), count_tokens(F.col("content")).alias("token_count"),
        (F.col("doc_id") % 5 != 0).alias("should_embed"), F.lit("A").alias("status"),
        F.concat(F.lit("c"), F.col("doc_id") % 3).alias("commit_sha"))


def _vector_text(column="embedding"):
    return F.array_join(F.transform(column, lambda x: x.cast("int").cast("string")), ",")


def _load_hash_model():
    """A model with an empty answer for texts whose digest starts with 0."""
    def model(texts):
        digests = [hashlib.md5(t.encode()).digest() for t in texts]
        return [[float(b) for b in d] if d[0] >= 16 else [] for d in digests]

    return model


def embed_texts(spark, sf):
    rows = chunk_lines(spark, sf).select(*KEY, F.when(F.col("doc_id") % 7 != 0, F.col("content")).alias("content"))
    return E.embed_texts(rows, _load_hash_model).select(*KEY, _vector_text().alias("vector"), "embed_error")


def embed_gate(spark, sf):
    return E.embed_gate(chunk_lines(spark, sf), max_tokens=40).select(*KEY, "embedded", _vector_text().alias("vector"))


def hash_embedding(spark, sf):
    return E.hash_embed(chunk_lines(spark, sf)).select(*KEY, _vector_text().alias("vector"))


def content_chunk_id(spark, sf):
    given = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("given_"), "chunk_index")) \
        .when(F.col("doc_id") % 4 == 1, "")
    return E.content_chunk_id(chunk_lines(spark, sf).withColumn("id", given)).select(*KEY, "id")


def stable_record_id(spark, sf):
    return E.stable_record_id(chunk_lines(spark, sf)).select(*KEY, "id")


def positional_id(spark, sf):
    rows = chunk_lines(spark, sf).select(*KEY, "commit_sha", F.when(
        F.col("doc_id") % 10 == 0, F.concat(F.lit("given_"), "chunk_index")).alias("id"))
    return E.positional_id(rows, ["file_path", "chunk_index"]).select(*KEY, "commit_sha", "id")


def records(spark, sf, max_tokens=40):
    return E.sync_record(E.embed_gate(chunk_lines(spark, sf), max_tokens=max_tokens))


def sync_record(spark, sf):
    names = {c: F.array_join(c, "|") for c in ("function_names", "class_names")}
    return records(spark, sf).drop("embedding").withColumns(names)


def _enrichment(spark, sf):
    """Every second file is enriched, with some fields missing."""
    odd = F.col("chunk_index") % 2 == 1
    return chunk_lines(spark, sf).where("doc_id % 2 = 0").select(
        *KEY, F.when(odd, "logic").alias("semantic_types"), F.lit("f1,f2").alias("functions"),
        F.lit(None).cast("string").alias("classes"), F.when(odd, F.col("doc_id") / 10).alias("complexity"),
        F.when(odd, F.col("token_count")).alias("token_count"), F.col("language"),
        F.lit(None).cast("int").alias("content_length"))


def enriched(spark, sf):
    chunks = E.hash_embed(chunk_lines(spark, sf)).withColumns({
        "summary": F.when(F.col("chunk_index") % 3 == 0, F.concat(F.lit("line "), "chunk_index")),
        "chunk_type": F.when(F.col("chunk_index") % 4 == 0, "text")})
    times = fixture(spark, sf, "files").where("doc_id % 3 = 0").select(
        "repo_name", "file_path", F.col("doc_id").cast("string").alias("modified"))
    return E.enriched_record(chunks, _enrichment(spark, sf), times)


def enriched_record(spark, sf):
    return enriched(spark, sf).drop("embedding")


def upsert_batches(spark, sf):
    rows = chunk_lines(spark, sf).select(*KEY)
    return E.upsert_batches(rows, ["file_path", "chunk_index"])


def reject_empty_vectors(spark, sf):
    """Errors, and per repository the number of records kept (as batch -1)."""
    kept, errors = E.reject_empty_vectors(records(spark, sf, 60), ["file_path", "chunk_index"])
    counts = kept.groupBy("repo_name").agg(F.count(F.lit(1)).cast("string").alias("message")).withColumn(
        "batch", F.lit(-1).cast("bigint"))
    return errors.unionByName(counts, allowMissingColumns=True)


def store_many(spark, sf):
    """Enriched records stored over those of the first chunks; the last of equal ids wins."""
    rows = enriched(spark, sf).withColumns({"namespace": F.col("repo_name"), "stored_order": F.struct(
        "file_path", "chunk_index")})
    old = rows.where("chunk_index < 2").drop("stored_order").dropDuplicates(["namespace", "id"]).withColumn(
        "chunk_summary", F.lit("old"))
    table, report = E.store_many(old, rows)
    return (table.groupBy("namespace").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("chunk_summary") == "old").alias("old"),
                                           F.sum("chunk_index").alias("indexes"))
            .unionByName(report.select(F.lit("stored").alias("namespace"), F.col("stored").alias("n")),
                         allowMissingColumns=True))


QUERIES = {f.__name__: f for f in (
    embed_texts, embed_gate, hash_embedding, content_chunk_id, stable_record_id, positional_id, sync_record,
    enriched_record, upsert_batches, reject_empty_vectors, store_many)}

_VECTOR = "array_to_string(list_transform(range(1, 32, 2), lambda i: ('0x' || substr(md5(content), i, 2))::int), ',')"

LINES = cte("files") + _ROUTED + f""", lines as (
  select repo_name, file_path, doc_id, file_type, language, i::int as chunk_index, content,
    len(regexp_extract_all(content, '\\S+'))::int as token_count, doc_id % 5 <> 0 as should_embed, 'c' || (doc_id % 3) as commit_sha
  from (select * exclude (content, l), unnest(l) as content, unnest(range(len(l))) as i
    from (select *, string_split(content, {NL}) as l from routed)) where trim(content, {WS}) <> '')
"""
_ID = "sha256(repo_name || chr(1) || file_path || chr(1) || chunk_index || chr(1) || content)"
_BATCHED = LINES + f""", rec as (select *, {_ID} as id, row_number() over (partition by repo_name order by file_path, chunk_index) - 1 as n,
  not (should_embed and token_count <= 60) as bad_vector, should_embed as is_content from lines),
b as (select *, n // 10 as batch, is_content and bad_vector as bad from rec),
f as (select repo_name, batch, arg_min(file_path, n) filter (bad) as cause from b group by all having bool_or(bad))
"""

_MODIFIED = "case when doc_id % 3 = 0 then doc_id::varchar else '' end"
_LANGUAGE = """case ext when '.py' then 'python' when '.js' then 'javascript' when '.html' then 'html' when '.yaml' then 'yaml'
  when '.json' then 'json' when '.md' then 'markdown' else 'unknown' end"""
_ENRICHED = LINES + f""", made as (select *, lower(regexp_extract(file_path, '[^/](\\.[^./]+)$', 1)) as ext, doc_id % 2 = 0 as e, chunk_index % 2 = 1 as odd,
  repo_name || '_' || string_split(file_path, '/')[-1] || '_' || left(md5(content), 16) as id from lines),
enriched as (select id, repo_name, file_path, chunk_index, content, case when chunk_index % 3 = 0 then 'line ' || chunk_index else '' end as chunk_summary,
  id as chunk_id, {_LANGUAGE} as language, {_MODIFIED} as timestamp, chunk_index + 1 as line_start, chunk_index + 1 as line_end,
  case when chunk_index % 4 = 0 then 'text' else 'code' end as chunk_type,
  case when e then case when odd then 'logic' else '' end end as semantic_types, case when e then 'f1,f2' end as functions,
  case when e then '' end as classes, case when e then case when odd then doc_id / 10.0e0 else 0.0e0 end end as code_complexity,
  case when e then case when odd then token_count else 0 end end as token_count, case when e then language end as language_detected,
  case when e then length(content)::int end as content_length from made)
"""

ORACLES = {
    "embed_texts": LINES + f"""select repo_name, file_path, chunk_index,
  case when doc_id % 7 = 0 or md5(content) like '0%' then '' else {_VECTOR} end as vector,
  case when doc_id % 7 = 0 then 'Empty text provided for embedding' when md5(content) like '0%' then 'Received empty embedding' end as embed_error
from lines""",
    "embed_gate": LINES + f"""select repo_name, file_path, chunk_index, should_embed and token_count <= 40 as embedded,
  case when should_embed and token_count <= 40 then {_VECTOR} else '' end as vector from lines""",
    "hash_embedding": LINES + f"select repo_name, file_path, chunk_index, {_VECTOR} as vector from lines",
    "content_chunk_id": LINES + """select repo_name, file_path, chunk_index, case when doc_id % 4 = 0 then 'given_' || chunk_index
  else repo_name || '_' || string_split(file_path, '/')[-1] || '_' || left(md5(content), 16) end as id from lines""",
    "stable_record_id": LINES + f"select repo_name, file_path, chunk_index, {_ID} as id from lines",
    "positional_id": LINES + """select repo_name, file_path, chunk_index, commit_sha, case when doc_id % 10 = 0 then 'given_' || chunk_index else
  repo_name || '_' || commit_sha || '_' || (row_number() over (partition by repo_name, commit_sha order by file_path, chunk_index) - 1) end as id from lines""",
    "sync_record": LINES + f"""select {_ID} as id, repo_name as namespace, repo_name, file_path, file_type, language, chunk_index,
  case when should_embed then 'content' else 'summary' end as chunk_type, {_ID} as chunk_id, content, chunk_index + 1 as line_start,
  chunk_index + 1 as line_end, 'L' || (chunk_index + 1) || '-L' || (chunk_index + 1) as line_range,
  should_embed and token_count <= 40 as embedded, should_embed, 'A' as status, token_count, commit_sha, true as live,
  least(1.0::double, len(regexp_extract_all(content, '{E.BRANCH}')) / 10.0::double) as code_complexity,
  array_to_string(list_sort(list_distinct(regexp_extract_all(content, '{E.FUNCTION_NAME}', 1))), '|') as function_names,
  array_to_string(list_sort(list_distinct(regexp_extract_all(content, '{E.CLASS_NAME}', 1))), '|') as class_names from lines""",
    "enriched_record": _ENRICHED + "select * from enriched",
    "upsert_batches": LINES + """select repo_name, file_path, chunk_index,
  (row_number() over (partition by repo_name order by file_path, chunk_index) - 1) // 10 as batch from lines""",
    "reject_empty_vectors": _BATCHED + """select distinct repo_name, batch, file_path, 'upsert' as operation,
  'Attempted to upsert empty embedding: ' || cause as message, 'A' as status from b join f using (repo_name, batch)
union all select repo_name, -1, null, null, count(*)::varchar, null from b left join f using (repo_name, batch) where f.batch is null group by all""",
    "store_many": _ENRICHED + """, last as (select repo_name as namespace, id, max(struct_pack(file_path := file_path, chunk_index := chunk_index)).chunk_index as chunk_index
  from enriched group by all)
select namespace, count(*) as n, 0::bigint as old, sum(chunk_index)::bigint as indexes from last group by all
union all select 'stored', count(*), null, null from enriched""",
}
