"""Chunking queries. Chunkers that take any text run over all documents or all files."""

from pyspark.sql import functions as F

from lakesearch.functions import chunkers as K
from lakesearch.functions.file_types import code_language
from lakesearch.functions.text import count_tokens as token_count, lines_of
from lakesearch.operators import chunking as C
from lakesearch.registry.fixtures import cte, fixture, table


def files(spark, sf):
    return fixture(spark, sf, "files").withColumn("size_bytes", F.octet_length("content").cast("bigint"))


def chunks(spark, sf):
    return C.chunk_files(files(spark, sf))


def _documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


def _numbered(df, key, array):
    return df.select(key, F.posexplode(array).alias("chunk_index", "content"))


def chunk_code(spark, sf):
    return _numbered(files(spark, sf), "doc_id", K.code_chunks(F.col("content")))


def chunk_markdown(spark, sf):
    return _numbered(files(spark, sf), "doc_id", K.markdown_chunks(F.col("content")))


def chunk_json(spark, sf):
    return _numbered(files(spark, sf), "doc_id", K.json_chunks(F.col("content")))


def chunk_yaml(spark, sf):
    """Every third line of a document opens a block, the others are indented."""
    lines = F.transform(lines_of(F.col("text")), lambda x, i: F.when(i % 3 == 1, F.concat(F.lit("key: "), x))
                        .otherwise(F.concat(F.lit("  "), x)))
    return _numbered(_documents(spark, sf), "doc_id", K.yaml_chunks(F.array_join(lines, "\n")))


def chunk_sentences(spark, sf):
    return _numbered(_documents(spark, sf), "doc_id", K.sentence_chunks(F.col("text")))


def chunk_table_preview(spark, sf):
    return _numbered(files(spark, sf), "doc_id", K.table_preview(F.col("file_path"), F.col("content")))


def chunk_summary(spark, sf):
    """Sizes run up to tens of megabytes; the type cycles through the listed ones."""
    kind = F.element_at(F.array(*[F.lit(k) for k in K.SUMMARY_PREVIEW_TYPES + ["bin"]]),
                        (F.pmod("doc_id", F.lit(6)) + 1).cast("int"))
    return _numbered(files(spark, sf), "doc_id", K.summary_chunk(
        F.col("file_path"), kind, F.col("size_bytes") * 777, F.col("content")))


def rechunk_oversize(spark, sf):
    return _numbered(_documents(spark, sf), "doc_id", K.rechunk_oversize(F.array("text"), 60))


def explode_chunks(spark, sf):
    return C.explode_chunks(_documents(spark, sf).select("doc_id", lines_of(F.col("text")).alias("chunks")))


def classify_chunk_type(spark, sf):
    return files(spark, sf).select("doc_id", K.chunk_kind(F.col("content"), code_language(F.col("file_path"))).alias("kind"))


def line_range(spark, sf):
    """Line range of each code window in its file."""
    rows = files(spark, sf).select("doc_id", K.search_lines(F.col("content")).alias("lines"),
                                   F.posexplode(K.code_chunks(F.col("content"))).alias("chunk_index", "chunk"))
    found = rows.select("doc_id", "chunk_index", K.line_span(F.col("chunk"), F.col("lines")).alias("s"))
    return found.select("doc_id", "chunk_index", C.line_range(F.col("s.first"), F.col("s.last")).alias("line_range"))


def count_tokens(spark, sf):
    return _documents(spark, sf).select("doc_id", token_count(F.col("text")).alias("tokens"))


def chunk_detail(spark, sf):
    """One file in eleven cannot be read."""
    content = F.when(F.pmod("doc_id", F.lit(11)) != 0, F.col("content"))
    return C.chunk_detail(files(spark, sf).withColumn("content", content))


def chunk_stats(spark, sf):
    return C.chunk_stats(chunks(spark, sf))


QUERIES = {f.__name__: f for f in (
    chunk_code, chunk_markdown, chunk_json, chunk_yaml, chunk_sentences, chunk_table_preview, chunk_summary,
    rechunk_oversize, explode_chunks, classify_chunk_type, line_range, count_tokens, chunk_detail, chunk_stats)}

# ---- oracles: each chunker as a query over a source with (doc_id, content) ------------

WS = "' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"
NL = "chr(10)"
_WORDS = r"len(regexp_extract_all({}, '\S+'))"


def _strip(x):
    return f"trim({x}, {WS})"


def _nonblank(name, source, order):
    """Renumber the non-blank chunks of ``source(doc_id, ord..., content)``."""
    return f"""{name} as (select doc_id, (row_number() over (partition by doc_id order by {order}) - 1)::int as chunk_index, content
  from {source} where {_strip('content')} <> '')"""


def sql_code(source):
    return f"""code_lines as (select doc_id, string_split(content, {NL}) as l from {source}),
code_windows as (select doc_id, w, array_to_string(l[w * 35 + 1:w * 35 + 50], {NL}) as win from
  (select doc_id, l, unnest(range(greatest(0, ceil((len(l) - 50) / 35.0))::int + 1)) as w from code_lines)),
code_cut as (select doc_id, w, unnest(range(len(p))) as o, unnest(p) as content from (
  select doc_id, w, case when length(win) <= 2000 then [win] else list_transform(
    regexp_extract_all(win, '(?s).{{0,1000}}.{{1,1000}}(?:\\n|\\z)|(?s:.{{1000}}.{{1000}})'), lambda x: regexp_replace(x, '\\n\\z', '')) end as p
  from code_windows)),
{_nonblank('code_chunks', 'code_cut', 'w, o')}"""


def sql_markdown(source):
    return f"""md_lines as (select doc_id, unnest(range(len(l))) as i, unnest(l) as line from
  (select doc_id, string_split(content, {NL}) as l from {source})),
md_flags as (select *, coalesce(sum((ltrim(line) like '```%')::int) over (partition by doc_id order by i
  rows between unbounded preceding and 1 preceding), 0) % 2 as fenced from md_lines),
md_sections as (select *, sum((i = 0 or (fenced = 0 and regexp_matches(line, '^#{{1,6}} ')))::int) over (partition by doc_id order by i) as s from md_flags),
md_text as (select doc_id, s, string_agg(line, {NL} order by i) as content from md_sections group by all),
{_nonblank('markdown_chunks', 'md_text', 's')}"""


def sql_json(source):
    """The derived JSON files have the keys doc_id, meta and sizes."""
    return f"""json_docs as (select doc_id, content::json as j from {source}),
json_text as (
  select doc_id, 0 as o, 'doc_id ' || json_extract_string(j, '$.doc_id') as content from json_docs
  union all select doc_id, 1, 'meta lang ' || json_extract_string(j, '$.meta.lang') || {NL} || 'meta source ' || json_extract_string(j, '$.meta.source') from json_docs
  union all select doc_id, 2, 'sizes ' || json_extract_string(j, '$.sizes[0]') || {NL} || 'sizes ' || json_extract_string(j, '$.sizes[1]') from json_docs),
{_nonblank('json_chunks', 'json_text', 'o')}"""


def sql_yaml(source):
    return f"""yaml_lines as (select doc_id, unnest(range(len(l))) as i, unnest(l) as line from
  (select doc_id, string_split(content, {NL}) as l from {source})),
yaml_blocks as (select *, sum((i = 0 or regexp_matches(line, '^(?:[^\\s#\\-][^:]*:(?:\\s|$)|- )'))::int) over (partition by doc_id order by i) as b from yaml_lines),
yaml_text as (select doc_id, b, string_agg(line, {NL} order by i) as content from yaml_blocks group by all),
{_nonblank('yaml_chunks', 'yaml_text', 'b')}"""


def _sentences(x):
    return f"string_split(regexp_replace({_strip(x)}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))"


def sql_sentences(source, size=K.SENTENCE_TOKENS, overlap=K.SENTENCE_OVERLAP):
    return f"""st_parts as (select doc_id, o, p, {_WORDS.format('p')} as n from
  (select doc_id, unnest(range(len(s))) as o, unnest(s) as p from (select doc_id, {_sentences('content')} as s from {source}))),
st_split as (select doc_id, o, q, case when n <= {size} then p else array_to_string(ws[q * {size} + 1:(q + 1) * {size}], ' ') end as txt from
  (select *, regexp_split_to_array({_strip('p')}, '\\s+') as ws, unnest(range(greatest(1, ceil(n / {size}.0))::int)) as q from st_parts)),
st_pieces as (select doc_id, row_number() over (partition by doc_id order by o, q) - 1 as i, txt, {_WORDS.format('txt')} as n from st_split),
st_docs as (select doc_id, list(n order by i) as lens from st_pieces group by all),
st_walk(doc_id, lens, i, first, used, c) as (
  select doc_id, lens, 0::bigint, 0::bigint, lens[1]::bigint, 0::bigint from st_docs
  union all
  select doc_id, lens, i + 1, case when fits then first else f end, case when fits then used + n else coalesce(list_sum(lens[f + 1:i + 1]), 0) + n end,
    case when fits then c else c + 1 end
  from (select *, used + n <= {size} as fits, list_filter(range(first + 1, i + 2),
      lambda j: coalesce(list_sum(lens[j + 1:i + 1]), 0) <= least({overlap}, {size} - n))[1] as f
    from (select *, lens[i + 2]::bigint as n from st_walk where i + 1 < len(lens)))),
st_spans as (select doc_id, c, any_value(first) as first, max(i) as last from st_walk group by all),
st_text as (select s.doc_id, c, string_agg(txt, ' ' order by p.i) as content from st_spans s
  join st_pieces p on p.doc_id = s.doc_id and p.i between first and last group by all),
{_nonblank('sentence_chunks', 'st_text', 'c')}"""


def sql_rechunk(source, limit):
    """Sections(doc_id, ord, content) → rechunked(doc_id, chunk_index, content)."""
    return f"""rc_in as (select doc_id, {_strip('content')} as content from {source} where {_strip('content')} <> ''),
rc_parts as (select doc_id, o, p, {_WORDS.format('p')} as n from
  (select doc_id, unnest(range(len(s))) as o, unnest(s) as p from (select doc_id, {_sentences('content')} as s from rc_in
   where {_WORDS.format('content')} > {limit}))),
rc_docs as (select doc_id, list(n order by o) as lens from rc_parts group by all),
rc_walk(doc_id, lens, o, used, c) as (
  select doc_id, lens, 0::bigint, lens[1]::bigint, 0::bigint from rc_docs
  union all
  select doc_id, lens, o + 1, case when used + lens[o + 2] > {limit} then lens[o + 2] else used + lens[o + 2] end,
    case when used + lens[o + 2] > {limit} then c + 1 else c end from rc_walk where o + 1 < len(lens)),
rc_packs as (select doc_id, c, {_strip("string_agg(p, ' ' order by o)")} as content from rc_walk join rc_parts using (doc_id, o) group by all),
rc_cut as (select doc_id, c, unnest(range(len(x))) as k, unnest(x) as content from (select doc_id, c,
  case when {_WORDS.format('content')} <= {limit} then [content]
  else list_transform(regexp_extract_all(content, '.{{0,1000}}.{{0,1000}}.{{1,1000}}(?:\\s+|$)'), lambda y: {_strip('y')}) end as x from rc_packs)
  union all select doc_id, 0, 0, content from rc_in where {_WORDS.format('content')} <= {limit}),
{_nonblank('rechunked', 'rc_cut', 'c, k')}"""


_PREVIEW = f"""'CSV/TSV File: ' || string_split(file_path, '/')[-1] || {NL} || 'First 20 lines preview:' || {NL}
  || array_to_string(string_split(content, {NL})[1:20], {NL}) || case when len(string_split(content, {NL})) > 20 then {NL} else '' end || {NL}"""

_ROUTED = """, routed as (select *, lower(regexp_extract(file_path, '[^/](\\.[^./]+)$', 1)) as ext,
  case doc_id % 9 when 0 then 'markdown' when 2 then 'markdown' when 1 then 'code' when 5 then 'code' when 3 then 'json'
    when 4 then 'table' when 6 then 'yaml' else 'sentence' end as route,
  case doc_id % 9 when 1 then 'python' when 5 then 'javascript' else '' end as language,
  case when doc_id % 9 = 8 then case when doc_id % 2 = 0 then 'python' else 'bash' end else
    ltrim(lower(regexp_extract(file_path, '[^/](\\.[^./]+)$', 1)), '.') end as file_type from files)"""


def _spans(source):
    """Line spans of source(doc_id, chunk_index, content) in files."""
    return f"""sp_lines as (select doc_id, list_transform(string_split(content, {NL}), lambda x: {_strip('x')}) as l from files),
sp_heads as (select c.*, l, {_strip('c.content')} as clean, {_strip(f"string_split({_strip('c.content')}, {NL})[1]")} as head from {source} c join sp_lines using (doc_id)),
sp_found as (select *, coalesce(list_position(list_transform(l, lambda x: contains(x, head) or contains(head, x)), true), 0) as near,
  coalesce(list_position(list_transform(l, lambda x: length(x) > 10 and contains(content, x)), true), 0) as far from sp_heads),
spans as (select * exclude (l, clean, head, near, far), (case when near > 0 then near when far > 0 then far else 1 end)::int as line_start,
  (case when near > 0 then near + len(string_split(clean, {NL})) - 1 when far > 0 then far + len(string_split(content, {NL})) - 1 else 1 end)::int as line_end
  from sp_found)"""


ALL_CHUNKS = cte("files") + _ROUTED + ",\n" + ",\n".join([
    "src_code as (select doc_id, content from routed where route = 'code')", sql_code("src_code"),
    "src_md as (select doc_id, content from routed where route = 'markdown')", sql_markdown("src_md"),
    "src_json as (select doc_id, content from routed where route = 'json')", sql_json("src_json"),
    "src_yaml as (select doc_id, content from routed where route = 'yaml')", sql_yaml("src_yaml"),
    "src_st as (select doc_id, content from routed where route = 'sentence')", sql_sentences("src_st"),
    f"src_table as (select doc_id, {_PREVIEW} as content from routed where route = 'table')", sql_rechunk("src_table", K.MAX_TOKENS),
    "every_chunk as (" + " union all ".join(f"select * from {n}" for n in (
        "code_chunks", "markdown_chunks", "json_chunks", "yaml_chunks", "sentence_chunks", "rechunked")) + ")",
    _spans("every_chunk"),
    f"""chunks as (select r.repo_name, r.file_path, r.doc_id, r.file_type, r.language, r.route, s.chunk_index, s.content, line_start, line_end,
  {_WORDS.format('s.content')}::int as token_count from spans s join routed r using (doc_id))"""])

_SUMMARY_KIND = "case doc_id % 6 " + " ".join(
    f"when {i} then '{k}'" for i, k in enumerate(K.SUMMARY_PREVIEW_TYPES)) + " else 'bin' end"


def _kind():
    def any_of(words):
        return "(" + " or ".join(f"contains(lower(content), '{w}')" for w in words) + ")"
    return ("case when language <> '' then case " + " ".join(
        f"when {any_of(words)} then '{k}'" for k, words in K.CHUNK_WORDS.items())
        + f" else 'code' end when {_strip('content')} like '#%' then 'header' when contains(content, '```') then 'code_block' else 'text' end")


_DOCS = "with recursive src as (select doc_id, text as content from documents),\n"
_FILES = cte("files") + ",\nsrc as (select doc_id, content from files),\n"

ORACLES = {
    "chunk_code": _FILES + sql_code("src") + " select * from code_chunks",
    "chunk_markdown": _FILES + sql_markdown("src") + " select * from markdown_chunks",
    "chunk_json": cte("files") + ", src as (select doc_id, content from files where json_valid(content)), " + sql_json("src") + " select * from json_chunks",
    "chunk_yaml": f"""with docs as (select doc_id, array_to_string(list_transform(string_split(text, {NL}),
  lambda x, i: case when (i - 1) % 3 = 1 then 'key: ' || x else '  ' || x end), {NL}) as content from documents),
src as (select * from docs where contains(content, {NL})), """ + sql_yaml("src") + " select * from yaml_chunks",
    "chunk_sentences": _DOCS + sql_sentences("src") + " select * from sentence_chunks",
    "chunk_table_preview": cte("files") + f", src as (select doc_id, {_PREVIEW} as content from files), " + sql_rechunk("src", K.MAX_TOKENS)
                           + " select * from rechunked",
    "chunk_summary": cte("files") + f""", t as (select *, {_SUMMARY_KIND} as kind, strlen(content) * 777 / 1048576.0e0 as mb from files)
select doc_id, 0 as chunk_index, {_strip(f'''upper(kind) || ' file: ' || string_split(file_path, '/')[-1] || {NL} || 'Path: ' || file_path || {NL}
  || 'Size: ' || printf('%.2f', mb) || ' MB' || {NL} || 'Type: ' || kind || {NL}
  || case when mb < 1 and kind <> 'bin' then {NL} || 'Preview:' || {NL} || left(content, 500) || '...' else '' end''')} as content from t""",
    "rechunk_oversize": _DOCS + sql_rechunk("src", 60) + " select * from rechunked",
    "explode_chunks": f"""select doc_id, (i)::int as chunk_index, content from (select doc_id, unnest(range(len(l))) as i, unnest(l) as content from
  (select doc_id, string_split(text, {NL}) as l from documents)) where {_strip('content')} <> ''""",
    "classify_chunk_type": cte("files") + _ROUTED + f" select doc_id, {_kind()} as kind from routed",
    "line_range": _FILES + sql_code("src") + ", " + _spans("code_chunks")
                  + " select doc_id, chunk_index, 'L' || line_start || '-L' || line_end as line_range from spans",
    "count_tokens": r"select doc_id, len(regexp_extract_all(text, '\S+'))::int as tokens from documents",
    "chunk_detail": ALL_CHUNKS + f"""select repo_name, file_path, chunk_index, content, {_kind()} as type, line_start as start_line,
  line_end as end_line, language from chunks where doc_id % 11 <> 0
union all select repo_name, file_path, 0, 'Error reading ' || string_split(file_path, '/')[-1], 'error', 0, 0, '' from files where doc_id % 11 = 0""",
    "chunk_stats": ALL_CHUNKS + """select route, language, count(distinct file_path) as files, count(*) as chunks,
  sum(token_count)::bigint as tokens from chunks group by all""",
}
