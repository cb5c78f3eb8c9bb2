"""File typing queries, over every derived file plus variants of its path."""

from pyspark.sql import functions as F

from lakesearch.functions.file_types import (CODE_LANGUAGES, INDEX_LANGUAGES, JSON_EXTENSIONS, MARKDOWN_EXTENSIONS,
                                             TABLE_EXTENSIONS, YAML_EXTENSIONS)
from lakesearch.operators import file_types as T
from lakesearch.registry.fixtures import cte, fixture

# Path endings that exercise the suffix rule.
_ENDINGS = ["", ".TAR.gz", ".", "/.bashrc", "/run.sh", "/a.Kts", "/page.html", "/x.toml", "/n.ipynb"]


def _files(spark, sf):
    ending = F.element_at(F.array(*[F.lit(e) for e in _ENDINGS]), (F.pmod(F.col("doc_id"), F.lit(13)) + 1).cast("int"))
    return fixture(spark, sf, "files").withColumn(
        "file_path", F.when(F.pmod(F.col("doc_id"), F.lit(13)) < len(_ENDINGS), F.concat("file_path", ending))
        .otherwise(F.col("file_path")))


def detect_file_type(spark, sf):
    return T.detect_file_type(_files(spark, sf)).select("doc_id", "file_path", "file_type")


def detect_code_language(spark, sf):
    return T.detect_code_language(_files(spark, sf)).select("doc_id", "file_path", "language")


def detect_index_language(spark, sf):
    return T.detect_index_language(_files(spark, sf)).select("doc_id", "file_path", "index_language")


def route_chunker(spark, sf):
    return T.route_chunker(_files(spark, sf)).select("doc_id", "file_path", "route")


QUERIES = {f.__name__: f for f in (detect_file_type, detect_code_language, detect_index_language, route_chunker)}

_SQL_FILES = cte("files") + ", typed as (select doc_id, content, file_path || (case doc_id % 13 " + " ".join(
    f"when {i} then '{e}'" for i, e in enumerate(_ENDINGS)) + r""" else '' end) as file_path from files),
e as (select *, lower(regexp_extract(file_path, '[^/](\.[^./]+)$', 1)) as ext, trim(string_split(content, chr(10))[1]) as first from typed)
"""


def _in(values):
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _case(mapping, default):
    return "case ext " + " ".join(f"when '{k}' then '{v}'" for k, v in mapping.items()) + f" else '{default}' end"


ORACLES = {
    "detect_file_type": _SQL_FILES + """select doc_id, file_path, case
  when ext in ('', '.sh') and first like '#!%' and first like '%python%' then 'python'
  when ext in ('', '.sh') and first like '#!%' and first like '%sh%' then 'bash'
  else ltrim(ext, '.') end as file_type from e""",
    "detect_code_language": _SQL_FILES + f"select doc_id, file_path, {_case(CODE_LANGUAGES, '')} as language from e",
    "detect_index_language": _SQL_FILES + f"select doc_id, file_path, {_case(INDEX_LANGUAGES, 'unknown')} as index_language from e",
    "route_chunker": _SQL_FILES + f"""select doc_id, file_path, case when ext in {_in(TABLE_EXTENSIONS)} then 'table'
  when ext in {_in(CODE_LANGUAGES)} then 'code' when ext in {_in(MARKDOWN_EXTENSIONS)} then 'markdown'
  when ext in {_in(JSON_EXTENSIONS)} then 'json' when ext in {_in(YAML_EXTENSIONS)} then 'yaml' else 'sentence' end as route from e""",
}
