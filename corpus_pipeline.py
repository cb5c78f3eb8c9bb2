"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but
the last return the columns of ``documents``. ``run`` applies them in order, writing each
result and reading it again.

Rows with null, empty or repeated values follow the operators' own rules: a document
without words fails the quality rules, rows without an id are linked with nothing, a source
without a name is a source of its own. Other columns of ``docs`` are passed on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakesearch.llm.bpe import digests, encode, multi_vocabulary
from lakesearch.llm.common import table
from lakesearch.llm.mixing import mixed_documents
from lakesearch.llm.near_dedup import near_components
from lakesearch.llm.quality import quality, trusted_ids
from lakesearch.llm.suffix_dedup import suffix_dedup
from lakesearch.session import staged

#: Least similarity of near-duplicates in the pipeline; the registered ``op3_setsketch`` is asked for 85.
NEAR_PERCENT = 80


def _with_row(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row): no column of ``docs`` can clash with those of an operator."""
    return docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not less likely under the trusted model."""
    return quality(_with_row(docs), trusted_ids(table(spark, sf_dir, "labels")), carry=("row",)).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near-duplicates: similarity ``NEAR_PERCENT`` or more on five-word shingles."""
    gone = near_components(docs, percent=NEAR_PERCENT).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings of documents of smaller id; characters cut in two go."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    narrow = docs.select("doc_id", "text", F.struct(*[F.col(c) for c in rest] or [F.lit(0).alias("none")]).alias("row"))
    found = suffix_dedup(narrow, carry=("row",), as_text=True).withColumnRenamed("kept", "text")
    found = found.select("doc_id", "text", *[F.col("row")[c].alias(c) for c in rest])
    if "n_chars" in rest:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids, joined by commas, the bytes they decode to, the number of ids and digests of both."""
    return digests(encode(docs, multi_vocabulary(), decoded=True), carry=("ids", "decoded"))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources to target weights", mixture),
    ("byte-level BPE encoding and decoding", token_ids),
]

#: Hashed n-grams and BPE merges have no SQL; tests/llm compares ``run`` with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
