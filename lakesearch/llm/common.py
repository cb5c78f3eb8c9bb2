"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakesearch.session import staged

#: A word: a run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) alone, so that no other column can clash with an operator's own."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def count_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts: one column, one sum."""
    return docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0


def chunked(docs: DataFrame, n_bytes: int, chunk_bytes: int) -> tuple[DataFrame, int]:
    """Add ``chunk``, a hash of the id: groups of about ``chunk_bytes`` of text each.

    A chunk is the unit that Python sees at once, so its size does not depend on the size
    of the input; the number of chunks does. Rows without an id are spread by their text.
    """
    n = max(1, -(-n_bytes // chunk_bytes))
    spread = F.xxhash64(F.coalesce(F.col("doc_id"), F.xxhash64("text")))
    return docs.withColumn("chunk", F.pmod(spread, F.lit(n)).cast("int")), n


def running_sum(rows: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows before, within ``keys`` by ``order``.

    A window over a hot key would sort it in one task. Here rows are range partitioned by
    (keys, order) and written with their range; sums run inside each range and are shifted
    by the totals of the ranges before, of which there are only as many as partitions.
    """
    ranged = staged(rows.repartitionByRange(*[F.col(c) for c in keys + order])
                    .withColumn("range_id", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy(*keys, "range_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*keys).orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (ranged.groupBy(*keys, "range_id").agg(F.sum(value).alias("in_range"))
              .withColumn("shift", F.coalesce(F.sum("in_range").over(before), F.lit(0))).drop("in_range"))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in [*keys, "range_id"]]
    on = same[0]
    for more in same[1:]:
        on = on & more
    summed = ranged.withColumn("running", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (summed.alias("r").join(shifts.alias("s"), on)
            .select("r.*", (F.col("s.shift") + F.col("r.running")).alias(name)).drop("running", "range_id"))


Query = Callable[[SparkSession, str], DataFrame]
