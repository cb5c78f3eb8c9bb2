"""Row numbers over groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lakesearch.session import staged


def numbered(rows: DataFrame, keys: list[str], order: list[str], name: str = "position") -> DataFrame:
    """Add the 0-based position of each row within ``keys`` by ``order``.

    A plain ``row_number`` sorts a whole group in one task. Here the rows are range
    partitioned by (keys, order), written once with their range, numbered inside each
    range, and shifted by the sizes of the ranges before; only those sizes are ranked per
    group. Pass narrow rows: the ranges are written.
    """
    ranged = staged(rows.repartitionByRange(*[F.col(c) for c in keys + order])
                    .withColumn("range_id", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy(*keys, "range_id").orderBy(*order)
    before = Window.partitionBy(*keys).orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (ranged.groupBy(*keys, "range_id").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    return (ranged.withColumn("local", F.row_number().over(inside))
            .join(shifts, keys + ["range_id"])
            .withColumn(name, F.col("shift") + F.col("local") - 1).drop("shift", "local", "range_id"))
