"""Vector arithmetic on ARRAY<FLOAT> columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lakesearch.functions.text import let

# Ranking looks at twelve digits, below which only the order of sums tells scores apart;
# results show six.
SCORE_DIGITS, SHOWN_DIGITS = 12, 6


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0),
                              lambda total, x: total + x.cast("double") * x.cast("double")))


def cosine(left: Column, right: Column) -> Column:
    """Cosine similarity in double precision; null when a vector is all zeros or empty."""
    return let(norm(left) * norm(right),
               lambda length: F.when(length > 0, dot(left, right) / length))


def cosine_score(left: Column, right: Column) -> Column:
    """Cosine as it is ranked by: equal vectors tie."""
    return F.round(cosine(left, right), SCORE_DIGITS)
