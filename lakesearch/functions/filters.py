"""Metadata filter trees compiled to plain predicates, which Catalyst can push down."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, StructType


def compile_filter(tree: dict[str, Any] | None, schema: StructType) -> Column:
    """``{"field": value, "field": {"$in" | "$regex" | "$lt" | "$gte": ...}, "$or": [...]}``.

    Several keys are AND-ed, an empty tree matches all, a missing field matches nothing.
    """
    parts = []
    for key, condition in (tree or {}).items():
        if key == "$or":
            parts.append(reduce(or_, [compile_filter(t, schema) for t in condition], F.lit(False)))
        elif key not in schema.fieldNames():
            parts.append(F.lit(False))
        elif isinstance(condition, dict):
            parts.extend(_compare(key, op, value, schema) for op, value in condition.items())
        else:
            parts.append(_compare(key, "$in", [condition], schema))
    # A null outcome counts as no match where the predicate is used; wrapping it here
    # would keep it from being pushed to the scan.
    return reduce(and_, parts) if parts else F.lit(True)


def _compare(field: str, op: str, value: Any, schema: StructType) -> Column:
    column = F.col(field)
    if op == "$in":
        if isinstance(schema[field].dataType, ArrayType):
            return F.arrays_overlap(column, F.array(*[F.lit(v) for v in value]))
        return column == value[0] if len(value) == 1 else column.isin(value)
    if op == "$regex":
        return column.rlike(value)
    if op == "$lt":
        return column < value
    if op == "$gte":
        return column >= value
    raise ValueError(f"unknown filter operator {op}")
