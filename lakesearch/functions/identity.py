"""Record ids and the hash embedding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lakesearch.functions.text import base_name, let


def hash_embedding(content: Column) -> Column:
    """Deterministic stand-in for a model: the 16 byte values of the content's MD5."""
    values = let(F.md5(content), lambda digest: F.transform(
        F.sequence(F.lit(1), F.lit(31), F.lit(2)),
        lambda i: F.conv(F.substring(digest, i, F.lit(2)), 16, 10).cast("float")))
    return F.when(content.isNotNull(), values)


def content_chunk_id(repo_name: Column, path: Column, content: Column) -> Column:
    return F.concat_ws("_", repo_name, base_name(path), F.left(F.md5(content), F.lit(16)))


def stable_record_id(repo_name: Column, path: Column, chunk_index: Column, content: Column) -> Column:
    """Depends on the record alone, so a retried task or a replayed batch gives the same id."""
    return F.sha2(F.concat_ws("\x01", repo_name, path, chunk_index.cast("string"), content), 256)
