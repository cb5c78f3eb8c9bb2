"""Restore: archives → checksum → upsert → activation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakesearch.operators.vectors import activate_commit, restore_vectors, verify_checksum
from lakesearch.session import staged
from lakesearch.sources.files import read_archive


def restore_archive(vectors: DataFrame, blobs: DataFrame, checksums: DataFrame, restored_at: str,
                    live: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(table, report) after restoring archive documents (path, content BINARY).

    A document whose checksum does not match is left out and reported. ``live`` (repo_name, commit_sha)
    names the commits to make live.
    """
    checked = staged(verify_checksum(blobs, checksums), "archives")
    archived = read_archive(checked.where("valid"))
    table, report = restore_vectors(vectors, archived, restored_at)
    rejected = checked.where(~F.col("valid")).select("path", F.lit("checksum mismatch").alias("error"))
    if live is not None:
        table, activation = activate_commit(table, live)
        report = report.join(activation, "repo_name", "left")
    return table, report.unionByName(rejected, allowMissingColumns=True)
