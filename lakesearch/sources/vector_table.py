"""The vector table on disk: versions of Parquet files, partitioned by namespace and bucket.

Every write makes a new version. New rows go to files of their own below ``data/v=<N>-<attempt>``;
the manifest of version N (a small Parquet table below ``_manifests``) lists the files
of every (namespace, bucket) partition with their rows: the new files for the partitions the
write touched, the old files for all others. The version becomes current by one rename of
its commit file, ``_commits/N.json``, which holds the schema, the manifest's place and the
last batch id applied of each stream. A reader takes the highest commit, so a reader during
a write, or a write lost half-way, sees the previous version whole; nothing is overwritten
in place. A push touches few files, so only the buckets of those files are written again,
however large their namespace is.

Readers never list the data folders: the schema comes from the commit, and the files of the
namespaces asked for from the manifest.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

BUCKETS = 64
FILE_RECORDS = 500_000
DATA, MANIFESTS, COMMITS = "data", "_manifests", "_commits"
_KINDS = {"namespace": T.StringType(), "bucket": T.IntegerType()}


def with_bucket(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64("file_path"), F.lit(buckets)).cast("int"))


def _fs(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def current_commit(spark: SparkSession, path: str) -> dict | None:
    """The commit of the current version, or None for no table."""
    fs, folder = _fs(spark, f"{path}/{COMMITS}")
    if not fs.exists(folder):
        return None
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    versions = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
    if not versions:
        return None
    stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{COMMITS}/{max(versions)}.json"))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _publish(spark: SparkSession, path: str, commit: dict) -> None:
    """Make ``commit`` current: written under a temporary name, then renamed once."""
    jvm = spark._jvm
    fs, _ = _fs(spark, path)
    final = jvm.org.apache.hadoop.fs.Path(f"{path}/{COMMITS}/{commit['version']}.json")
    temporary = jvm.org.apache.hadoop.fs.Path(f"{path}/{COMMITS}/.{commit['version']}.json.tmp")
    out = fs.create(temporary, True)
    try:
        out.write(bytearray(json.dumps(commit).encode()))
    finally:
        out.close()
    if fs.exists(final) or not fs.rename(temporary, final):
        fs.delete(temporary, False)
        raise RuntimeError(f"version {commit['version']} of {path} was committed by another writer")


def manifest(spark: SparkSession, path: str, commit: dict | None = None) -> DataFrame:
    """(namespace, bucket, file, rows) of the current version; ``file`` as a URI, percent-encoded."""
    commit = commit or current_commit(spark, path)
    schema = "namespace string, bucket int, file string, rows long"
    if commit is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{commit['manifest']}")


def write_vectors(rows: DataFrame, path: str, buckets: int = BUCKETS, streams: dict[str, int] | None = None,
                  before_commit=None) -> int:
    """Write a new version in which the (namespace, bucket) partitions of ``rows`` are
    replaced by them; other partitions stay. Returns the version.

    A row without an id only marks its partition as emptied. ``streams`` are batch ids
    recorded in the same commit. ``before_commit`` is called after all files are written
    and before the commit (tests stop a write there).
    """
    spark = rows.sparkSession
    head = current_commit(spark, path)
    version = (head["version"] if head else 0) + 1
    placed = rows if "bucket" in rows.columns else with_bucket(rows, buckets)
    placed = placed.select(*[F.col(c).cast(_KINDS[c]) if c in _KINDS else F.col(c) for c in placed.columns])
    # A write lost before its commit leaves files no manifest names; the next one writes elsewhere.
    attempt = f"{version}-{uuid.uuid4().hex[:12]}"
    data = f"{path}/{DATA}/v={attempt}"
    # Rebalanced by partition, so that a bucket of a large namespace is written by several tasks.
    (placed.where("id is not null").hint("rebalance", F.col("namespace"), F.col("bucket"))
     .write.mode("errorifexists").option("maxRecordsPerFile", FILE_RECORDS).partitionBy("namespace", "bucket").parquet(data))
    stored_schema = T.StructType([f for f in placed.schema.fields if f.name not in _KINDS]
                                 + [T.StructField("v", T.StringType())]
                                 + [T.StructField(n, k) for n, k in _KINDS.items()])
    written = (spark.read.schema(stored_schema).option("basePath", f"{path}/{DATA}").parquet(data)
               .groupBy("namespace", "bucket", F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("rows")))
    if head:  # a new table keeps nothing, so its rows need not be made again to see what they touch
        touched = placed.select("namespace", "bucket").distinct()
        written = manifest(spark, path, head).join(touched, ["namespace", "bucket"], "left_anti").unionByName(written)
    written.write.parquet(f"{path}/{MANIFESTS}/v={attempt}")
    if before_commit:
        before_commit()
    streams_now = {**(head or {}).get("streams", {}), **(streams or {})}
    _publish(spark, path, {"version": version, "schema": placed.schema.json(), "manifest": f"{MANIFESTS}/v={attempt}",
                           "streams": streams_now})
    return version


def has_table(spark: SparkSession, path: str) -> bool:
    return current_commit(spark, path) is not None


def only_partitions(vectors: DataFrame, touched: DataFrame, most: int = 4096) -> DataFrame:
    """Rows of the (namespace, bucket) pairs ``touched``. Up to ``most`` different names and buckets also
    stand in the filter as literals, which keeps the other partitions from being listed and read."""
    for name in ("namespace", "bucket"):
        values = [r[0] for r in touched.select(name).distinct().limit(most + 1).collect()]
        if len(values) <= most:
            vectors = vectors.where(F.col(name).isin(values))
    return vectors.join(touched, ["namespace", "bucket"], "left_semi")


def _read_files(spark: SparkSession, path: str, commit: dict, files: list[str]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(commit["schema"]))
    schema = T.StructType([T.StructField(f.name, _KINDS.get(f.name, f.dataType)) for f in schema.fields])
    if not files:
        return spark.createDataFrame([], schema)
    stored = T.StructType([f for f in schema.fields if f.name not in _KINDS] + [T.StructField("v", T.StringType())]
                          + [T.StructField(n, k) for n, k in _KINDS.items()])
    rows = spark.read.schema(stored).option("basePath", f"{path}/{DATA}").parquet(*files)
    return rows.select(*schema.names)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the current version: the files its manifest lists, nothing listed."""
    commit = current_commit(spark, path)
    if commit is None:
        raise FileNotFoundError(f"no vector table at {path}")
    files = [unquote(r.file) for r in manifest(spark, path, commit).select("file").collect()]
    return _read_files(spark, path, commit, files)


def read_vectors_pruned(spark: SparkSession, path: str, namespaces: list[str]) -> DataFrame:
    """Metadata of the given namespaces: only their files, taken from the manifest, are read,
    and the vectors are not."""
    commit = current_commit(spark, path)
    if commit is None:
        raise FileNotFoundError(f"no vector table at {path}")
    files = [unquote(r.file) for r in manifest(spark, path, commit).where(F.col("namespace").isin(namespaces)).select("file").collect()]
    return _read_files(spark, path, commit, files).drop("embedding", "bucket")
