"""Session defaults and the scratch area shared by all executors."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "lakesearch", master: str | None = None,
                  **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Nothing here fixes a parallelism: AQE sizes the shuffles, and a cluster's own
    ``spark-defaults`` stay in force for everything not named.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # Recording the Python call site of every expression doubles the time to build the
        # larger plans, which a stream pays in each micro-batch.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="lakesearch-")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared scratch folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a machine-local folder: on a cluster the
    executors would each see a different one.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        base = _local_scratch()
    return f"{base.rstrip('/')}/lakesearch/{name}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over all shuffle partitions, for costly work on the rows of a table that a few tasks read.

    A fixed number of parts, as adaptive execution would merge the parts of so few bytes.
    """
    return df.repartition(shuffle_partitions(df.sparkSession))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    For results that several later steps read and that are costly to repeat (model calls,
    text matching). The written table survives lost executors, cuts the lineage, and gives
    the optimizer its true size.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
