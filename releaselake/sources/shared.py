"""Tables in the folder that driver and executors share: spark.checkpoint.dir, or a temporary one only in a local session that leaves that unset, as in tests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/releaselake/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write as a Parquet table and read it back: what several branches of a plan read is computed once, and lineage is cut."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over all cores where they come in fewer splits than there are cores, as those of a small file in one row group do; other inputs are left as they are.

    So a shuffle is paid only by inputs of few splits, and what is written of them can be read in parallel. ``df`` should be a scan without
    shuffles, which would be run to count its splits."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _there(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, in order; nothing if there is no such folder."""
    at, store = _there(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(at)) if store.exists(at) else []


def finished(spark: SparkSession, path: str) -> bool:
    """Whether the writing of a table ended."""
    at, store = _there(spark, f"{path}/_SUCCESS")
    return store.exists(at)
