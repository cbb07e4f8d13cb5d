"""Tables that a job reads more than once: written in a folder that all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Only where that is unset (a local
    test session), one is made."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or _own.get(sc.applicationId)
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = _own[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="weftlink-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """df as a Parquet table in the shared folder: its lineage ends there, and a lost executor costs
    only a new read. The table goes when the session ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/weftlink-{uuid.uuid4().hex}/{name}"
    df.write.options(**options).parquet(path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at.getParent())
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def dropped(df: DataFrame) -> None:
    """Deletes a stored table that nothing reads any more."""
    sc = df.sparkSession.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at.getParent(), True)
