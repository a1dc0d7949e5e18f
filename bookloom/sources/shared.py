"""Tables written into the folder that all executors share, and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``; where that is unset a local master gets a temporary one.

    A cluster has no folder that every machine sees, so there it is an error.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='bookloom-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame, partition: str | None = None) -> DataFrame:
    """``df`` written once and read back: what follows neither plans nor computes it again, and a lost executor costs its tasks only."""
    path = folder(df.sparkSession)
    (df.write.partitionBy(partition) if partition else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
