"""De-duplication and month counts as batches arrive."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F


def new_only(batch: DataFrame, store: DataFrame | None, digest: str, key: str) -> DataFrame:
    """Of a batch the first row (smallest key) of every content that the store lacks."""
    first = batch.groupBy(digest).agg(F.min(key).alias(key)).select(key, digest)
    return first if store is None else first.join(store.select(digest), digest, "left_anti").select(key, digest)


def in_batches(rows: DataFrame, digest: str, key: str, batches: int) -> DataFrame:
    """The store after all batches, cut by ranges of the key; equal to keeping the smallest key of each content."""
    top = rows.agg(F.max(key).alias("m")).first()["m"] or 0
    store: list[DataFrame] = []
    for i in range(batches):
        part = rows.where((F.col(key) * batches >= i * (top + 1)) & (F.col(key) * batches < (i + 1) * (top + 1)))
        store.append(new_only(part, reduce(DataFrame.unionByName, store) if store else None, digest, key))
    return reduce(DataFrame.unionByName, store)


def stream_store(spark: SparkSession, source: DataFrame, store: str, checkpoint: str, digest: str, key: str):
    """Starts a stream that appends unseen contents to the Parquet ``store``, batch by batch.

    A batch that is run again after a failure finds what it wrote in the store and adds nothing twice.
    """

    def add(batch: DataFrame, _: int) -> None:
        try:
            known = spark.read.parquet(store)
        except Exception as e:  # the first batch finds no store
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            known = None
        new_only(batch, known, digest, key).write.mode("append").parquet(store)

    return source.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def unready(source: DataFrame, ready: DataFrame, name: str = "name") -> DataFrame:
    """Names of a stream that are not in the (static) list of what is ready, each once.

    The stream's state holds the names seen since it began, so the list carried from run to run is the
    checkpoint; with a watermark on the source it is bounded by that.
    """
    return source.join(ready.select(name).distinct(), name, "left_anti").dropDuplicates([name])


def month_counts(rows: DataFrame, time: str, kind: str, value: str) -> DataFrame:
    """month, kind, n and cents; the same plan serves a stream under a watermark."""
    return rows.groupBy(F.date_trunc("month", time).alias("month"), kind).agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col(value) * 100)).alias("cents"))
