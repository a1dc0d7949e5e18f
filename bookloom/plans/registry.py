"""Where plans are registered: name -> plan, and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the catalogue. Python workers get rows in batches of about 4 MB, unless the session asks for less.

    A batch of books is held several times over (as Arrow, as objects, as a result), so with Spark's own 64 MB a worker
    would grow with the tasks' input.
    """
    if int(spark.conf.get(BATCH).rstrip("bB")) > 4 << 20:
        spark.conf.set(BATCH, str(4 << 20))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    """Register a plan under ``name`` with the SQL that gives the same rows."""

    def wrap(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return wrap
