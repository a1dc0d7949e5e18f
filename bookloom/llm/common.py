"""What the corpus operators share: reading tables, and cutting lineage in the shared folder."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus. Python workers get rows in batches of about 4 MB, unless the session asks for less.

    Texts are long and a batch is held several times over (as Arrow, as objects, as a result), so Spark's own
    64 MB would be most of a worker's memory.
    """
    limit_batches(spark, 4 << 20)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def limit_batches(spark: SparkSession, most: int) -> None:
    """Python workers get rows in batches of at most ``most`` bytes from now on."""
    if int(spark.conf.get(BATCH).rstrip("bB")) > most:
        spark.conf.set(BATCH, str(most))


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share (``spark.checkpoint.dir``).

    Where it is unset a local master gets a temporary one; a cluster has no folder that every machine sees,
    so there it is an error.
    """
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.checkpoint.dir", "")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = f"file://{tempfile.mkdtemp(prefix='bookloom-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


#: Paths of tables that a surrounding ``temporaries`` takes away.
_held: list[list[str]] = []


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: later jobs survive a lost executor."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _held:
        _held[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame, collect: bool = True) -> None:
    """Takes materialised tables away that nothing will read again, and lets the driver find what else is finished."""
    for x in tables:
        _delete(x.sparkSession, x.written_to)
    if collect:
        release(tables[0].sparkSession)


@contextmanager
def temporaries(spark: SparkSession) -> Iterator[None]:
    """Tables materialised inside are taken away at the end; what is kept of them has to be written elsewhere before."""
    _held.append([])
    try:
        yield
    finally:
        for path in _held.pop():
            _delete(spark, path)
        release(spark)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Lets the driver find which shuffles are finished.

    Spark deletes the files of a shuffle once the driver's JVM has collected the plan that made it, which may
    not happen for half an hour; a job of many steps would hold the files of all of them.
    """
    gc.collect()
    spark._jvm.System.gc()


def trim() -> None:
    """Gives the memory that a worker's task has freed back to the system (where its C library can), since the worker lives on and waits for its next task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def trimmed(run: Callable) -> Callable:
    """A map over batches that trims its worker's memory when it ends."""

    @functools.wraps(run)
    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            trim()

    return whole


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def drop_ids(df: DataFrame, ids: DataFrame, key: str = "doc_id", broadcast_rows: int = 250_000) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``ids``; null equals null, extra columns of any name stay.

    The ids are counted first: up to ``broadcast_rows`` (some 30 bytes each in a hash table, so 8 MB) they are
    broadcast, beyond that both sides are shuffled.
    """
    own = free_name(df, "dropped")
    ids = materialise(ids.select(F.col(key).alias(own)).distinct(), "ids")
    small = ids.count() <= broadcast_rows
    return df.join(F.broadcast(ids) if small else ids, df[key].eqNullSafe(ids[own]), "left_anti")
