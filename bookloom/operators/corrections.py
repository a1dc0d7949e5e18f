"""Corrections to a catalogue from a second source."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def override(rows: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``columns`` taken from ``source`` where it has the key and a value; other columns are untouched."""
    given = source.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in columns])
    out = rows.join(given, F.col(key) == F.col("_key"), "left")
    return out.select(*[F.coalesce(f"_{c}", c).alias(c) if c in columns else c for c in rows.columns])


def append_missing(rows: DataFrame, more: DataFrame, key: list[str]) -> DataFrame:
    """Rows and those of ``more`` whose key they lack; of rows with one key one stays."""
    return rows.unionByName(more.join(rows.select(*key), key, "left_anti")).dropDuplicates(key)
