"""Translations kept as documents of messages: dictionaries of names by language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bookloom.functions import text as tx


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """language, source, translation of every message of the documents under ``path``; of equal sources the first translation by name.

    Documents are cut at the messages' ends, so many tasks read one; its language stands in its head. Messages
    without a translation are left out.
    """
    cut = spark.read.text(path, lineSep="</message>", recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), "value")
    heads = cut.where(F.col("value").rlike(r"<TS\b")).select("path", F.regexp_extract("value", r'<TS\b[^>]*?\blanguage="([^"]*)"', 1).alias("language"))
    one = F.from_xml(F.concat(F.regexp_extract("value", r"(?s)(<message\b.*)", 1), F.lit("</message>")), "source string, translation string")
    said = cut.where(F.col("value").rlike(r"<message\b")).select("path", one.alias("m")).join(heads, "path")
    return said.where("m.translation <> ''").groupBy("language", F.col("m.source").alias("source")).agg(F.min("m.translation").alias("translation"))


def write_messages(rows: DataFrame, path: str) -> None:
    """``rows``: language, source, translation. A document for each language and task."""
    line = F.concat(F.lit("<message><source>"), _escaped("source"), F.lit("</source><translation>"), _escaped("translation"), F.lit("</translation></message>"))
    head = F.concat(F.lit('<TS version="2.1" language="'), "language", F.lit('">'))
    each = rows.groupBy("language").agg(F.array_sort(F.collect_list(line)).alias("lines"))  # a dictionary's few hundred messages
    each.select("language", F.concat_ws("\n", head, F.array_join("lines", "\n"), F.lit("</TS>")).alias("value")).write.partitionBy("language").text(path)


def _escaped(name: str) -> Column:
    out = F.col(name)
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(raw), F.lit(entity))
    return out


def localised(rows: DataFrame, column: str, messages: DataFrame, language: str, broadcast_rows: int = 100_000) -> DataFrame:
    """``column`` by a language's messages; what they do not know stays. They are broadcast up to ``broadcast_rows``."""
    own = messages.where(F.col("language") == language).select(F.col("source").alias("_source"), F.col("translation").alias("_translation"))
    small = own.limit(broadcast_rows + 1).count() <= broadcast_rows
    out = rows.join(F.broadcast(own) if small else own, F.col(column) == F.col("_source"), "left")
    return out.withColumn(column, F.coalesce("_translation", column)).drop("_source", "_translation")
