"""Zip archives of books as rows: listing, entries, nested archives and book metadata."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def listed(files: DataFrame) -> DataFrame:
    """path, name, number of archives (path): the first number after ``fb2`` in the lower-cased name, 0 if there is none; of equal names the first path."""
    named = files.select("path", F.lower(F.regexp_extract("path", r"([^/]*)$", 1)).alias("name"))
    number = F.coalesce(F.regexp_extract("name", r"fb2.*?(\d+)", 1).try_cast("long"), F.lit(0))
    return named.groupBy("name").agg(F.min("path").alias("path")).select("path", "name", number.alias("number"))


def with_fingerprints(archives: DataFrame, files: DataFrame) -> DataFrame:
    """Adds hash: the file of fingerprints (path) that has the archive's name but for the suffix, null if none has."""
    stem = lambda c: F.regexp_replace(F.lower(F.regexp_extract(c, r"([^/]*)$", 1)), r"\.[^.]*$", "")
    known = files.groupBy(stem("path").alias("stem")).agg(F.min("path").alias("hash"))
    return archives.withColumn("stem", stem("name")).join(known, "stem", "left").drop("stem")


def listing(spark: SparkSession, path: str, pattern: str = "*.zip", hashes: str | None = None) -> DataFrame:
    """path, name, number, latest number first: archives by the first number after ``fb2`` in their name; of equal names (any case) one.

    With ``hashes``, a folder of fingerprints, also hash: the file of the archive's name there. An archive
    without one is an error, as is a path without archives.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path")
    if not files.limit(1).count():
        raise FileNotFoundError(f"no archives {pattern} under {path}")
    out = listed(files)
    if hashes is not None:
        out = with_fingerprints(out, spark.read.format("binaryFile").load(hashes).select("path"))
        lost = [r["name"] for r in out.where("hash is null").limit(5).collect()]
        if lost:
            raise FileNotFoundError(f"no fingerprints of {', '.join(lost)} under {hashes}")
    return out.orderBy(F.desc("number"), "name")


def totals(found: DataFrame) -> DataFrame:
    """archives, entries, bytes of ``entries``, the largest archive, and, where entries have a time, the latest."""
    time = F.max("time") if "time" in found.columns else F.lit(None)
    each = found.groupBy("archive").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("body")).alias("bytes"), time.alias("time"))
    latest = [F.max("time").alias("latest")] if "time" in found.columns else []
    return each.agg(F.count(F.lit(1)).alias("archives"), F.coalesce(F.sum("n"), F.lit(0)).alias("entries"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.max_by("archive", F.struct("n", "archive")).alias("largest"), *latest)


def entries(spark: SparkSession, path: str, pattern: str = "*.zip", nested: bool = True) -> DataFrame:
    """archive, entry, place, body of every file in the archives; with ``nested`` also of archives inside.

    Folders, ``__MACOSX`` and broken archives give no rows. An archive is one row of Spark's binary reader,
    so it must fit a task's memory.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")

    def inside(name: str, body: bytes):
        try:
            with zipfile.ZipFile(io.BytesIO(body)) as z:
                for place, x in enumerate(z.infolist()):
                    if x.is_dir() or x.filename.startswith("__MACOSX"):
                        continue
                    data = z.read(x)
                    if nested and x.filename.lower().endswith(".zip"):
                        yield from inside(f"{name}/{x.filename}", data)
                    else:
                        yield name, x.filename, place, data
        except zipfile.BadZipFile:
            return

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, body in zip(batch["path"], batch["content"]):
                rows = list(inside(name, bytes(body)))
                if rows:
                    yield pd.DataFrame(rows, columns=["archive", "entry", "place", "body"])

    return files.mapInPandas(run, "archive string, entry string, place int, body binary")


def book_metadata(df: DataFrame, body: str = "body") -> DataFrame:
    """Adds title, lang, authors, genres, error from a book's XML; null fields where it cannot be read."""

    @F.pandas_udf("title string, lang string, authors array<string>, genres array<string>, error string")
    def parse(bodies: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_described(bytes(b) if b is not None else b"") for b in bodies], columns=["title", "lang", "authors", "genres", "error"])

    return df.withColumn("_m", parse(F.col(body))).select("*", "_m.*").drop("_m")


def _described(body: bytes) -> tuple:
    try:
        root = ElementTree.fromstring(body)
    except ElementTree.ParseError as e:
        return None, None, None, None, str(e)
    local = lambda x: x.tag.rsplit("}", 1)[-1]
    info = next((x for x in root.iter() if local(x) == "title-info"), None)
    if info is None:
        return None, None, None, None, "no title-info"
    text = lambda x: " ".join("".join(x.itertext()).split())
    pick = lambda name: [x for x in info if local(x) == name]
    author = lambda a: ",".join(next((text(y) for y in a if local(y) == part), "") for part in ("last-name", "first-name", "middle-name"))
    first = lambda name: next((text(x) for x in pick(name)), None)
    return first("book-title"), first("lang"), [author(a) for a in pick("author")], [text(g) for g in pick("genre")], None
