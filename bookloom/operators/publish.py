"""Operators that publish a catalogue: index lines, contents, reviews, author packs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from bookloom.functions import text as tx
from bookloom.sources.shared import stored

#: The fields of an index line, in order, and the character after each.
FIELDS = ("author", "genre", "title", "series", "serno", "file", "size", "libid", "del", "ext", "date", "insno", "lang", "librate", "keywords", "year", "sourcelib")
SEPARATOR = "\u0004"


def index_line(*fields: Column) -> Column:
    """One catalogue line: every field and the separator after it, line feeds as spaces, ended by CR LF."""
    clean = [F.replace(F.replace(F.coalesce(f.cast("string"), F.lit("")), F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit("")) for f in fields]
    return F.concat(F.array_join(F.array(*clean), SEPARATOR), F.lit(f"{SEPARATOR}\r\n"))


def index_fields(line: Column) -> list[Column]:
    """The fields of a line again, empty ones as null."""
    parts = F.split(F.regexp_replace(line, f"{SEPARATOR}?\r?\n?$", ""), SEPARATOR)
    return [F.nullif(F.get(parts, F.lit(i)), F.lit("")).alias(name) for i, name in enumerate(FIELDS)]


def series_of_book(rows: DataFrame, key: str, most: int | None) -> DataFrame:
    """key, series: array of (title, number, level) published for each book.

    Titles are folded; of equal titles the one of smallest type, then largest level stays; the blank title
    goes if there is another; order is by level, then title; the first ``most`` are kept, one blank series if that
    is 0 or less.
    """
    named = rows.withColumn("title", tx.dash_fold(F.coalesce("title", F.lit(""))))
    first = Window.partitionBy(key, "title").orderBy("type", F.desc("level"), "number")
    one = named.withColumn("at", F.row_number().over(first)).where("at = 1")
    entry = F.struct("level", "title", "number")
    out = one.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("s"))
    named_only = F.filter("s", lambda x: x["title"] != "")
    kept = F.when(F.size(named_only) > 0, named_only).otherwise(F.col("s"))
    blank = F.transform(F.slice("s", 1, 1), lambda x: F.struct(F.lit(None).cast("double").alias("level"), F.lit("").alias("title"), F.lit(None).cast("long").alias("number")))
    if most is not None and most <= 0:
        return out.select(key, blank.alias("series"))
    return out.select(key, (kept if most is None else F.slice(kept, 1, most)).alias("series"))


def contents(rows: DataFrame, group: str, keys: list[Column], line: Column, name: str = "line") -> DataFrame:
    """group, place, line: lines numbered within their group in the order of ``keys``.

    Rows are dealt by ranges of group and keys and sorted inside a range; a row's place is its place there and
    the number of its group's rows in the ranges before. So one group may hold most of the rows.
    """
    names = [f"_key{i}" for i in range(len(keys))]
    keyed = rows.withColumns(dict(zip(["_group", *names], [F.col(group), *keys])))
    # lines are made behind the exchange: the ranges are drawn from a run of what stands before it
    spread = keyed.repartitionByRange("_group", *names).withColumn("part", F.spark_partition_id())
    dealt = stored(spread.select(F.col("_group").alias("group"), *names, line.alias("line"), "part"))
    sizes = dealt.groupBy("group", "part").agg(F.count(F.lit(1)).alias("n"))  # a row per group and range
    before = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("group").alias("of"), F.col("part").alias("in"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    own = F.row_number().over(Window.partitionBy("group", "part").orderBy(*names))
    placed = dealt.withColumn("own", own).join(offsets, F.col("group").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in")))
    return placed.select(F.col("group").alias(group), (F.col("own") + F.col("offset")).alias("place"), F.col("line").alias(name))


def contents_line(author: Column, title: Column, series: Column, number: Column, folder: Column, file: Column) -> Column:
    """Author, title, ``[series #number]`` (nothing without a series), folder and file between tabs; nulls are empty."""
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    shown = F.when(blank(series) == "", "").otherwise(F.concat(F.lit("["), series, F.when(blank(number) == "", "").otherwise(F.concat(F.lit(" #"), blank(number))), F.lit("]")))
    return F.concat_ws("\t", blank(author), blank(title), shown, blank(folder), blank(file))


def contents_keys(author: Column, series: Column, number: Column, title: Column) -> list[Column]:
    """What contents are sorted by: author, series, number and title, the missing ones last."""
    return [tx.sort_text(author), tx.sort_text(series), tx.sort_number(number.cast("string")), tx.sort_text(title)]


def months(times: DataFrame, column: str) -> DataFrame:
    return times.select(F.year(column).alias("year"), F.month(column).alias("month")).distinct()


def month_reviews(reviews: DataFrame, start: str, book: list[str], text: str = "text") -> DataFrame:
    """Reviews of the month that begins at ``start``, one row per book, as JSON in the order of time and name.

    The month is half open. Of reviews by one name at one time the smallest text stays.
    """
    begin = F.lit(start).cast("timestamp_ntz")
    inside = reviews.where((F.col("time") >= begin) & (F.col("time") < F.add_months(begin, 1).cast("timestamp_ntz")))
    first = inside.groupBy(*book, "time", "name").agg(F.min(text).alias("text"))
    entry = F.struct(F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"), "name", "text")
    return first.groupBy(*book).agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("reviews"))


def author_packs(notes: DataFrame, size: int = 10_000) -> DataFrame:
    """bucket, author_key, body (of the smallest note), files (sorted): notes by id range and author's key.

    ``notes``: nid, name, body, file.
    """
    return notes.groupBy(F.expr(f"nid div {size}").alias("bucket"), tx.author_key(F.col("name")).alias("author_key")).agg(F.min_by("body", "nid").alias("body"), F.array_join(F.array_sort(F.collect_set("file")), "|").alias("files"))


def route_reviews(reviews: DataFrame, origins: DataFrame, published: DataFrame) -> DataFrame:
    """Reviews moved to the last origin of their book, those of unpublished books dropped.

    ``reviews``: book_id, ...; ``origins``: dup, root; ``published``: book_id.
    """
    moved = reviews.join(origins, F.col("book_id") == F.col("dup"), "left").withColumn("book_id", F.coalesce("root", "book_id")).drop("dup", "root")
    return moved.join(published.select("book_id").distinct(), "book_id", "left_semi")
