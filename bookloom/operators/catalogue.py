"""Operators that put a catalogue together from normalised tables.

Every many-valued part (authors, genres, ratings) is aggregated to one row per book before it is joined,
so no join multiplies rows but the last one, over series, which is meant to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_ratings(books: DataFrame, rates: DataFrame) -> DataFrame:
    """Adds rate_sum (null without ratings) and rate_count; ``rates``: book_id, rate as text or number."""
    sums = rates.groupBy("book_id").agg(F.sum(F.col("rate").try_cast("double")).alias("rate_sum"), F.count("rate").alias("rate_count"))
    return books.join(sums, "book_id", "left").withColumn("rate_count", F.coalesce("rate_count", F.lit(0)))


def lib_rate(total: str, count: str) -> Column:
    """The rounded mean, null unless it lies between 1 and 5."""
    mean = F.round(F.col(total) / F.nullif(F.col(count), F.lit(0)))
    return F.when(mean.between(1, 5), mean.cast("long"))


def joined_list(links: DataFrame, label: str, pos: str, name: str, separator: str = ":") -> DataFrame:
    """book_id and the labels joined in the order of ``pos``, with a separator at the end; null labels are skipped.

    A book whose labels are all null gets null, as one without links would.
    """
    given = links.where(F.col(label).isNotNull()).groupBy("book_id").agg(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("pos"), F.col(label).alias("label")))).alias("x"))
    return given.select("book_id", F.concat(F.array_join(F.col("x.label"), separator), F.lit(separator)).alias(name))


def author_lists(links: DataFrame, names: DataFrame, illustrator: str | None = None) -> DataFrame:
    """book_id, authors. ``links``: book_id, author_id, pos; ``names``: author_id, last, first, middle, nick, master_id.

    An author with a master row is shown under the master's name; a name with a null part is no label.
    Illustrators are left out unless a book has no other; a null nick name is treated like an illustrator's.
    """
    part = lambda p: F.concat(*[F.trim(F.col(f"{p}.{c}")) if c == "last" else F.concat(F.lit(","), F.trim(F.col(f"{p}.{c}"))) for c in ("last", "first", "middle")])
    own, master = names.alias("n"), names.select("author_id", "last", "first", "middle").alias("m")
    label = F.when(F.col("m.author_id").isNull(), part("n")).otherwise(part("m"))
    shown = own.join(master, F.col("n.master_id") == F.col("m.author_id"), "left").select(F.col("n.author_id").alias("author_id"), F.col("n.nick").alias("nick"), label.alias("label"))
    rows = links.join(shown, "author_id")
    if illustrator is None:
        return joined_list(rows, "label", "pos", "authors")
    # One aggregate per book: whether it has a writer is known only with all its names at hand.
    writes = F.coalesce(F.col("nick") != illustrator, F.lit(False))
    named = rows.groupBy("book_id").agg(F.array_sort(F.collect_list(F.struct("pos", writes.alias("writes"), "label"))).alias("x"), F.max(writes).alias("written"))
    kept = F.filter("x", lambda n: (n["writes"] | ~F.col("written")) & n["label"].isNotNull())
    return named.select("book_id", kept.alias("x")).where(F.size("x") > 0).select("book_id", F.concat(F.array_join(F.col("x.label"), ":"), F.lit(":")).alias("authors"))


def catalogue(books: DataFrame, rates: DataFrame, authors: DataFrame, genres: DataFrame, series: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """The catalogue row of every book and series: missing file types are fb2, year 0 is unknown.

    With ``files`` (book_id, file_name) also of every explicit file name, null where a book has none.
    """
    base = books.select(
        "book_id", F.trim("title").alias("title"), "size", "deleted", (F.substring("deleted", 1, 1) != "0").alias("is_deleted"), F.coalesce(F.nullif(F.trim("file_type"), F.lit("")), F.lit("fb2")).alias("file_type"),
        F.date_format("time", "yyyy-MM-dd").alias("date"), "lang", "keywords", F.nullif(F.col("year"), F.lit(0)).alias("year"), "md5",
    )
    rows = with_ratings(base, rates).join(authors, "book_id", "left").join(genres, "book_id", "left")
    own = series.select("book_id", "series", "number", F.col("type").alias("series_type"), F.col("level").alias("series_level"))
    out = rows.join(own, "book_id", "left")
    return out if files is None else out.join(files.select("book_id", "file_name"), "book_id", "left")


def assemble(rows: DataFrame, key: list[str], first: list[str] | None = None, order: str | None = None) -> DataFrame:
    """One book per key with its series (title, number, type, level), by type, then falling level, title, number.

    Columns in ``first`` are those of the row that comes first by ``order``; the others of a key only add series.
    """
    entry = F.struct(F.col("type").alias("type"), (-F.col("level")).alias("falling"), F.col("series").alias("title"), F.col("number").alias("number"))
    held = [F.min_by(F.struct(*first), order).alias("held")] if first else []
    sorted_ = rows.groupBy(*key).agg(F.array_sort(F.collect_list(entry)).alias("s"), *held)
    return sorted_.select(*key, *[F.col(f"held.{c}").alias(c) for c in first or ()], F.transform("s", lambda s: F.struct(s["title"].alias("title"), s["number"].alias("number"), s["type"].alias("type"), (-s["falling"]).alias("level"))).alias("series"))


def without_orphans(rows: DataFrame, owners: DataFrame, key: str, owner_key: str) -> DataFrame:
    return rows.join(owners, rows[key] == owners[owner_key], "left_semi")


def orphans(rows: DataFrame, owners: DataFrame, key: str, owner_key: str) -> DataFrame:
    return rows.join(owners, rows[key] == owners[owner_key], "left_anti")
