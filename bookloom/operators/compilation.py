"""Sections of books: their trees, their text ids, and books made of other books."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


#: What a text must hold to have a word.
WORD = r"[\p{L}\p{N}]"


def histogram(text: Column) -> Column:
    """Words of a text with their counts, array of (n, word), most frequent first, then by word; null without words.

    Counted inside the row: the words are sorted, and a run's length is the distance to the next run's start.
    Rows without a word are best left out by ``WORD``, since a condition on the result would compute it once more.
    """
    words = F.sort_array(F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), ""))

    def counted(ws: Column) -> Column:
        starts = F.filter(F.transform(ws, lambda w, i: F.when((i == 0) | (w != F.get(ws, i - 1)), i)), lambda i: i.isNotNull())
        runs = F.transform(F.array(starts), lambda at: F.transform(at, lambda s, k: F.struct((s - F.coalesce(F.get(at, k + 1), F.size(ws))).alias("less"), F.get(ws, s).alias("word"))))
        return F.when(F.size(ws) > 0, F.sort_array(F.get(runs, F.lit(0))))

    found = F.get(F.transform(F.array(words), counted), F.lit(0))
    return F.transform(found, lambda x: F.struct((-x["less"]).alias("n"), x["word"].alias("word")))


def text_ids(docs: DataFrame, key: str, text: str, top: int | None = None) -> DataFrame:
    """key, text_id: md5 of the words with their counts, most frequent first; of the ``top`` first ones if given.

    A text without words has none. One map, no shuffle.
    """
    found = docs.where(F.col(text).rlike(WORD)).select(key, histogram(F.col(text)).alias("x"))
    kept = F.col("x") if top is None else F.slice("x", 1, top)
    return found.select(key, F.md5(F.array_join(F.transform(kept, lambda w: F.concat_ws(" ", w["n"].cast("string"), w["word"])), ",").cast("binary")).alias("text_id"))


def last_at_depth(rows: DataFrame, doc: str, order: str, depth: str, wanted: int) -> DataFrame:
    """Adds parent: the order of the last earlier row at depth ``wanted``."""
    before = Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("parent", F.max(F.when(F.col(depth) == wanted, F.col(order))).over(before))


def intervals(rows: DataFrame, doc: str, order: str, depth: str) -> DataFrame:
    """Adds parent (the order of the nearest earlier row of smaller depth, null for roots) and leave (the last order inside).

    A row's subtree is all of its document from ``order`` to ``leave``, so one row lies in another where its order does,
    whatever the depth. One fold over each document's rows in order, which holds the open rows alone (one a level).
    Columns must be scalars.
    """
    names = rows.columns
    at_doc, at_order, at_depth = (names.index(c) for c in (doc, order, depth))

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_: list[tuple] = []  # (row, parent)
        last = None
        for batch in batches:
            done = []

            def close(least: int) -> None:
                while open_ and open_[-1][0][at_depth] >= least:
                    row, parent = open_.pop()
                    done.append((*row, parent, last[at_order]))

            rows_ = batch if batch.notna().all(axis=None) else batch.astype(object).where(batch.notna(), None)
            for row in rows_.itertuples(index=False, name=None):
                close(row[at_depth] if last is not None and row[at_doc] == last[at_doc] else _BELOW_ALL)
                open_.append((row, open_[-1][0][at_order] if open_ else None))
                last = row
            yield pd.DataFrame(done, columns=[*names, "parent", "leave"])
        done = []
        while open_:
            row, parent = open_.pop()
            done.append((*row, parent, last[at_order]))
        yield pd.DataFrame(done, columns=[*names, "parent", "leave"])

    kind = rows.schema[order].dataType
    schema = T.StructType([*rows.schema.fields, T.StructField("parent", kind), T.StructField("leave", kind)])
    return rows.repartition(doc).sortWithinPartitions(doc, order).mapInPandas(_nullable(fold, schema), schema)


_BELOW_ALL = -(1 << 62)


def _nullable(fold, schema: T.StructType):
    """Whole numbers with nulls in them stay whole on their way to Arrow."""
    whole = {f.name: "Int64" for f in schema.fields if isinstance(f.dataType, T.IntegralType)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for out in fold(batches):
            yield out.astype(whole)

    return run


def parents(rows: DataFrame, doc: str, order: str, depth: str) -> DataFrame:
    """Adds parent: the order of the nearest earlier row with a smaller depth; null for roots."""
    return intervals(rows, doc, order, depth).drop("leave")


def compilations(sections: DataFrame, published: DataFrame, doc: str, book: str, least_size: int, least_parts: int = 2) -> DataFrame:
    """doc, found (``part:book`` in order), parts, covered.

    ``sections``: doc, section (hash), ord, size; ``published``: book, section. Sections below ``least_size``
    are ignored; a part is numbered by the place of its section; ``covered`` says that no section of the
    document is missing among the books. Documents with fewer than ``least_parts`` found sections are left out.
    """
    own = sections.where(F.col("size") >= least_size).groupBy(doc, "section").agg(F.min("ord").alias("ord"))
    total = own.groupBy(doc).agg(F.count(F.lit(1)).alias("total"))
    hit = own.join(published.select(book, "section").distinct(), "section")
    hit = hit.withColumn("part", F.dense_rank().over(Window.partitionBy(doc).orderBy("ord")) - 1)
    made = hit.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("part", book))).alias("x"), F.countDistinct("section").alias("parts")).where(F.col("parts") >= least_parts)
    return made.join(total, doc).select(doc, F.array_join(F.transform("x", lambda s: F.concat_ws(":", s["part"].cast("string"), s[book].cast("string"))), ",").alias("found"), "parts", (F.col("parts") == F.col("total")).alias("covered"))


def tree_compilations(sections: DataFrame, published: DataFrame, doc: str = "doc", least_size: int = 100, least_parts: int = 2) -> DataFrame:
    """doc, found (``part:book`` in order), parts, covered, from trees of sections.

    ``sections``: doc, own (the document's own text id), ord, depth (of a tree: at most one more than the row
    before), section (text id), size (words); ``published``: section, book. The walk ignores small sections with
    all below them, goes down through the document's own section, takes a published one as a part and leaves
    what lies below it, goes down through unknown ones, and notes unknown ones with nothing below as missing;
    ``covered`` says that none is. Parts are numbered by the place of their first section.
    """
    known = published.select("section").distinct().withColumn("known", F.lit(True))
    rows = intervals(sections.select(doc, "own", "ord", "depth", "section", "size"), doc, "ord", "depth").join(known, "section", "left")
    rows = rows.withColumns({"part_of": (F.col("section") != F.col("own")) & F.coalesce("known", F.lit(False)), "small": F.col("size") < least_size})
    order = Window.partitionBy(doc).orderBy("ord")
    # intervals nest, so a row lies below a stop if any stop before it reaches this far
    reach = F.max(F.when(F.col("small") | F.col("part_of"), F.col("leave"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    walked = rows.withColumn("above", F.coalesce(reach >= F.col("ord"), F.lit(False))).where(~F.col("above") & ~F.col("small"))
    missing = ~F.col("part_of") & (F.col("section") != F.col("own")) & (F.col("leave") == F.col("ord"))
    covered = walked.groupBy(doc).agg((~F.bool_or(missing)).alias("covered"))
    parts = walked.where("part_of").groupBy(doc, "section").agg(F.min("ord").alias("ord"))
    hit = parts.withColumn("part", F.row_number().over(Window.partitionBy(doc).orderBy("ord")) - 1).join(published.distinct(), "section")
    made = hit.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("part", "book"))).alias("x"), F.countDistinct("section").alias("parts")).where(F.col("parts") >= least_parts)
    return made.join(covered, doc).select(doc, F.array_join(F.transform("x", lambda s: F.concat_ws(":", s["part"].cast("string"), s["book"].cast("string"))), ",").alias("found"), "parts", "covered")


def documents(made: DataFrame, books: DataFrame, doc: str = "doc") -> DataFrame:
    """folder, file, compilation (array of part, folder, file in the order of parts), covered: what is published of compilations.

    ``made``: of ``compilations`` or ``tree_compilations``; ``books``: book, folder, file of documents and parts alike.
    """
    each = made.select(doc, "covered", F.explode(F.split("found", ",")).alias("one"))
    each = each.select(doc, "covered", F.substring_index("one", ":", 1).cast("int").alias("part"), F.substring_index("one", ":", -1).alias("book"))
    named = books.select(F.col("book").cast("string").alias("book"), "folder", "file")
    parts = each.join(named, "book").groupBy(doc, "covered").agg(F.array_sort(F.collect_list(F.struct("part", "folder", "file"))).alias("compilation"))
    return parts.withColumn("book", F.col(doc).cast("string")).join(named, "book").select("folder", "file", "compilation", "covered")
