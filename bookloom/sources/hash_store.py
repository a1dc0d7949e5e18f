"""The store of fingerprints: XML elements of books, in a folder per archive.

Two layouts: one line per book (``write``, ``read``), and documents of many books over many lines, as other tools
write them (``write_books``, ``read_books``), with the library's name, word histogram and annotation.

A book has its text id, the digest of its bytes, its title, origin (if it is a duplicate), cover, images and the
tree of its sections, which is kept as a list of (depth, id, count, size) in page order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape, unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from bookloom.functions import text as tx

SECTION = "struct<depth:int,id:string,count:long,size:long>"
COLUMNS = f"file string, id string, hash string, title string, origin struct<folder:string,file:string>, cover struct<hash:string,phash:string>, images array<struct<id:string,hash:string,phash:string>>, sections array<{SECTION}>"


def _quoted(value: str) -> str:
    """An attribute's value, always in double quotes."""
    return '"' + escape(value, {'"': "&quot;", "\n": "&#10;", "\r": "&#13;", "\t": "&#9;"}) + '"'


def nested(sections: list[dict]) -> str:
    """A depth list as nested elements: a section lies in the nearest one before it of smaller depth."""
    out, open_ = [], []
    for s in sections:
        while open_ and open_[-1] >= s["depth"]:
            open_.pop()
            out.append("</section>")
        open_.append(s["depth"])
        out.append(f'<section id={_quoted(s["id"] or "")} count="{s["count"] or 0}" size="{s["size"] or 0}">')
    return "".join(out) + "</section>" * len(open_)


def _element(x: dict) -> str:
    given = lambda d, names: "".join(f" {n}={_quoted(str(d[n]))}" for n in names if d[n] is not None)
    inner = "".join(f"<{tag}{given(x[tag], names)}/>" for tag, names in (("origin", ("folder", "file")), ("cover", ("hash", "phash"))) if x[tag] is not None)
    inner += "".join(f"<image{given(i, ('id', 'hash', 'phash'))}/>" for i in (x["images"] if x["images"] is not None else ()))
    return f"<book{given(x, ('file', 'id', 'hash', 'title'))}>{inner}{nested(x['sections'] if x['sections'] is not None else [])}</book>".replace("\n", "&#10;").replace("\r", "&#13;")


#: Books that a worker holds as Python objects at once, which take many times their bytes in a batch.
_AT_ONCE = 64


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The books of batches, a few at a time; what Arrow has freed goes back to the system at the end."""
    for batch in batches:
        for at in range(0, batch.num_rows, _AT_ONCE):
            yield batch.slice(at, _AT_ONCE).to_pylist()
    pa.default_memory_pool().release_unused()


def _lines(made: list[tuple]) -> pa.RecordBatch:
    """Pairs of folder and line."""
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in made], pa.string()) for k in (0, 1)], names=["folder", "value"])


def write(rows: DataFrame, path: str) -> None:
    """``rows``: folder and the columns of a book; null parts are left out. Written by ranges of folder and file."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for books in _few(batches):
            yield _lines([(x["folder"], _element(x)) for x in books])

    names = [c.split()[0] for c in ("folder", "file", "id", "hash", "title", "origin", "cover", "images", "sections")]
    made = rows.select(names).repartitionByRange("folder", "file").sortWithinPartitions("folder", "file").mapInArrow(lines, "folder string, value string")
    made.write.partitionBy("folder").text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """folder and the columns of every book; broken elements give no row but in ``broken``."""
    return _parsed(spark, path).where("error is null").select("folder", "b.*")


def broken(spark: SparkSession, path: str) -> DataFrame:
    """folder, value, error of elements that do not parse."""
    return _parsed(spark, path).where("error is not null").select("folder", "value", "error")


def _parsed(spark: SparkSession, path: str) -> DataFrame:
    @F.pandas_udf(f"{COLUMNS}, error string")
    def parse(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_book(v) for v in values], columns=["file", "id", "hash", "title", "origin", "cover", "images", "sections", "error"])

    rows = spark.read.schema("value string, folder string").text(path)
    return rows.withColumn("b", parse("value")).withColumn("error", F.col("b.error")).select("folder", "value", "error", F.col("b").dropFields("error").alias("b"))


def _book(value: str) -> tuple:
    try:
        book = ElementTree.fromstring(value)
    except ElementTree.ParseError as e:
        return *[None] * 8, str(e)
    part = lambda tag, names: next(({n: x.get(n) for n in names} for x in book.findall(tag)), None)
    sections, todo = [], [(0, x) for x in reversed(book.findall("section"))]
    while todo:
        depth, x = todo.pop()
        sections.append({"depth": depth, "id": x.get("id"), "count": int(x.get("count", 0)), "size": int(x.get("size", 0))})
        todo.extend((depth + 1, y) for y in reversed(x.findall("section")))
    images = [{n: x.get(n) for n in ("id", "hash", "phash")} for x in book.findall("image")]
    return book.get("file"), book.get("id"), book.get("hash"), book.get("title"), part("origin", ("folder", "file")), part("cover", ("hash", "phash")), images, sections, None


#: What Spark's XML reader finds of a book of the second layout, and the rest that it keeps of a broken one.
_BOOK = (
    "struct<_hash:string,_id:string,_folder:string,_file:string,_title:string,origin:struct<_folder:string,_file:string>,cover:struct<_VALUE:string,_pHash:string>,"
    "image:array<struct<_VALUE:string,_id:string,_pHash:string>>,histogram:struct<item:array<struct<_count:long,_word:string>>>,annotation:struct<p:array<string>>,broken:string>"
)
_TAG = re.compile(r'<section\b((?:[^>"]|"[^"]*")*?)(/?)>|</section>')
_ATTRIBUTE = re.compile(r'(\w+)="([^"]*)"')


def _tree(book: str) -> list[tuple]:
    """(depth, id, count, size) of a book's nested sections, in page order."""
    out, depth = [], 0
    for m in _TAG.finditer(book):
        if m[1] is None:
            depth -= 1
            continue
        given = dict(_ATTRIBUTE.findall(m[1]))
        out.append((depth, unescape(given.get("id", ""), {"&quot;": '"'}), int(given.get("count") or 0), int(given.get("size") or 0)))
        depth += not m[2]
    return out


def _documents(spark: SparkSession, path: str) -> DataFrame:
    """path, source (of the document), text, b (what Spark's XML reader finds) of every book; documents are cut at the books' ends, so many tasks read one."""
    cut = spark.read.text(path, lineSep="</book>", recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), "value")
    source = tx.unescape_twice(F.regexp_extract("value", r'<books\b[^>]*?\bsource="([^"]*)"', 1))
    head = cut.where(F.col("value").contains("<books")).select("path", source.alias("source"))
    own = F.regexp_extract("value", r"(?s)(<book\s.*)", 1)
    books = cut.select("path", own.alias("text")).where("text <> ''").withColumn("text", F.concat("text", F.lit("</book>")))
    parsed = books.withColumn("b", F.from_xml("text", _BOOK, {"columnNameOfCorruptRecord": "broken", "ignoreSurroundingSpaces": "false"}))
    return parsed.join(head, "path", "left")


def read_books(spark: SparkSession, path: str) -> DataFrame:
    """source, folder, the columns of a book, histogram (array of count, word) and annotation (array of paragraphs) of every book under ``path``.

    Books that do not parse are left to ``broken_books``.
    """

    @F.pandas_udf(f"array<{SECTION}>")
    def tree(books: pd.Series) -> pd.Series:
        return pd.Series([_tree(x) for x in books], dtype="object")

    b = F.col("b")
    image = F.transform(F.coalesce(b["image"], F.array().cast("array<struct<_VALUE:string,_id:string,_pHash:string>>")), lambda i: F.struct(i["_id"].alias("id"), i["_VALUE"].alias("hash"), i["_pHash"].alias("phash")))
    cover = F.when(b["cover"].isNotNull(), F.struct(b["cover"]["_VALUE"].alias("hash"), b["cover"]["_pHash"].alias("phash")))
    origin = F.when(b["origin"].isNotNull(), F.struct(b["origin"]["_folder"].alias("folder"), b["origin"]["_file"].alias("file")))
    words = F.transform(F.coalesce(b["histogram"]["item"], F.array().cast("array<struct<_count:long,_word:string>>")), lambda w: F.struct(w["_count"].alias("count"), w["_word"].alias("word")))
    return _documents(spark, path).where("b.broken is null").select(
        "source", b["_folder"].alias("folder"), b["_file"].alias("file"), b["_id"].alias("id"), b["_hash"].alias("hash"), b["_title"].alias("title"), origin.alias("origin"), cover.alias("cover"), image.alias("images"),
        tree("text").alias("sections"), words.alias("histogram"), F.coalesce(b["annotation"]["p"], F.array().cast("array<string>")).alias("annotation"))


def broken_books(spark: SparkSession, path: str) -> DataFrame:
    """path, text of books that do not parse."""
    return _documents(spark, path).where("b.broken is not null").select("path", "text")


def _indented(x: dict) -> str:
    """A book of the second layout."""
    given = lambda d, **names: "".join(f" {n}={_quoted(str(d[c]))}" for n, c in names.items() if d[c] is not None)
    many = lambda c: x[c] if x[c] is not None else ()
    parts = [f"\t<book{given(x, hash='hash', id='id', folder='folder', file='file', title='title')}>"]
    if x["origin"] is not None:
        parts.append(f"\t\t<origin{given(x['origin'], folder='folder', file='file')}/>")
    if x["cover"] is not None:
        parts.append(f"\t\t<cover{given(x['cover'], pHash='phash')}>{escape(x['cover']['hash'] or '')}</cover>")
    parts += [f"\t\t<image{given(i, id='id', pHash='phash')}>{escape(i['hash'] or '')}</image>" for i in many("images")]
    parts.append(nested(many("sections")).replace("<section", "\n\t\t<section"))
    words = "".join(f'\n\t\t\t<item count="{w["count"]}" word={_quoted(w["word"])}/>' for w in many("histogram"))
    parts += [f"\t\t<histogram>{words}\n\t\t</histogram>"] * bool(words)
    paragraphs = "".join(f"<p>{escape(p)}</p>" for p in many("annotation"))
    parts += [f"\t\t<annotation>{paragraphs}</annotation>"] * bool(paragraphs)
    return "\n".join([*filter(None, parts), "\t</book>"])


def write_books(rows: DataFrame, path: str) -> None:
    """``rows``: source, folder, the columns of a book, histogram, annotation. A document for each folder and task."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None
        for books in _few(batches):
            out = []
            for x in books:
                if open_ != x["folder"]:
                    out += [(open_, "</books>")] * (open_ is not None)
                    open_ = x["folder"]
                    out.append((open_, f'<?xml version="1.0" encoding="UTF-8"?>\n<books source={_quoted(x["source"] or "")}>'))
                out.append((open_, _indented(x)))
            yield _lines(out)
        yield _lines([(open_, "</books>")] * (open_ is not None))

    names = ["source", "folder", "file", "id", "hash", "title", "origin", "cover", "images", "sections", "histogram", "annotation"]
    made = rows.select(names).repartitionByRange("folder", "file").sortWithinPartitions("folder", "file").mapInArrow(lines, "folder string, value string")
    made.withColumnRenamed("folder", "archive").write.partitionBy("archive").text(path)
