"""Book files as rows: what kind they are, their metadata, their text without pictures, and the pictures.

Python reads one file at a time inside a task; a file is one value of a binary column and has to fit there.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax import ContentHandler, SAXParseException, parseString
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from bookloom.sources import markup

#: Files that hold no book to parse, by the end of their name.
NO_BOOK = (".djvu", ".djv", ".pdf", ".txt", ".doc", ".docx", ".rtf", ".htm", ".html", ".chm", ".mobi", ".fbd", ".dll")
#: The parser of a file by the end of its name, and its turn where an archive holds several.
PARSERS = {".fb2": "fb2", ".epub": "epub", ".fbd": "stub", ".zip": "archive", ".7z": "archive", ".rar": "archive"}
TURN = {"fb2": 1, "epub": 2, "stub": 3}
#: Ends of names of an EPUB's text files.
TEXTS = (".htm", ".html", ".xhtml", ".xml")
#: Elements that a book may have, in lower case; names match in any case.
BOOK_TAGS = (
    "p", "fictionbook", "description", "body", "binary", "title-info", "src-title-info", "document-info", "publish-info", "custom-info",
    "genre", "author", "first-name", "last-name", "middle-name", "nickname", "nick-name", "nick", "email", "home-page", "book-title", "annotation",
    "poem", "cite", "subtitle", "empty-line", "keywords", "date", "coverpage", "image", "lang", "src-lang", "translator", "sequence", "program-used",
    "src-url", "src-ocr", "id", "version", "history", "book-author", "book-name", "publisher", "city", "year", "isbn", "title", "epigraph", "section",
    "v", "a", "text-author", "strong", "emphasis", "sub", "sup", "strikethrough", "code", "stanza", "i", "b", "u", "table", "tr", "td", "th", "img",
    "pre", "style", "center", "h1", "h2", "h3", "h4", "h5", "br", "stylesheet", "username", "em", "ol", "li", "col",
)
#: The format's name spaces.
SPACES = {"xmlns": "http://www.gribuser.ru/xml/fictionbook/2.0", "xmlns:l": "http://www.w3.org/1999/xlink"}


def parsable(name: Column) -> Column:
    low = F.lower(name)
    return ~F.coalesce(*[F.when(low.endswith(x), True) for x in NO_BOOK], F.lit(False))


def parser_of(name: Column) -> Column:
    """Name of the parser for a file, null if there is none."""
    low = F.lower(name)
    return F.coalesce(*[F.when(low.endswith(x), kind) for x, kind in PARSERS.items()])


def best_entry(entries: DataFrame, archive: str = "archive", entry: str = "entry") -> DataFrame:
    """Of each nested archive the entry to parse: a book before a description, the first by name; Mac OS folders are ignored."""
    kind = parser_of(F.col(entry))
    turn = F.coalesce(*[F.when(kind == k, n) for k, n in TURN.items()])
    rows = entries.where(~F.col(entry).startswith("__MACOSX")).withColumn("turn", turn).where("turn is not null")
    best = Window.partitionBy(archive).orderBy("turn", entry)
    return rows.withColumn("at", F.row_number().over(best)).where("at = 1").drop("at", "turn")


def kind_of(body: Column) -> Column:
    """fb2 (a root before a body), epub (an archive with its container file), archive, or null."""

    @F.pandas_udf("string")
    def told(bodies: pd.Series) -> pd.Series:
        return pd.Series([None if b is None else _kind(bytes(b)) for b in bodies], dtype="object")

    return told(body)


def _kind(body: bytes) -> str | None:
    if body.startswith(b"PK\x03\x04"):
        try:
            with zipfile.ZipFile(io.BytesIO(body)) as z:
                return "epub" if any(x.lower().endswith("meta-inf/container.xml") for x in z.namelist()) else "archive"
        except zipfile.BadZipFile:
            return None
    head = body.removeprefix(b"\xef\xbb\xbf").lstrip()
    root, inner = head.find(b"<FictionBook"), head.find(b"<body")
    return "fb2" if head.startswith((b"<?xml", b"<FictionBook")) and 0 <= root and (inner < 0 or root < inner) else None


def decoded(body: Column) -> Column:
    """A book's bytes as text, by its own encoding; the declaration then says UTF-8. Bytes that do not decode are replaced."""

    @F.pandas_udf("string")
    def read(bodies: pd.Series, codecs: pd.Series) -> pd.Series:
        return pd.Series([None if b is None else _decoded(bytes(b), c) for b, c in zip(bodies, codecs)], dtype="object")

    return read(body, markup.encoding(body))


def _decoded(body: bytes, codec: str) -> str:
    try:
        text = body.decode(codec, "replace")
    except LookupError:
        text = body.decode("utf-8", "replace")
    return re.sub(r'(<\?xml[^>]*?encoding=["\'])[^"\']*', r"\1UTF-8", text.removeprefix("﻿"), count=1)


#: Entities that books hold escaped twice, in the order in which they lose a level.
TWICE = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))
_TWICE = [(re.compile(x, re.I), y) for x, y in TWICE]


class _Text(ContentHandler):
    """Writes a book anew: without binaries and line breaks, foreign tags as text (but inside custom-info), entities
    escaped twice freed of one level, references by number, the tool named."""

    def __init__(self, ids: dict[str, str], tool: str):
        super().__init__()
        self.out, self.skip, self.ids, self.tool, self.named, self.custom = ['<?xml version="1.0" encoding="UTF-8"?>\n'], 0, ids, tool, False, False
        self.held: list[str] = []

    def _flush(self) -> None:
        if self.held:
            text = "".join(self.held)  # an entity may have come in pieces
            for pattern, char in _TWICE:
                text = pattern.sub(char, text)
            self.out.append(escape(text))
            self.held = []

    def startElement(self, name, attributes):  # noqa: N802
        low = name.rsplit(":", 1)[-1].lower()
        self.custom |= low == "custom-info"
        if low == "br":
            return
        self._flush()
        if self.skip or low == "binary":
            self.skip += 1
        elif low not in BOOK_TAGS and not self.custom:
            self.out.append(escape(f"<{name}>"))
        else:
            given = {k: v for k, v in attributes.items() if not k.startswith("xmlns")}
            if low == "fictionbook":
                given = SPACES | given
            self.out.append(f"<{name}" + "".join(f" {a}={quoteattr(b)}" for a, b in map(self._reference, given.items())) + ">")

    def _reference(self, item):
        name, value = item
        if name.startswith("xlink:"):
            name = f"l:{name[6:]}"
        if name.endswith(":href"):
            name = "l:href"
            if value.startswith("#"):
                bare = value.lstrip("#")
                value = f"#{self.ids.get(bare, bare)}"
        return name, value

    def endElement(self, name):  # noqa: N802
        low = name.rsplit(":", 1)[-1].lower()
        self.custom &= low != "custom-info"
        if low == "br":
            return
        self._flush()
        if self.skip:
            self.skip -= 1
        elif low not in BOOK_TAGS and not self.custom:
            self.out.append(escape(f"</{name}>"))
        else:
            used = f"<program-used>{escape(self.tool)}</program-used>"
            if low == "program-used":
                self.out.append(f", {escape(self.tool)}")
                self.named = True
            elif low == "document-info" and not self.named:
                self.out.append(used)
                self.named = True
            elif low == "description" and not self.named:
                self.out.append(f"<document-info>{used}</document-info>")
                self.named = True
            self.out.append(f"</{name}>")

    def characters(self, content):
        if not self.skip:
            self.held.append(content)


def book_text(df: DataFrame, body: str = "body", tool: str = "bookloom") -> DataFrame:
    """Adds text (the book without pictures) and status (valid, repaired, or the parser's error).

    A cut end is closed. A book that does not parse is scanned for stray characters (``markup.mended``) and tried
    again; only such books are. Its pictures are renamed in references: the cover to ``cover``, the others to
    their numbers. Null bodies give null.
    """

    @F.pandas_udf("text string, status string")
    def read(bodies: pd.Series, codecs: pd.Series) -> pd.DataFrame:
        texts = (None if b is None else markup.closed(_decoded(bytes(b), c or markup._vote(bytes(b)))) for b, c in zip(bodies, codecs))
        return pd.DataFrame([(None, None) if t is None else _read(t, tool) for t in texts], columns=["text", "status"])

    own = F.col(body)  # one pass: a worker of its own for each step would hold the book again
    return df.withColumn("_read", read(own, markup.declared_encoding(own))).select(*df.columns, "_read.text", "_read.status")


def _read(text: str, tool: str) -> tuple[str | None, str]:
    try:
        return _renamed(text, tool), "valid"
    except SAXParseException:
        try:
            return _renamed(markup.mended(text, BOOK_TAGS), tool), "repaired"
        except SAXParseException as e:
            return None, e.getMessage()


def _renamed(text: str, tool: str) -> str:
    ids = re.findall(r"<binary\b[^>]*?\bid=[\"']#?([^\"']+)", text)
    cover = re.search(r"<coverpage\b.*?href=[\"']#([^\"']+)", text, re.S)
    numbers, n = {}, 0
    for x in dict.fromkeys(ids):
        if cover and x == cover[1]:
            numbers[x] = "cover"
        else:
            numbers[x], n = str(n), n + 1
    handler = _Text(numbers, tool)
    parseString(text.encode(), handler)
    return "".join(handler.out)


def epub_metadata(df: DataFrame, body: str = "body") -> DataFrame:
    """Adds title, lang, authors, genres, text_size (characters of words in its text files) and error."""

    @F.pandas_udf("title string, lang string, authors array<string>, genres array<string>, text_size long, error string")
    def parse(bodies: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_epub(bytes(b) if b is not None else b"") for b in bodies], columns=["title", "lang", "authors", "genres", "text_size", "error"])

    return df.withColumn("_m", parse(F.col(body))).select("*", "_m.*").drop("_m")


def _epub(body: bytes) -> tuple:
    try:
        with zipfile.ZipFile(io.BytesIO(body)) as z:
            _, package = _package(z)
            found = lambda name: [" ".join("".join(x.itertext()).split()) for x in package.iter() if _local(x) == name]
            words = (re.findall(r"\w+", re.sub(r"<[^>]*>", " ", z.read(x).decode("utf-8", "replace"))) for x in z.namelist() if x.lower().endswith(TEXTS) and not x.startswith("META-INF"))
            size = sum(len(w) for own in words for w in own)
            return (found("title") or [None])[0], (found("language") or [None])[0], found("creator"), found("subject"), size, None
    except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, StopIteration) as e:
        return None, None, None, None, None, str(e) or "no package file"


def _local(x: ElementTree.Element) -> str:
    return x.tag.rsplit("}", 1)[-1]


def _package(z: zipfile.ZipFile) -> tuple[str, ElementTree.Element]:
    container = next(x for x in z.namelist() if x.lower().endswith("meta-inf/container.xml"))
    path = next(x.attrib["full-path"] for x in ElementTree.fromstring(z.read(container)).iter() if _local(x) == "rootfile")
    return path, ElementTree.fromstring(z.read(path))


def epub_parts(df: DataFrame, body: str = "body") -> DataFrame:
    """The rows once per file of an EPUB: kind (image or text), part_id, is_cover, content; the cover first, then images, then texts."""

    @F.pandas_udf("array<struct<kind:string,part_id:string,is_cover:boolean,content:binary>>")
    def parts(bodies: pd.Series) -> pd.Series:
        return pd.Series([_parts(bytes(b)) if b is not None else [] for b in bodies], dtype="object")

    return df.select(*[c for c in df.columns if c != body], F.inline(parts(F.col(body))))


def _parts(body: bytes) -> list[tuple]:
    try:
        with zipfile.ZipFile(io.BytesIO(body)) as z:
            path, package = _package(z)
            items = {x.attrib.get("id"): x.attrib for x in package.iter() if _local(x) == "item"}
            named = next((x.attrib.get("content") for x in package.iter() if _local(x) == "meta" and x.attrib.get("name") == "cover"), None)
            cover = next((k for k, a in items.items() if k == named or "cover-image" in a.get("properties", "")), None)
            images, texts = [], []
            for k, a in items.items():
                file = posixpath.normpath(posixpath.join(posixpath.dirname(path), a.get("href", "")))
                if file not in z.namelist():
                    continue
                if a.get("media-type", "").startswith("image/"):
                    images.append(("image", file, k == cover, z.read(file)))
                else:
                    texts.append(("text", file, False, z.read(file)))
            return sorted(images, key=lambda x: not x[2]) + texts
    except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, StopIteration):
        return []


def epub_files(df: DataFrame, name: str, body: str = "body") -> DataFrame:
    """``name``, kind, path, content: an EPUB as the files it is kept as.

    Texts lie under the book's own name, pictures under ``cover`` or their number (equal ones once), and a book with pictures
    has an index of them in JSON.
    """
    parts = epub_parts(df.select(F.col(name).alias("name"), body), body)
    texts = parts.where("kind = 'text'").select("name", "kind", F.concat("name", F.lit("/"), "part_id").alias("path"), "content")
    pictures = parts.where("kind = 'image'").withColumn("digest", F.md5("content"))
    rest = image_numbers(pictures.where("not is_cover"), "name", "part_id", "digest").select("name", "part_id", F.col("number").cast("string").alias("number"), "is_first", "content")
    numbered = rest.unionByName(pictures.where("is_cover").select("name", "part_id", F.lit("cover").alias("number"), F.lit(True).alias("is_first"), "content"))
    kept = numbered.where("is_first").select("name", F.lit("image").alias("kind"), F.concat("name", F.lit("/"), "number").alias("path"), "content")
    entry = F.struct(F.col("part_id").alias("id"), F.col("number").alias("num"))
    index = numbered.groupBy("name").agg(F.to_json(F.array_sort(F.collect_list(entry))).cast("binary").alias("content"))
    out = texts.unionByName(kept).unionByName(index.select("name", F.lit("index").alias("kind"), F.concat("name", F.lit("/index.json")).alias("path"), "content"))
    return out.withColumnRenamed("name", name)


def image_numbers(images: DataFrame, book: str, image: str, digest: str) -> DataFrame:
    """Adds number: equal pictures of a book share one, in the order of their first id; and is_first among them."""
    first = images.groupBy(book, digest).agg(F.min(image).alias("first_id"))
    numbered = first.withColumn("number", F.row_number().over(Window.partitionBy(book).orderBy("first_id", digest)) - 1)
    return images.join(numbered, [book, digest]).withColumn("is_first", F.col(image) == F.col("first_id")).drop("first_id")


def image_index(numbered: DataFrame, book: str, image: str) -> DataFrame:
    """book, index: JSON list of id and num of all its pictures."""
    entry = F.struct(F.col(image).alias("id"), F.col("number").alias("num"))
    return numbered.groupBy(book).agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("index"))


def signature(body: Column) -> Column:
    """Kind of a binary by its first bytes; base64 text is looked into."""
    plain = lambda b: F.coalesce(*[F.when(F.startswith(b, F.unhex(F.lit(x))), k) for x, k in (("FFD8FFE0", "jpg"), ("89504E47", "png"), ("52494646", "riff"), ("3C68746D6C", "html"), ("3C3F786D6C", "xml"), ("3C737667", "svg"), ("3C21444F4354595045", "doctype"), ("504B0304", "zip"), ("1F8B", "gz"))])
    coded = F.startswith(body, F.lit("/9j/4A").cast("binary")) | F.startswith(body, F.lit("iVBORw").cast("binary"))
    inner = F.try_to_binary(F.substring(body, 1, 64).cast("string"), F.lit("base64"))
    return F.coalesce(F.when(coded, F.concat(F.lit("base64 "), plain(inner))), plain(body), F.lit("other"))


def valid_file(name: Column, body: Column) -> Column:
    """Whether a file's first bytes are those that its name promises; only archives promise any."""
    low = F.lower(name)
    return F.when(low.endswith(".zip"), signature(body) == "zip").when(low.endswith(".gz"), signature(body) == "gz").otherwise(True)


def valid_page(page: Column, patterns: list[str]) -> Column:
    """Whether any pattern is found in a page."""
    found = F.lit(False)
    for x in patterns:
        found = found | page.rlike(x)
    return found


def size_class(size: Column, least_image: int = 1024) -> Column:
    """What a binary's size allows: nothing, no repair, no picture, or all."""
    return F.when(size < 100, "empty").when(size < 128, "no repair").when(size < least_image, "no picture").otherwise("picture")


def pixel_class(grayscale: Column, alpha: Column) -> Column:
    return F.when(grayscale, "grayscale").when(alpha, "alpha").otherwise("normal")


def wanted_picture(path: Column) -> Column:
    """Its file name, where a picture's path has exactly three parts."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    return F.when(F.size(parts) == 3, F.element_at(parts, -1))


def mostly(entries: DataFrame, archive: str, suffix: str, share: float = 0.9) -> DataFrame:
    """archive, total and whether more than ``share`` of its entries end in ``suffix``."""
    part = F.avg(F.lower("entry").endswith(suffix).cast("double"))
    return entries.groupBy(archive).agg(F.count(F.lit(1)).alias("total"), (part > share).alias("mostly"))
