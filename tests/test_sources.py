"""Readers and writers of book files, fingerprints, dumps, lists and settings, by hand-written cases and round trips."""

import io
import json
import random
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from bookloom.operators import entries, publish
from bookloom.sinks import published
from bookloom.sources import books, dialects, hash_store, markup


def zipped(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in files.items():
            z.writestr(name, body)
    return out.getvalue()


FB2 = """<?xml version="1.0" encoding="windows-1251"?><FictionBook xmlns:l="http://www.w3.org/1999/xlink"><description><title-info><book-title>T</book-title><coverpage><image l:href="#c.jpg"/></coverpage></title-info>
<document-info><program-used>X</program-used></document-info></description><body><p>Текст<br/>a <foo>odd</foo> <image l:href="#i.png"/></p></body><binary id="i.png">AAAA</binary><binary id="c.jpg">BBBB</binary></FictionBook>"""
EPUB = {
    "META-INF/container.xml": '<container><rootfiles><rootfile full-path="O/p.opf"/></rootfiles></container>',
    "O/p.opf": '<package xmlns:dc="d"><metadata><dc:title>Title</dc:title><dc:creator>A B</dc:creator><dc:language>en</dc:language><dc:subject>sf</dc:subject><meta name="cover" content="c"/></metadata><manifest><item id="t" href="t.xhtml" media-type="application/xhtml+xml"/><item id="i" href="i.png" media-type="image/png"/><item id="c" href="c.jpg" media-type="image/jpeg"/></manifest></package>',
    "O/t.xhtml": "<html><p>two words</p></html>", "O/i.png": b"\x89PNG", "O/c.jpg": b"\xff\xd8",
}


def test_book_text(spark):
    broken = FB2.replace("</FictionBook>", "").replace("<p>", "<p>a & b <x@y.zz> ")
    rows = spark.createDataFrame([(1, FB2.encode("cp1251")), (2, broken.encode("cp1251")), (3, None), (4, b"<FictionBook><p></FictionBook")], "id int, body binary")
    got = {r.id: r for r in books.book_text(rows).collect()}
    assert (got[1].status, got[2].status, got[3].text) == ("valid", "repaired", None) and got[4].text is None
    text = got[1].text
    assert "binary" not in text and "<br" not in text and "&lt;foo&gt;odd&lt;/foo&gt;" in text and "Текст" in text
    assert 'l:href="#cover"' in text and 'l:href="#0"' in text and "<program-used>X, bookloom</program-used>" in text and 'encoding="UTF-8"' in text
    assert "a &amp; b" in got[2].text and '"x@y.zz"' in got[2].text
    again = books.book_text(spark.createDataFrame([(1, text.encode())], "id int, body binary")).first()
    assert again.status == "valid" and "X, bookloom, bookloom" in again.text


def test_book_text_keeps_known_tags_in_any_case(spark):
    inner = "<p><i>it</i> <B>b</B> &amp;lt;x&amp;GT; &amp;amp;quot;</p><h1>H</h1><P>up<nick>n</nick></P><q>no</q>"
    book = f"<FictionBook><description><custom-info><any>x</any></custom-info></description><body>{inner}</body></FictionBook>"
    text = books.book_text(spark.createDataFrame([(1, book.encode())], "id int, body binary")).first().text
    assert "<p><i>it</i> <B>b</B> &lt;x&gt; &amp;quot;</p><h1>H</h1><P>up<nick>n</nick></P>&lt;q&gt;no&lt;/q&gt;" in text
    assert "<any>x</any></custom-info><document-info><program-used>bookloom</program-used></document-info></description>" in text


def slow_mended(text, tags):
    """The scan of ``markup.mended`` character by character."""
    out, i, custom = "", 0, False
    low = text.lower()
    starts = lambda at, names: next((t for t in names if low.startswith(t, at) and text[at + len(t) : at + len(t) + 1] in tuple(" >/\r\n")), None)
    while i < len(text):
        c = text[i]
        br = re.match(r"(?i)</?br\s*/?>", text[i:])
        letterless = re.match(r"(?i)</[^a-z<>]+>", text[i:])
        if br or letterless:
            i += (br or letterless).end()
            continue
        if c in "\r\n":
            while i < len(text) and text[i] in "\r\n":
                i += 1
            out += "\n"
            continue
        if c < " " and c != "\t":
            i += 1
            continue
        if c == "&" and not any(low.startswith(x, i + 1) for x in ("amp;", "apos;", "gt;", "lt;", "quot;")):
            out += "&amp;"
        elif c == "<" and starts(i + 1, ("custom-info",)) or c == "<" and text[i + 1 : i + 2] == "/" and starts(i + 2, ("custom-info",)):
            custom = text[i + 1] != "/"
            out += c
        elif c == "<" and not text.startswith("<!--", i) and not starts(i + 1 + (text[i + 1 : i + 2] == "/"), tags) and not custom:
            out += "&lt;"
        elif c == ">" and not custom and text[i - 1 : i] not in ('"', "/") and not text[:i].endswith("--") and not any(low[:i].endswith(f"{x}{t}") for t in tags for x in "</"):
            out += "&gt;"
        else:
            out += c
        i += 1
    return out


def test_scan_against_a_slow_one():
    rng, tags = random.Random(6), ("p", "b", "section", "br", "custom-info")
    parts = ["<p>", "</p>", "<P ", '<b a="x">', "<b/>", "<q>", "</q>", "a", " ", "&", "&amp;", "&LT;", "&#160;", "<", ">", "\r\n", "\n", "\x01", "<br>", "<br />", "</1>", "<section\n", "<!-- c -->", "<custom-info>", "</custom-info>", '"', "/", "é"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert markup.mended(text, tags) == slow_mended(text, tags), text
    assert markup.mended("<?xml & ?><a@b.cd> <section id=n3>x", tags) == '<?xml & ?>"a@b.cd" <section id="n3">x'


def test_kinds_and_epub(spark):
    rows = spark.createDataFrame([(1, zipped(EPUB)), (2, zipped({"a.fb2": "x"})), (3, FB2.encode()), (4, b"no"), (5, None), (6, b"PK\x03\x04broken")], "id int, body binary")
    assert [r.k for r in rows.select("id", books.kind_of(F.col("body")).alias("k")).orderBy("id").collect()] == ["epub", "archive", "fb2", None, None, None]
    got = books.epub_metadata(rows).where("id = 1").first()
    assert (got.title, got.lang, got.authors, got.genres, got.text_size, got.error) == ("Title", "en", ["A B"], ["sf"], 8, None)
    assert books.epub_metadata(rows).where("id <> 1 and error is null").count() == 0
    parts = [(r.kind, r.part_id, r.is_cover, bytes(r.content)) for r in books.epub_parts(rows).where("id = 1").collect()]
    assert parts == [("image", "O/c.jpg", True, b"\xff\xd8"), ("image", "O/i.png", False, b"\x89PNG"), ("text", "O/t.xhtml", False, b"<html><p>two words</p></html>")]


def test_signatures_and_names(spark):
    bodies = {"jpg": b"\xff\xd8\xff\xe0", "png": b"\x89PNG", "riff": b"RIFF", "gz": b"\x1f\x8b", "zip": b"PK\x03\x04", "xml": b"<?xml", "svg": b"<svg", "html": b"<html>", "doctype": b"<!DOCTYPE", "other": b"x", "base64 png": b"iVBORw0KGgoAAAA="}
    rows = spark.createDataFrame(list(bodies.items()), "want string, body binary")
    assert all(r.want == r.got for r in rows.select("want", books.signature(F.col("body")).alias("got")).collect())
    assert [tuple(r) for r in rows.where("want in ('zip', 'gz')").select("want", books.valid_file(F.lit("a.ZIP"), F.col("body"))).orderBy("want").collect()] == [("gz", False), ("zip", True)]
    names = spark.createDataFrame([("a.PDF",), ("b.fb2",), ("c.epub",), ("d.zip",), ("x/y/z.jpg",)], "n string")
    got = [tuple(r) for r in names.select(books.parsable(F.col("n")), books.parser_of(F.col("n")), books.wanted_picture(F.col("n"))).collect()]
    assert got == [(False, None, None), (True, "fb2", None), (True, "epub", None), (True, "archive", None), (True, None, "z.jpg")]
    found = spark.createDataFrame([("z", "b.fbd"), ("z", "c.epub"), ("z", "a.fb2"), ("z", "__MACOSX/0.fb2"), ("y", "t.txt")], "archive string, entry string")
    assert [tuple(r) for r in books.best_entry(found).collect()] == [("z", "a.fb2")]
    assert [tuple(r) for r in books.mostly(found.where("archive = 'z'"), "archive", ".fb2", 0.4).collect()] == [("z", 4, True)]


def test_image_numbers(spark):
    rows = spark.createDataFrame([("b", "i1", "h1"), ("b", "i2", "h2"), ("b", "i3", "h1"), ("c", "i1", "h1")], "book string, image string, hash string")
    numbered = books.image_numbers(rows, "book", "image", "hash")
    assert {(r.book, r.image): (r.number, r.is_first) for r in numbered.collect()} == {("b", "i1"): (0, True), ("b", "i2"): (1, True), ("b", "i3"): (0, False), ("c", "i1"): (0, True)}
    assert {r.book: json.loads(r["index"]) for r in books.image_index(numbered, "book", "image").collect()}["b"] == [{"id": "i1", "num": 0}, {"id": "i2", "num": 1}, {"id": "i3", "num": 0}]


def test_hash_store_round_trip(spark, tmp_path):
    rows = [
        ("f1", "a.fb2", "t1", "h1", 'T "q" & <x>\nline', ("o", "p.fb2"), ("ch", "00ff"), [("1", "ih", "0f"), ("2", "ig", None)], [(0, "s0", 300, 2000), (1, "s1", 100, 700), (3, "s2", 90, 600), (2, "s3", 5, 50), (0, "s4", 1, 1)]),
        ("f2", "b.fb2", "t2", "h2", None, None, None, [], []),
    ]
    schema = f"folder string, {hash_store.COLUMNS}"
    hash_store.write(spark.createDataFrame(rows, schema), f"{tmp_path}/store")
    back = {r.file: r for r in hash_store.read(spark, f"{tmp_path}/store").collect()}
    assert (back["a.fb2"].title, back["a.fb2"].folder, tuple(back["a.fb2"].origin), tuple(back["a.fb2"].cover)) == (rows[0][4], "f1", ("o", "p.fb2"), ("ch", "00ff"))
    assert [tuple(s) for s in back["a.fb2"].sections] == [(0, "s0", 300, 2000), (1, "s1", 100, 700), (2, "s2", 90, 600), (2, "s3", 5, 50), (0, "s4", 1, 1)]  # depths as nested
    assert back["b.fb2"].title is None and back["b.fb2"].images == [] and [tuple(i) for i in back["a.fb2"].images] == rows[0][7]
    spark.createDataFrame([("f3", "<book file='x'>")], "folder string, value string").write.mode("append").partitionBy("folder").text(f"{tmp_path}/store")
    assert hash_store.read(spark, f"{tmp_path}/store").count() == 2 and hash_store.broken(spark, f"{tmp_path}/store").count() == 1
    sized = entries.sized(spark.createDataFrame([("a.fb2", 9), ("z", 8)], "file string, size long"), hash_store.read(spark, f"{tmp_path}/store").withColumn("id", F.lit("s0")))
    assert {r.file: r.size for r in sized.collect()} == {"a.fb2": 2000, "z": 8}


def test_entries(spark):
    files = spark.createDataFrame([("f", "a.fb2"), ("f", "b.c.fb2"), ("f", "zz.fb2")], "folder string, file string")
    known = spark.createDataFrame([("a.fb2", 1), ("b.fb2", 2)], "file_key string, book int")
    assert {r.file: (r.book, r.matched) for r in entries.bind(files, known).collect()} == {"a.fb2": (1, 1), "b.c.fb2": (2, 2), "zz.fb2": (None, 0)}
    look = lambda *rows: spark.createDataFrame(list(rows), "key string, book int")
    found = spark.createDataFrame([("f", "a", "m1"), ("f", "b.ZIP", "m2"), ("f", "c", "m3"), ("f", "d", "m4"), ("f", "e", "m5"), ("f", "g", "m6")], "folder string, file string, md5 string")
    got = entries.resolve_entries(found, look(("f#a", 1), ("f#b", 2)), look(("m3", 3), ("m1", 9)), look(("m4", 4), ("m3", 9)), look(("f#e", 5)))
    assert {r.file: (r.book, r.matched) for r in got.collect()} == {"a": (1, 1), "b.ZIP": (2, 2), "c": (3, 3), "d": (4, 4), "e": (5, 5), "g": (None, 0)}
    unknown = spark.range(1).select(*entries.unknown_book(F.lit("x/n.m.djvu"), F.lit(7), F.lit("2020-02-03").cast("date"))).first()
    assert (unknown.title, unknown.ext, unknown.size, unknown.deleted, unknown.date) == ("n.m", "djvu", "7", True, "2020-02-03")
    index = entries.library_index(spark.createDataFrame([(1, "s", "10", "fb2-030560-060423.zip"), (2, "s", "11", "other.zip"), (3, "t", "10", "fb2-030560-060423.7z")], "book int, source string, libid string, folder string"))
    assert {r.key: r.book for r in index.collect()} == {"s_10": 1, "s_11": 2, "t_10": 3, "10": 1}
    named = entries.with_original_names(spark.createDataFrame([("1", "d", "fbd", "orig", "djvu"), ("2", "e", "fb2", "", None)], "libid string, file string, ext string, origin_base string, origin_suffix string"))
    assert sorted(map(tuple, named.collect())) == [("2", "e", "fb2"), ("orig", "orig", "djvu")]
    table = spark.createDataFrame([("ru", "ru"), ("rus", "ru")], "code string, language string")
    codes = spark.createDataFrame([(" RUS",), ("xx",), (None,)], "c string")
    assert [r[0] for r in codes.select(entries.canonical_language(F.col("c"), table)).collect()] == ["ru", "un", "un"]
    kept, pictures = entries.without_duplicates(spark.createDataFrame([(1,), (2,)], "id long"), spark.createDataFrame([(2, 1)], "dup long, origin long"), spark.createDataFrame([(1, "i"), (2, "j")], "id long, image string"))
    assert [r.id for r in kept.collect()] == [1] and [r.image for r in pictures.collect()] == ["i"]
    assert [r.origin for r in entries.with_origins(spark.createDataFrame([(1, None), (2, None)], "id long, origin long"), spark.createDataFrame([(2, 1), (2, 0)], "dup long, origin long")).orderBy("id").collect()] == [None, 0]
    notes = entries.author_notes(spark.createDataFrame([(5, 1, "B"), (4, 2, "C")], "nid long, author_id long, body string"), spark.createDataFrame([(1, "L", "F", "M")], "author_id long, last string, first string, middle string"), spark.createDataFrame([(1, "p.jpg")], "author_id long, file string"))
    assert [tuple(r) for r in notes.collect()] == [(5, "L F M", "B", "p.jpg")]
    assert entries.good_names(spark.createDataFrame([("a\nb",), ("ok",)], "n string"), "n").count() == 1


def test_published_files(spark, tmp_path):
    rows = spark.createDataFrame([(f"arc{i % 2}", i, f"Author {i}") for i in range(40)], "folder string, place long, author string")
    rows = rows.withColumn("series", F.when(F.col("place") == 3, F.expr("array(struct(1d as level, 'S' as title, 1L as number), struct(2d as level, 'T' as title, 2L as number))")).otherwise(F.expr("array(struct(cast(null as double) as level, '' as title, cast(null as bigint) as number))")))
    fields = [F.col("author"), *[F.lit(None)] * 2, F.col("series_title"), F.col("series_number"), *[F.lit(None)] * 12]
    published.write_index(published.series_lines(rows, fields), f"{tmp_path}/index", "collection", "20200101")
    back = published.read_index(spark, f"{tmp_path}/index").collect()
    assert len(back) == 41 and {(r.folder, r.series, r.serno) for r in back if r.author == "Author 3"} == {("arc1", "S", "1"), ("arc1", "T", "2")}
    assert {r.info for r in spark.read.text(f"{tmp_path}/index/info").collect()} == {"structure", "version", "collection"}
    files = sorted((tmp_path / "index" / "inp" / "folder=arc0").glob("part-*"))
    lines = [x.split("\4")[0] for f in files for x in f.read_text().splitlines()]
    assert lines == [f"Author {i}" for i in range(0, 40, 2)]  # part after part in the order of places
    published.write_annotations(spark.createDataFrame([("f", "a", 'x < "y"\n& z')], "folder string, file string, annotation string"), f"{tmp_path}/notes")
    assert tuple(published.read_annotations(spark, f"{tmp_path}/notes").first()) == ("f", "a", 'x < "y" & z')
    assert published.write_checked(rows.select("folder", "place"), f"{tmp_path}/checked", partition="folder") == 40
    good = published.quarantine(spark.createDataFrame([(1, None), (2, "b")], "id int, x string"), F.when(F.col("x").isNull(), "no x"), f"{tmp_path}/bad")
    assert [r.id for r in good.collect()] == [2] and [tuple(r) for r in spark.read.parquet(f"{tmp_path}/bad").collect()] == [(1, None, "no x")]
    built = []
    make = lambda: built.append(1) or spark.range(3)
    assert [published.open_or_build(spark, f"{tmp_path}/db", make).count() for _ in range(2)] == [3, 3] and len(built) == 1
    published.write_tables({"a": spark.range(4).withColumn("k", F.col("id") % 2)}, f"{tmp_path}/tables", {"a": "k"})
    assert spark.read.parquet(f"{tmp_path}/tables/a").where("k = 1").count() == 2


def test_one_blank_series(spark):
    rows = spark.createDataFrame([(1, "A", 1, 0, 1.0), (1, "B", 2, 0, 2.0)], "book long, title string, number long, type int, level double")
    assert [[s.title for s in r.series] for most in (0, -1, 1, None) for r in publish.series_of_book(rows, "book", most).collect()] == [[""], [""], ["A"], ["A", "B"]]


def test_dialects(spark, tmp_path):
    (tmp_path / "a.sql").write_text("INSERT INTO `libavtor` VALUES (1,10,'a'),(1,11,'t'),(2,11,'a');\nINSERT INTO `libavtors` VALUES (10,'F','M','L',0),(11,'f','m','l',10);\nINSERT INTO `libpolka` VALUES (1,'2020-01-02',5,'b',1,'text','',''),(2,'2020-01-02',5,'x',1,'no','','');\n")
    known = {"One": dialects.DIALECTS["placed"], "Two": dialects.DIALECTS["roles"]}
    assert [dialects.choose(*x, known=known).name for x in (("/x/y", "TWO"), ("/x/two/sql", None), ("/x/y", None), ("c:\\two\\x", "none"))] == ["roles", "roles", "placed", "roles"]
    tables = dialects.load(spark, str(tmp_path), dialects.DIALECTS["roles"])
    assert {r.book_id: r.authors for r in dialects.DIALECTS["roles"].authors(tables).collect()} == {1: "L,F,M:", 2: "L,F,M:"}
    assert [tuple(r) for r in dialects.DIALECTS["roles"].reviews(tables).collect()] == [(5, None, "2020-01-02", "text")]
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    other = spark.createDataFrame([(1, "x", 7), (2, "y", 8)], "id long, name string, LibraryId int")
    assert sorted(map(tuple, dialects.corrected(rows, other, spark.createDataFrame([(7, "one"), (8, "two")], "Id int, Name string"), "one", "id", ["name"]).collect())) == [(1, "x"), (2, "b")]


def test_settings(spark, tmp_path):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(dialects.settings(F.lit('{"n": 3}'), "n int", '{"n": 1}')).n == 3 and one(dialects.settings(F.lit(None), "n int", '{"n": 1}')).n == 1 and one(dialects.settings(F.lit("{"), "n int", "{}")).n is None
    size = lambda t: tuple(one(dialects.size_option(F.lit(t), F.lit(1), F.lit(2))))
    assert [size(x) for x in ("7", "7,8", "", "x", "7,y", None)] == [(7, 7), (7, 8), (1, 2), (1, 2), (1, 2), (1, 2)]
    assert one(dialects.archiver_arguments(F.lit("a  %src% -o#dst#"), F.lit("/d"))) == ["a", "/d/*.fb2", "-o/d"]
    dialects.write_ready_list(spark.createDataFrame([("a",), ("a",), ("b",), ("",)], "name string"), f"{tmp_path}/ready")
    assert sorted(r.name for r in dialects.ready_list(spark, f"{tmp_path}/ready").collect()) == ["a", "b"]
    assert one(books.valid_page(F.lit("abc"), ["x", "b"])) and not one(books.valid_page(F.lit("abc"), ["x"]))
    assert [one(books.size_class(F.lit(n))) for n in (50, 120, 1000, 2000)] == ["empty", "no repair", "no picture", "picture"]
    assert [one(books.pixel_class(F.lit(g), F.lit(a))) for g, a in ((True, True), (False, True), (False, False))] == ["grayscale", "alpha", "normal"]
    with pytest.raises(Exception, match="holds"):
        rows = spark.createDataFrame([(0.5,)], "x double")
        published.write_checked(rows, f"{tmp_path}/text", "csv", nullValue="0.5")


def test_documents_of_books(spark, tmp_path):
    """Documents as other tools write them: origin behind the sections, siblings and depth of sections, broken books."""
    deep = "".join(f'\n<section id="d{i}" count="{i}" size="{10 * i}">' for i in range(40)) + "</section>" * 40
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.xml").write_text(f'''<?xml version="1.0"?>
<books source="lib&amp;x">
    <book hash="h1" id="i1" folder="f.zip" file="1.fb2" title="A &lt;b&gt;">
        <cover id="c" pHash="1f">ch</cover><image id="0" pHash="2">ih</image>
        <section id="i1" count="3" size="9"><section id="s1"/><section id="s2" count="1"></section></section><section id="t" size="4"/>
        <histogram><item count="2" word="w"/></histogram><annotation><p>one
two</p></annotation><origin folder="g.zip" file="0.fb2"/>
    </book>
    <book hash="h2" id="i2" folder="f.zip" file="2.fb2" title="">{deep}</book>
    <book hash="h3" broken</book>
</books>''')
    (tmp_path / "y.xml").write_text('<books source="other"><book hash="h4" id="i4" folder="g" file="4.fb2" title="T"/></books>'.replace("/></books>", "></book></books>"))
    got = {r.file: r for r in hash_store.read_books(spark, str(tmp_path)).collect()}
    assert set(got) == {"1.fb2", "2.fb2", "4.fb2"} and [got[k].source for k in sorted(got)] == ["lib&x", "lib&x", "other"]
    one = got["1.fb2"]
    assert [tuple(s) for s in one.sections] == [(0, "i1", 3, 9), (1, "s1", 0, 0), (1, "s2", 1, 0), (0, "t", 0, 4)]
    assert (tuple(one.cover), tuple(one.origin), [tuple(i) for i in one.images], [tuple(w) for w in one.histogram], one.annotation, one.title) == (("ch", "1f"), ("g.zip", "0.fb2"), [("0", "ih", "2")], [(2, "w")], ["one\ntwo"], "A <b>")
    assert [s.depth for s in got["2.fb2"].sections] == list(range(40)) and got["2.fb2"].cover is None
    broken = hash_store.broken_books(spark, str(tmp_path)).collect()
    assert len(broken) == 1 and "h3" in broken[0].text


def test_both_layouts_give_the_same_books(spark, tmp_path):
    tree = [(0, "a", 1, 2), (1, 'b"', 3, 4), (2, "c", 5, 6), (1, "d", 0, 0), (0, "e", 7, 8)]
    rows = [("f", f"{k}.fb2", f"i{k}", "h", "T\n'\"", ("o", "p") if k % 2 else None, ("c", "1") if k % 3 else None, [("1", "z", None)] * (k % 3), tree[: k % 6], "s", [(k, "w")], ["p"]) for k in range(12)]
    schema = f"folder string, {hash_store.COLUMNS}, source string, histogram array<struct<count:long,word:string>>, annotation array<string>"
    books_ = spark.createDataFrame(rows, schema)
    hash_store.write(books_.drop("source", "histogram", "annotation"), str(tmp_path / "one"))
    hash_store.write_books(books_, str(tmp_path / "two"))
    columns = ["folder", "file", "id", "hash", "title", "origin", "cover", "images", "sections"]
    one, two = (sorted(map(str, df.select(columns).collect())) for df in (hash_store.read(spark, str(tmp_path / "one")), hash_store.read_books(spark, str(tmp_path / "two"))))
    assert one == two == sorted(map(str, books_.select(columns).collect()))


def test_a_doubled_row_does_not_hide_a_lost_one(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "k long, t string")
    read = type(spark.read).load

    def other(reader, path, **options):
        return read(reader, path, **options).where("k <> 2").unionByName(read(reader, path, **options).where("k = 1"))

    monkeypatch.setattr(type(spark.read), "load", other)
    with pytest.raises(OSError):
        published.write_checked(rows, str(tmp_path / "x"))


def test_epub_as_files(spark):
    twins = EPUB | {"O/p.opf": EPUB["O/p.opf"].replace('<item id="i"', '<item id="j" href="j.png" media-type="image/png"/><item id="i"'), "O/j.png": EPUB["O/i.png"]}
    rows = spark.createDataFrame([("b", zipped(twins)), ("none", b"no")], "book string, body binary")
    got = {(r.book, r.kind, r.path): bytes(r.content) for r in books.epub_files(rows, "book").collect()}
    index = json.loads(got.pop(("b", "index", "b/index.json")))
    assert index == [{"id": "O/c.jpg", "num": "cover"}, {"id": "O/i.png", "num": "0"}, {"id": "O/j.png", "num": "0"}]
    assert got == {("b", "text", "b/O/t.xhtml"): b"<html><p>two words</p></html>", ("b", "image", "b/cover"): b"\xff\xd8", ("b", "image", "b/0"): b"\x89PNG"}


def test_book_is_read_in_one_pass(spark):
    """One worker holds a book, not one for each of its encoding, its text and its repair; tables are read in small batches."""
    from bookloom.plans import files, registry

    plan = files.book_text(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    spark.conf.unset(registry.BATCH)
    files.page_books(spark, "/root/testdata/sf0.001")
    assert int(spark.conf.get(registry.BATCH)) <= 4 << 20


def test_tails_are_closed_as_by_the_column(spark):
    from bookloom.sources import markup

    texts = ["<FictionBook>a</FictionBook>rest</FictionBook>", "a<binary>b<binary>c", "<body>x</body>y</body>z", "<body>x</body><binary", "none", "", "é<body></body>ü", "<binary>"]
    got = spark.createDataFrame([(x,) for x in texts], "t string").select("t", markup.repair_tail(F.col("t")).alias("r")).collect()
    assert [r.r for r in got] == [markup.closed(r.t) for r in got]
