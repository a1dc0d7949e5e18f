"""Listings, file names, first rows, origins by library, and the carried list of what is ready."""

import zipfile

import pytest
from pyspark.sql import functions as F

from bookloom.functions import text as tx
from bookloom.operators import catalogue, compilation, faq_tree, resolve
from bookloom.sources import archive
from bookloom.streaming import incremental


def test_listing(spark, tmp_path):
    for folder in ("z", "h", "none"):
        (tmp_path / folder).mkdir()
    for name in ("fb2-000100.zip", "fb2-000200.zip", "x.zip"):
        with zipfile.ZipFile(tmp_path / "z" / name, "w") as z:
            z.writestr("a.fb2", "abc")
            z.writestr("b.fb2", name)
        (tmp_path / "h" / name.replace(".zip", ".xml")).write_text("x")
    got = archive.listing(spark, str(tmp_path / "z"), hashes=str(tmp_path / "h")).collect()
    assert [r.number for r in got] == [200, 100, 0] and got[0].hash.endswith("fb2-000200.xml")
    (tmp_path / "h" / "x.xml").unlink()
    with pytest.raises(FileNotFoundError, match="x.zip"):
        archive.listing(spark, str(tmp_path / "z"), hashes=str(tmp_path / "h"))
    with pytest.raises(FileNotFoundError):
        archive.listing(spark, str(tmp_path / "none"))
    total = archive.totals(archive.entries(spark, str(tmp_path / "z"))).first()
    assert (total.archives, total.entries, total.bytes) == (3, 6, 9 + 14 + 14 + 5)


def test_first_row_and_file_names(spark):
    rows = spark.createDataFrame([("k", 2, "late", "S", 1, 0, 1.0), ("k", 1, "early", "T", 2, 0, 2.0)], "key string, n int, name string, series string, number int, type int, level double")
    got = catalogue.assemble(rows, ["key"], ["name"], "n").first()
    assert got["name"] == "early" and [s.title for s in got.series] == ["T", "S"]


def test_edges_by_library(spark):
    edges = spark.createDataFrame([(1, "f#a", "s", "7.fb2"), (2, "f#zz", "s", "7.fb2"), (3, "f#zz", "s", "8.fb2")], "dup int, uid string, source string, file string")
    look = lambda *rows: spark.createDataFrame(list(rows), "key string, book int")
    assert {tuple(r) for r in resolve.edges_to_books(edges, look(("f#a", 10)), look(("s_7", 11))).collect()} == {(1, 10), (2, 11)}


def test_long_chains_have_short_plans(spark):
    edges = spark.createDataFrame([(i, i - 1) for i in range(1, 65)], "dup long, origin long")
    out = resolve.roots(edges)
    assert out._jdf.queryExecution().analyzed().collectLeaves().size() <= 4 and out.where("root <> 0").count() == 0


def test_titles(spark):
    row = spark.range(1).select(tx.candidate_tokens(F.lit("СИ книга Си two")).alias("x")).first()
    assert row.x == ["two", "книга"]


def test_ready_stream(spark, tmp_path):
    spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "name string").coalesce(1).write.parquet(f"{tmp_path}/in")
    ready = spark.createDataFrame([("a",)], "name string")
    source = spark.readStream.schema("name string").parquet(f"{tmp_path}/in")
    for _ in range(2):  # the second run finds nothing new
        q = incremental.unready(source, ready).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
        q.awaitTermination()
    assert sorted(r.name for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["b", "c"]


def test_compilation_tree(spark):
    # doc, own, ord, depth, section, size
    rows = [(1, "own", 1, 0, "own", 500), (1, "own", 2, 1, "A", 300), (1, "own", 3, 2, "B", 200), (1, "own", 4, 1, "B", 200), (1, "own", 5, 1, "u", 300), (1, "own", 6, 2, "C", 200), (1, "own", 7, 1, "x", 50), (1, "own", 8, 2, "D", 400), (2, "o2", 1, 0, "A", 300), (2, "o2", 2, 0, "B", 300), (2, "o2", 3, 0, "leaf", 300)]
    frame = spark.createDataFrame(rows, "doc int, own string, ord int, depth int, section string, size int")
    books = spark.createDataFrame([("A", 10), ("B", 11), ("B", 12), ("C", 13), ("D", 14), ("own", 1)], "section string, book int")
    assert sorted(map(tuple, compilation.tree_compilations(frame, books).collect())) == [(1, "0:10,1:11,1:12,2:13", 3, True), (2, "0:10,1:11,1:12", 2, False)]


def test_macros_and_small_tree_functions(spark):
    macros = spark.createDataFrame([("A", "en", "x"), ("A", "ru", "y"), ("B", "en", "z")], "name string, language string, value string")
    new = faq_tree.set_macros(macros, "en", "A=1=2\nnothing\n=bad\nC=c\nB=")
    assert {tuple(r) for r in new.collect()} == {("A", "en", "1=2"), ("A", "ru", "y"), ("C", "en", "c")}
    assert faq_tree.macro_lines(new, "en").first().text == "A=1=2\nC=c" and faq_tree.macro_lines(new, "ru").first().text == "A=y\nC="
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(faq_tree.line_of_argument(F.lit("a\nb %2 c\n%1"), F.lit(1))) == 2 and one(faq_tree.line_of_argument(F.lit("a"), F.lit(1))) == -1
    assert [one(faq_tree.output_name(F.lit("d/q.en.json"), F.lit(n), F.lit(e))) for n, e in (("f.x", "y"), ("", "txt"), (None, None))] == ["f.x", "q.en.txt", "q.en.html"]
    assert one(faq_tree.images(F.lit("t [img a b c] x\nno\n[img d e f]"))) == ["img/a/b.jpg", "img/d/e.jpg"]
    assert one(faq_tree.as_value(F.lit('a"b'))) == '"a\\"b"' and one(faq_tree.as_value(F.lit("a\nb"))) == '["a","b"]'
    languages = spark.createDataFrame([("un", "?", 0), ("en", "English", 2), ("ru", "Russian", 1), ("de", "German", 1)], "key string, title string, priority int")
    assert [r.key for r in faq_tree.languages_to_add(languages, spark.createDataFrame([("en",)], "key string")).collect()] == ["de", "ru"]
    tree = spark.createDataFrame([("en", [0], "q", "a"), ("ru", [0], "New item", ""), ("en", [0, 0], "r", "b")], "language string, path array<int>, question string, answer string")
    rows = faq_tree.aligned(tree, ["en", "ru"])
    assert faq_tree.incomplete(rows, ["en", "ru"], "New item").count() == 2 and faq_tree.incomplete(rows, ["en"], "New item").count() == 0
    with pytest.raises(Exception, match="language must be specified"):
        faq_tree.read_tree(spark.createDataFrame([("f", "{}")], "file string, value string")).count()


def test_markers_are_filled_in_order(spark):
    fill = lambda text, lines: spark.createDataFrame([(text, lines)], "t string, l array<string>").select(faq_tree.filled(F.col("t"), F.col("l")).alias("x")).first().x
    assert fill("%2 %1 %10 %1 100%", ["a%2", "b$1\\", "c"]) == "b$1\\ a%2 c a%2 100%"
    assert fill("%3 %7", ["x"]) == "x %7" and fill("none", ["x"]) == "none" and fill("%1", []) == "%1" and fill("", ["x"]) == ""


def test_export_of_a_deep_tree(spark):
    rows = [("en", [0], "Q0", "a\nb"), ("en", [0, 0], "Q00", "c"), ("en", [0, 0, 0], "Q000", None), ("en", [1], "Q1", "d"), ("de", [0], "F0", "x"),
            ("template", [0], "main", "%1-%2 [q0] [q5]"), ("template", [0, 0], "sub", "[b]%1[/b][q0]"), ("template", [0, 0, 0], "sub", "deep"), ("template", [1], "other", "%1")]
    tree = spark.createDataFrame(rows, "language string, path array<int>, question string, answer string")
    got = {r.language: r.html for r in faq_tree.exported(tree, {"main": ("<#QUESTION#>", "."), "sub": ("(", "#QUESTION#)")}, [(r"\[(/?b)\]", "<$1>")]).collect()}
    assert got == {"en": "<Q0>a-b (<b>c</b>(deepQ000)Q00) [q5].", "de": "<F0>x-%2 [q0] [q5]."}
    assert faq_tree.exported(tree.where("false"), {"main": ("", "")}, []).count() == 0


def test_pictures_encoded_twice(spark):
    import base64

    from bookloom.sources import markup

    png = b"\x89PNG\r\n\x1a\n"
    twice = base64.b64encode(base64.b64encode(png)).decode()
    rows = spark.createDataFrame([(1, f'<FictionBook><binary id="a">{twice}</binary><binary id="b">!</binary></FictionBook>'.encode())], "id int, body binary")
    assert [(r.binary_id, None if r.content is None else bytes(r.content), r.error is None) for r in markup.binaries(rows).collect()] == [("a", png, True), ("b", None, False)]


def test_a_bucket_of_packs_is_one_file(spark, tmp_path):
    from bookloom.sinks import published

    rows = spark.range(400).selectExpr("id % 20 AS bucket", "CAST(id AS STRING) AS author_key", "'b' AS body", "'f' AS files").repartition(8, "author_key")
    published.write_packs(rows, str(tmp_path / "packs"))
    assert len(list((tmp_path / "packs").glob("*/*.parquet"))) == 20
    assert spark.read.parquet(str(tmp_path / "packs")).count() == 400


def test_fingerprints_are_written_in_small_batches(spark):
    """Documents of many lines pass a worker about 4 MB at a time."""
    from bookloom.plans import registry, stores

    spark.conf.unset(registry.BATCH)
    stores.fingerprints(spark, "/root/testdata/sf0.001")
    assert int(spark.conf.get(registry.BATCH)) <= 4 << 20


def test_writers_of_fingerprints_hold_few_books_at_once(spark, tmp_path, monkeypatch):
    """Of a batch, a few books are Python objects at a time, and both layouts are as they were."""
    import pyarrow as pa

    from bookloom.sources import hash_store

    batch = pa.RecordBatch.from_pylist([{"folder": "a", "sections": [{"depth": 0, "id": str(k), "count": None, "size": 1}]} for k in range(1000)])
    parts = list(hash_store._few(iter([batch, batch])))
    assert max(map(len, parts)) <= 64
    assert [x["sections"][0]["id"] for part in parts for x in part] == [str(k) for k in range(1000)] * 2
    assert parts[0][0]["sections"][0]["count"] is None
