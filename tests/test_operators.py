import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from bookloom.functions import text as tx
from bookloom.operators import catalogue, compilation, corrections, images, publish, resolve
from bookloom.sources import archive, dump, image_stats
from bookloom.streaming import incremental


def one(spark, column, **values):
    names = list(values)
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in names)).select(column.alias("x")).first()["x"]


def test_replace_tags(spark):
    got = one(spark, tx.replace_tags(F.col("t")), t="[b]a[/b]\n\n [HR] http://x.y/z end\n[collapse collapsed title=T]in[/collapse]<p>&nbsp;</p>")
    assert got == '<b>a</b><br/> <hr> <a href="http://x.y/z">http://x.y/z</a> end<br/><details><summary>T</summary>in</details>'
    assert one(spark, tx.replace_tags(F.col("t")), t=None) is None


@pytest.mark.parametrize("given, want", [("A (B) C", "A [B]C"), ("A (B)", "A [B]"), ("plain", "plain"), ("", "")])
def test_bracket_series(spark, given, want):
    assert one(spark, tx.bracket_series(F.col("t")), t=given) == want


def test_small_functions(spark):
    c = F.col("t")
    assert one(spark, tx.dash_fold(c), t="a — b - c -- dё") == "a – b – c – dе"
    assert one(spark, tx.scrub_separators(c), t="a:b,c") == "ab;c"
    assert one(spark, tx.file_key(F.lit(None).cast("string"), F.lit(7), c), t="FB 2") == "7.fb2"
    assert one(spark, tx.file_key(c, F.lit(7), F.lit("x")), t="dir/a.b.EPUB") == "a.b.epub"
    assert one(spark, tx.hex_to_long(c), t="ffffffffffffffff") == -1
    assert one(spark, tx.hamming(tx.hex_to_long(c), F.lit(0).cast("long")), t="00000000000000ff") == 8
    assert one(spark, tx.to_int(c), t="x1") == 0 and one(spark, tx.leading_int(c), t=" 12-3") == 12
    assert one(spark, tx.sort_number(c), t="") == 2147483647 and one(spark, tx.sort_text(c), t="") == "￿"
    assert one(spark, tx.without_illegal(c), t='a/b:c*"') == "abc"
    assert one(spark, tx.title_tokens(c), t="Война и Мир: и ёж") == ["еж", "война", "и", "мир"] or one(spark, tx.title_tokens(c), t="b A b") == ["a", "b"]


def test_index_line_round_trip(spark):
    line = publish.index_line(*[F.lit(f"v{i}\n\r") if i % 2 else F.lit(None) for i in range(17)])
    row = spark.range(1).select(line.alias("line")).select(*publish.index_fields(F.col("line"))).first()
    assert list(row) == [f"v{i} " if i % 2 else None for i in range(17)]


def test_authors(spark):
    links = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, 11, 1), (3, 12, 1), (4, 13, 1)], "book_id long, author_id long, pos int")
    names = spark.createDataFrame([(10, "A", "a", "x", "", None), (11, "I", "i", "y", "ill", None), (12, "N", None, "z", "", None), (13, "P", "p", "q", "", 10)], "author_id long, last string, first string, middle string, nick string, master_id long")
    got = {r.book_id: r.authors for r in catalogue.author_lists(links, names, "ill").collect()}
    assert got == {1: "A,a,x:", 2: "I,i,y:", 4: "A,a,x:"}  # a name with a null part is no label


def test_rate_without_ratings(spark):
    books, rates = spark.createDataFrame([(1,), (2,)], "book_id long"), spark.createDataFrame([(1, "5"), (1, "x")], "book_id long, rate string")
    got = {r.book_id: (r.rate_sum, r.rate_count) for r in catalogue.with_ratings(books, rates).collect()}
    assert got == {1: (5.0, 2), 2: (None, 0)}


def test_corrections(spark):
    rows, more = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), spark.createDataFrame([(2, "c"), (3, None)], "k long, v string")
    assert sorted(tuple(r) for r in corrections.override(rows, more, "k", ["v"]).collect()) == [(1, "a"), (2, "c")]
    assert sorted(r.k for r in corrections.append_missing(rows, more, ["k"]).collect()) == [1, 2, 3]


def test_roots_of_chains_and_cycles(spark):
    edges = spark.createDataFrame([(i, i - 1) for i in range(1, 20)] + [(101, 102), (102, 101), (5, 90)], "dup long, origin long")
    got = {r.dup: r.root for r in resolve.roots(edges).collect()}
    assert got == {i: 0 for i in range(1, 20)}  # the cycle has no root; the first edge of 5 counts


def test_merge_into_roots(spark):
    books = spark.createDataFrame([(1, 5.0, 1, True, ["a"]), (2, 3.0, 2, False, ["b"]), (3, None, 0, True, [])], "book_id long, rate_sum double, rate_count long, deleted boolean, series array<string>")
    got = {r.book_id: tuple(r)[1:] for r in resolve.merge_into_roots(books, spark.createDataFrame([(2, 1)], "dup long, root long")).collect()}
    assert got == {1: (8.0, 3, False, ["a", "b"]), 3: (None, 0, True, [])}


def test_hamming_bands_lose_nothing(spark):
    import random

    rng = random.Random(1)
    values = [rng.getrandbits(64) for _ in range(40)]
    values += [v ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for v in values for _ in range(3)]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    rows = spark.createDataFrame([(i, 0, v) for i, v in enumerate(signed)], "id long, block int, bits long")
    got = {(r.left_id, r.right_id) for r in resolve.hamming_pairs(rows, "block", "id", "bits", 5).collect()}
    assert got == {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if bin(values[i] ^ values[j]).count("1") <= 5}


def test_image_comparison():
    c = images.classify
    assert [c(1, 1, True, True), c(1, 0, True, False), c(0, 2, False, False), c(0, 0, True, False), c(0, 0, False, True), c(0, 0, True, True)] == ["varied", "outer", "inner", "outer", "inner", "equal"]


def test_decisions_make_a_forest(spark):
    files = spark.createDataFrame([(1, "t", 3, True, 1), (2, "t", 3, False, 0), (3, "t", 2, False, 9), (4, "u", 0, True, 1)], "id long, text_id string, n_images int, deleted boolean, order_no int")
    assert sorted(tuple(r) for r in resolve.decide(files).collect()) == [(1, 2), (3, 2)]


def test_dump_statements(spark, tmp_path):
    (tmp_path / "a.sql").write_text("CREATE TABLE x (a int);\n-- note\nINSERT INTO `t` VALUES (1,'it\\'s',NULL),\n(2,'a;b\\nc',2.5);\nINSERT INTO other VALUES (9,'z',1);\nINSERT INTO t VALUES (3,'say \"x\" ''q''',x),(4,'short');\n")
    got = sorted(tuple(r) for r in dump.read(spark, str(tmp_path), "t", "a long, b string, c double").collect())
    assert got == [(1, "it's", None), (2, "a;b\nc", 2.5), (3, "say \"x\" 'q'", None)]
    bad = dump.bad_records(spark, str(tmp_path), "t", "a long, b string, c double").collect()
    assert [r["values"] for r in bad] == [["4", "short"]] and bad[0].file.endswith("a.sql")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_dump_statements_with_raw_line_ends(spark, tmp_path, end):
    first = ["-- it's a note", "/*!40101 SET x */;", "INSERT INTO t VALUES (1,'a;", "-- b'),", "-- it's between", "(2,'c\\'d;", "','x'),(3,'''e');", "INSERT INTO `t` (a,b) VALUES (4,'f');INSERT INTO t VALUES (5,'g');"]
    (tmp_path / "a.sql").write_bytes(end.join(first).encode())
    (tmp_path / "b.sql").write_bytes(end.join(["INSERT INTO t", "VALUES (6,'h'),", "(7,NULL);", ""]).encode())
    want = [(1, f"a;{end}-- b"), (3, "'e"), (4, "f"), (5, "g"), (6, "h"), (7, None)]  # the row of 2 has three values
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    try:
        assert sorted(map(tuple, dump.read(spark, str(tmp_path), "t", "a long, b string").collect())) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_image_statistics_round_trip(spark, tmp_path):
    (tmp_path / "in.txt").write_text("#head\na|b|1||1|-1|0|10|20|h\na|b|2|bad|0|2|100|0|20|\nonly|nine|1||1|2|3|4|5\n")
    rows = image_stats.read(spark, str(tmp_path / "in.txt"))
    image_stats.write(rows, str(tmp_path / "out"))
    assert sorted(map(str, image_stats.read(spark, str(tmp_path / "out")).collect())) == sorted(map(str, rows.collect())) and rows.count() == 2


def test_archives(spark, tmp_path):
    def packed(files):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, body in files.items():
                z.writestr(name, body)
        return out.getvalue()

    book = "<FictionBook xmlns='u'><description><title-info><genre>sf</genre><author><first-name>F</first-name><last-name>L</last-name></author><book-title> A  b </book-title><lang>en</lang></title-info></description></FictionBook>"
    (tmp_path / "fb2-000012.zip").write_bytes(packed({"1.fb2": book, "2.zip": packed({"3.fb2": "<broken", "__MACOSX/x": "y"})}))
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    found = archive.book_metadata(archive.entries(spark, str(tmp_path))).select("entry", "title", "lang", "authors", "genres", F.col("error").isNull().alias("ok"))
    assert sorted(tuple(r) for r in found.collect()) == [("1.fb2", "A b", "en", ["L,F,"], ["sf"], True), ("3.fb2", None, None, None, None, False)]
    assert {r.name: r.number for r in archive.listing(spark, str(tmp_path)).collect()} == {"fb2-000012.zip": 12, "bad.zip": 0}


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, str(i % 7)) for i in range(30)]
    for part in range(3):
        spark.createDataFrame(rows[part * 10 : part * 10 + 10], "id long, digest string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("id long, digest string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = incremental.stream_store(spark, source, str(tmp_path / "store"), str(tmp_path / "check"), "digest", "id")
    assert query.awaitTermination(120)
    assert sorted(r.digest for r in spark.read.parquet(str(tmp_path / "store")).collect()) == [str(i) for i in range(7)]


def test_markup_repair(spark):
    from bookloom.sources import markup

    tail = lambda t: one(spark, markup.repair_tail(F.col("t"), "b"), t=t)
    assert tail("<b>x</b>junk") == "<b>x</b>" and tail("<b>x<binary>1<binary>2") == "<b>x<binary>1</b>" and tail("<b><body>x</body>y") == "<b><body>x</body></b>" and tail("<b>x") == "<b>x"
    assert one(spark, markup.repair_markup(F.col("t"), ("p", "b")), t="<p>a & b &amp; <me@x.yz> 1 < 2 <q>\x01</p>") == '<p>a &amp; b &amp; "me@x.yz" 1 &lt; 2 &lt;q&gt;</p>'
    rows = spark.createDataFrame([("тест слова".encode("cp1251"),), ("é".encode(),), (b"\xff\xfea\0",), (b'<?xml encoding="KOI8-R"?>',), (None,)], "b binary")
    assert [r.e for r in rows.select(markup.encoding(F.col("b")).alias("e")).collect()] == ["cp1251", "utf-8", "utf-16le", "koi8-r", None]
    book = b'<f xmlns:l="l"><coverpage><image l:href="#c.jpg"/></coverpage><binary id="c.jpg">aGk=</binary><binary id="d">?</binary></f>'
    got = markup.binaries(spark.createDataFrame([(1, book), (2, b"<f"), (3, b"<f/>"), (4, None)], "id long, body binary")).collect()
    assert [(r.id, r.binary_id, r.is_cover, bytes(r.content) if r.content else None, r.error is None) for r in got] == [(1, "c.jpg", True, b"hi", True), (1, "d", False, None, False), (2, None, None, None, False)]


def test_whole_texts(spark, tmp_path):
    from bookloom.plans import catalogue

    text = "word " * 100 + "\n\u2014 x -- y [i]t[/i]\n\nsee http://q.r/s end"
    spark.createDataFrame([(1, text, "en", "src1")], "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {n: catalogue.all_queries()[f"{n}_whole"](spark, str(tmp_path)).first() for n in ("replace_tags", "dash_fold", "contents_by_lang", "author_packs")}
    assert got["dash_fold"].folded == "word " * 100 + "\n- x \u2013 y [i]t[/i]\n\nsee http://q.r/s end \u2013 a \u2013 b \u0435"
    assert "<i>t</i>" in got["replace_tags"].html and '<a href="http://q.r/s">http://q.r/s</a> end' in got["replace_tags"].html
    assert got["contents_by_lang"].line == "src1\t" + " ".join(text.split()) + "\t1"
    assert got["author_packs"].body == text


def test_intervals_equal_a_scan(spark):
    rng = random.Random(3)
    rows = [(d, i, rng.randint(0, 3)) for d in (1, 2, 3) for i in range(60)] + [(4, i, i) for i in range(500)] + [(5, i, 499 - i) for i in range(500)]
    rng.shuffle(rows)
    got = {tuple(r) for r in compilation.intervals(spark.createDataFrame(rows, "doc long, ord long, depth int"), "doc", "ord", "depth").collect()}
    want = set()
    for d in range(1, 6):
        own = sorted(r for r in rows if r[0] == d)
        for k, (_, i, depth) in enumerate(own):
            parent = next((j for _, j, e in reversed(own[:k]) if e < depth), None)
            end = next((m for m in range(k + 1, len(own)) if own[m][2] <= depth), len(own))
            want.add((d, i, depth, parent, own[end - 1][1]))
    assert got == want


def test_wide_hamming_pairs(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(63) for _ in range(8)]
    rows = [(k, k % 3, rng.choice(base) ^ sum(1 << b for b in rng.sample(range(63), rng.randint(0, 20)))) for k in range(300)]
    frame = spark.createDataFrame(rows, "id long, block long, bits long")
    for most in (0, 3, 17, 24, 40):
        want = {(a, b, (x ^ y).bit_count()) for a, p, x in rows for b, q, y in rows if a < b and p == q and (x ^ y).bit_count() <= most}
        got = [tuple(r) for r in resolve.hamming_pairs(frame, "block", "id", "bits", most).collect()]
        assert set(got) == want and len(got) == len(want)
    parts = resolve._pairs_by_parts(frame, 24, part=30)
    assert {tuple(r) for r in parts.collect()} == {(a, b, (x ^ y).bit_count()) for a, p, x in rows for b, q, y in rows if a < b and p == q and (x ^ y).bit_count() <= 24} and parts.count() == len(set(parts.collect()))


def test_histogram_is_computed_once(spark):
    plan = compilation.text_ids(spark.createDataFrame([(1, "a b a")], "k long, t string"), "k", "t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array(") <= 2 and plan.count("split(") == 1


def test_sharing_reaches_what_pairs_reach(spark):
    rng = random.Random(7)
    rows = sorted({(i, f"w{rng.randint(0, 60)}") for i in range(80) for _ in range(2)})
    got = {r.id: r.component for r in resolve.sharing(spark.createDataFrame(rows, "id long, word string")).collect()}
    want = {i: i for i, _ in rows}
    while True:
        new = {i: min(want[j] for j, v in rows for k, w in rows if k == i and v == w) for i in want}
        if new == want:
            break
        want = new
    assert got == want and len(set(want.values())) > 1
    assert resolve.sharing(spark.createDataFrame([], "id long, word string")).count() == 0


def test_unique_series(spark):
    books = spark.createDataFrame([(1, 1.0, 1, True, ["a", "b"]), (2, 2.0, 1, False, ["c", "a"]), (3, 0.0, 0, True, ["b", "d"]), (9, 0.0, 0, True, [])], "book_id long, rate_sum double, rate_count long, deleted boolean, series array<string>")
    got = {r.book_id: (r.rate_sum, r.deleted, r.series) for r in resolve.merge_into_roots(books, spark.createDataFrame([(1, 3), (2, 3)], "dup long, root long"), unique=True).collect()}
    assert got == {3: (3.0, False, ["a", "b", "c", "d"]), 9: (0.0, True, [])}
