"""Plans that publish."""

from __future__ import annotations

from pyspark.sql import functions as F

from bookloom.functions import text as tx
from bookloom.operators import faq, publish
from bookloom.plans.catalogue import series_links
from bookloom.plans.registry import query, table

LINE = """SELECT o_orderkey, concat_ws(chr(4), '', '', o_orderpriority, '', '', CAST(o_orderkey AS VARCHAR), CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR), CAST(o_orderkey AS VARCHAR),
  CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END, 'fb2', strftime(o_orderdate, '%Y-%m-%d'), '', 'en', '', '', CAST(year(o_orderdate) AS VARCHAR), 'lib') || chr(4) || chr(13) || chr(10) AS line FROM orders"""


def lines(spark, sf_dir):
    none, c = F.lit(None), F.col
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        publish.index_line(none, none, c("o_orderpriority"), none, none, c("o_orderkey"), F.floor("o_totalprice"), c("o_orderkey"), F.when(c("o_orderstatus") == "F", 1).otherwise(0), F.lit("fb2"), F.date_format("o_orderdate", "yyyy-MM-dd"), none, F.lit("en"), none, none, F.year("o_orderdate"), F.lit("lib")).alias("line"),
    )


@query("index_lines", LINE)
def index_lines(spark, sf_dir):
    return lines(spark, sf_dir)


@query("index_roundtrip", "SELECT o_orderkey, o_orderpriority AS title, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS size, CAST(year(o_orderdate) AS VARCHAR) AS year, CAST(NULL AS VARCHAR) AS keywords, 'lib' AS sourcelib FROM orders")
def index_roundtrip(spark, sf_dir):
    parsed = lines(spark, sf_dir).select("o_orderkey", *publish.index_fields(F.col("line")))
    return parsed.select("o_orderkey", "title", "size", "year", "keywords", "sourcelib")


@query("series_topk", """WITH s AS (SELECT l_orderkey AS book_id, CASE WHEN p_size < 5 THEN '' ELSE p_brand END AS title, l_suppkey % 10 AS number, l_linenumber % 2 AS type, p_size AS level FROM lineitem JOIN part ON p_partkey = l_partkey),
 u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY book_id, title ORDER BY type, level DESC, number) AS rn FROM s) WHERE rn = 1),
 n AS (SELECT *, count(CASE WHEN title <> '' THEN 1 END) OVER (PARTITION BY book_id) AS named FROM u),
 o AS (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY level, title, number) AS at2 FROM n WHERE title <> '' OR named = 0)
SELECT book_id, string_agg(title || '#' || number, '|' ORDER BY at2) AS series FROM o WHERE at2 <= 2 GROUP BY 1""")
def series_topk(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("book_id"), F.when(F.col("p_size") < 5, "").otherwise(F.col("p_brand")).alias("title"), (F.col("l_suppkey") % 10).alias("number"), (F.col("l_linenumber") % 2).alias("type"), F.col("p_size").alias("level"))
    out = publish.series_of_book(rows, "book_id", 2)
    return out.select("book_id", F.array_join(F.transform("series", lambda s: F.concat(s["title"], F.lit("#"), s["number"].cast("string"))), "|").alias("series"))


CONTENTS = r"""SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY CASE WHEN source = 'src0' THEN '￿' ELSE source END, doc_id) AS place,
 concat_ws(chr(9), source, regexp_replace(text, '\s+', ' ', 'g'), CAST(doc_id AS VARCHAR)) AS line FROM documents"""


def contents(spark, sf_dir):
    text = F.regexp_replace("text", r"\s+", " ")
    author = tx.sort_text(F.when(F.col("source") != "src0", F.col("source")))
    line = F.concat_ws("\t", "source", text, F.col("doc_id").cast("string"))
    return publish.contents(table(spark, sf_dir, "documents"), "lang", [author, F.col("doc_id")], line)


@query("contents_by_lang", CONTENTS)
def contents_by_lang(spark, sf_dir):
    """Contents of each language, sorted by author, those without one last."""
    return contents(spark, sf_dir)


@query("contents_by_lang_whole", CONTENTS)
def contents_by_lang_whole(spark, sf_dir):
    """The same under its other name."""
    return contents(spark, sf_dir)


@query("book_contents", """WITH b AS (SELECT o_orderkey AS id, o_orderstatus AS lang, CASE WHEN o_custkey % 7 <> 0 THEN c_name END AS author, o_orderpriority AS title, CASE WHEN o_orderkey % 3 <> 0 THEN 'Set ' || o_orderkey % 5 END AS series, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey % 11 AS VARCHAR) END AS number FROM orders LEFT JOIN customer ON c_custkey = o_custkey)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY coalesce(lower(author), chr(65535)), coalesce(lower(series), chr(65535)), coalesce(CAST(number AS BIGINT), 2147483647), lower(title), id) AS place,
 coalesce(author, '') || chr(9) || title || chr(9) || CASE WHEN series IS NULL THEN '' ELSE '[' || series || CASE WHEN number IS NULL THEN '' ELSE ' #' || number END || ']' END || chr(9) || 'f' || id % 4 || chr(9) || id || '.fb2' AS line FROM b""")
def book_contents(spark, sf_dir):
    """Lines of books with author, title, series and file, sorted within each language."""
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"), "left")
    key = F.col("o_orderkey")
    author, title = F.when(F.col("o_custkey") % 7 != 0, F.col("c_name")), F.col("o_orderpriority")
    series = F.when(key % 3 != 0, F.concat(F.lit("Set "), (key % 5).cast("string")))
    number = F.when(key % 2 == 0, (key % 11).cast("string"))
    line = publish.contents_line(author, title, series, number, F.concat(F.lit("f"), (key % 4).cast("string")), F.concat(key.cast("string"), F.lit(".fb2")))
    return publish.contents(orders.withColumnRenamed("o_orderstatus", "lang"), "lang", [*publish.contents_keys(author, series, number, title), key], line)


@query("review_months", "SELECT DISTINCT CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month FROM events UNION SELECT DISTINCT CAST(year(o_orderdate) AS INT), CAST(month(o_orderdate) AS INT) FROM orders")
def review_months(spark, sf_dir):
    a = publish.months(table(spark, sf_dir, "events"), "ts")
    return a.union(publish.months(table(spark, sf_dir, "orders"), "o_orderdate")).distinct()


@query("reviews_of_month", """WITH m AS (SELECT date_trunc('month', min(ts)) AS m FROM events)
SELECT user_id % 20 AS book, count(DISTINCT (ts, user_id)) AS n, string_agg(DISTINCT strftime(ts, '%Y-%m-%d %H:%M:%S') || ' ' || user_id, '|' ORDER BY strftime(ts, '%Y-%m-%d %H:%M:%S') || ' ' || user_id) AS heads
FROM events, m WHERE ts >= m.m AND ts < m.m + INTERVAL 1 MONTH GROUP BY 1""")
def reviews_of_month(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    month = events.agg(F.date_trunc("month", F.min("ts")).cast("string").alias("m")).first()["m"]
    rows = events.select((F.col("user_id") % 20).alias("book"), F.col("ts").alias("time"), F.col("user_id").cast("string").alias("name"), F.coalesce("props", F.lit("")).alias("text"))
    made = publish.month_reviews(rows, month, ["book"])
    entry = F.from_json("reviews", "array<struct<time:string,name:string,text:string>>")
    heads = F.transform(entry, lambda x: F.concat_ws(" ", x["time"], x["name"]))
    return made.select("book", F.size(entry).cast("long").alias("n"), F.array_join(F.array_sort(F.array_distinct(heads)), "|").alias("heads"))


@query("rating_sums", "SELECT l_orderkey AS book_id, sum(l_quantity) AS rate_sum, count(*) AS rate_count FROM lineitem GROUP BY 1 HAVING sum(l_quantity) > 2.22e-16")
def rating_sums(spark, sf_dir):
    sums = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("book_id")).agg(F.sum("l_quantity").alias("rate_sum"), F.count(F.lit(1)).alias("rate_count"))
    return sums.where(F.col("rate_sum") > 2.22e-16)


PACKS = """SELECT doc_id // 100 AS bucket, md5(lower(source)) AS author_key, min_by(text, doc_id) AS body, string_agg(DISTINCT lang, '|' ORDER BY lang) AS files FROM documents GROUP BY 1, 2"""


def packs(spark, sf_dir, body):
    notes = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("nid"), F.col("source").alias("name"), body.alias("body"), F.col("lang").alias("file"))
    return publish.author_packs(notes, 100)


@query("author_packs", PACKS)
def author_packs(spark, sf_dir):
    return packs(spark, sf_dir, F.col("text"))


@query("author_packs_whole", PACKS)
def author_packs_whole(spark, sf_dir):
    """The same under its other name."""
    return packs(spark, sf_dir, F.col("text"))


@query("routed_reviews", """WITH e AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY md5(text)) AS root FROM documents)
SELECT root AS book_id, count(*) AS n FROM events JOIN e ON e.doc_id = user_id WHERE root % 3 <> 0 GROUP BY 1""")
def routed_reviews(spark, sf_dir):
    """Reviews follow their book to its last origin; only published books keep them."""
    from bookloom.plans.resolution import dup_closure

    docs = table(spark, sf_dir, "documents")
    reviews = table(spark, sf_dir, "events").select(F.col("user_id").alias("book_id")).join(docs.select(F.col("doc_id").alias("book_id")), "book_id", "left_semi")
    moved = publish.route_reviews(reviews, dup_closure(spark, sf_dir), docs.select(F.col("doc_id").alias("book_id")).where("book_id % 3 <> 0"))
    return moved.groupBy("book_id").agg(F.count(F.lit(1)).alias("n"))


@query("genre_localise", """WITH d(code, text) AS (VALUES ('ECONOMY', 'Cheap'), ('PROMO', 'Offers'), ('STANDARD', 'Plain')) SELECT p_partkey, p_type, coalesce(text, p_type) AS label FROM part LEFT JOIN d ON code = p_type""")
def genre_localise(spark, sf_dir):
    names = spark.createDataFrame([("ECONOMY", "Cheap"), ("PROMO", "Offers"), ("STANDARD", "Plain")], "code string, text string")
    return table(spark, sf_dir, "part").join(F.broadcast(names), F.col("p_type") == F.col("code"), "left").select("p_partkey", "p_type", F.coalesce("text", "p_type").alias("label"))


@query("faq_validate", r"""WITH u AS (SELECT conv_id, turn // 2 AS row, text FROM conversations WHERE role = 'user'), a AS (SELECT conv_id, turn // 2 AS row, text FROM conversations WHERE role = 'assistant'),
 j AS (SELECT coalesce(u.conv_id, a.conv_id) AS conv_id, coalesce(u.row, a.row) AS row, u.text AS q, a.text AS t FROM u FULL JOIN a ON u.conv_id = a.conv_id AND u.row = a.row),
 v AS (SELECT conv_id, row, CASE WHEN coalesce(trim(q), '') = '' OR coalesce(trim(t), '') = '' THEN 'missing' WHEN len(string_split(q, chr(10))) <> len(string_split(t, chr(10))) THEN 'lines differ' END AS problem FROM j)
SELECT problem, count(*) AS n FROM v WHERE problem IS NOT NULL GROUP BY 1""")
def faq_validate(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").withColumn("row", F.expr("turn div 2"))
    pick = lambda role: turns.where(F.col("role") == role).select("conv_id", "row", "text")
    both = faq.align(pick("user"), pick("assistant"), ["conv_id", "row"], ("question", "answer"))
    return faq.violations(both, ["conv_id", "row"], ("question", "answer")).groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


@query("faq_render", """SELECT n_nationkey, '<h2>' || n_name || '</h2>' || replace(replace('Region LIB number ' || CAST(n_regionkey AS VARCHAR) || ' [b]x[/b]', 'LIB', 'Library'), '[b]x[/b]', '<b>x</b>') AS html FROM nation""")
def faq_render(spark, sf_dir):
    answer = F.concat(F.lit("Region LIB number "), F.col("n_regionkey").cast("string"), F.lit(" [b]x[/b]"))
    return table(spark, sf_dir, "nation").select("n_nationkey", faq.render(F.col("n_name"), answer, {"LIB": "Library"}, [(r"\[b\](.*?)\[/b\]", "<b>$1</b>")]).alias("html"))


@query("faq_paths", "SELECT n_nationkey, CAST(n_regionkey AS VARCHAR) || '/' || CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) - 1 AS VARCHAR) AS path FROM nation")
def faq_paths(spark, sf_dir):
    rows = faq.renumbered(table(spark, sf_dir, "nation"), "n_regionkey", ["n_name"])
    return rows.select("n_nationkey", F.concat_ws("/", F.col("n_regionkey").cast("string"), F.col("row").cast("string")).alias("path"))


@query("json_export", """SELECT o_custkey, count(*) AS n, max(o_orderkey) AS last_book, '[' || string_agg('{"book":' || o_orderkey || ',"title":"' || o_orderpriority || '"}', ',' ORDER BY o_orderkey) || ']' AS json FROM orders GROUP BY 1""")
def json_export(spark, sf_dir):
    """Rows as one JSON array per reader, and read back from it."""
    entry = F.struct(F.col("o_orderkey").alias("book"), F.col("o_orderpriority").alias("title"))
    made = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("json"))
    back = F.from_json("json", "array<struct<book:long,title:string>>")
    return made.select("o_custkey", F.size(back).cast("long").alias("n"), F.array_max(F.transform(back, lambda x: x["book"])).alias("last_book"), "json")


@query("series_published", """SELECT p_brand AS series, count(*) AS n, count(DISTINCT l_orderkey) AS books FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber = 1 GROUP BY 1""")
def series_published(spark, sf_dir):
    """Each published series with its links and books."""
    return series_links(spark, sf_dir).groupBy("series").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("book_id").alias("books"))
