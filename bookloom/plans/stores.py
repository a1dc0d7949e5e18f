"""Plans that write what is published or stored into files and read it back, and those from files to books."""

from __future__ import annotations

from pyspark.sql import functions as F

from bookloom.functions import text as tx
from bookloom.operators import compilation, entries, faq_tree, publish
from bookloom.plans.publication import CONTENTS, PACKS, contents, packs
from bookloom.plans.registry import query, table
from bookloom.sinks import published
from bookloom.sources import books, dialects, dump, hash_store
from bookloom.sources.shared import folder


@query("index_files", """WITH s AS (SELECT l_orderkey AS book_id, p_brand AS title, l_suppkey % 10 AS number, l_linenumber % 2 AS type, p_size AS level FROM lineitem JOIN part ON p_partkey = l_partkey),
 u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY book_id, title ORDER BY type, level DESC, number) AS rn FROM s) WHERE rn = 1),
 o AS (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY level, title, number) AS nth FROM u)
SELECT 'archive-' || o_orderkey % 7 AS folder, CAST(o_orderkey AS VARCHAR) AS libid, o_orderpriority AS title, o.title AS series, CAST(number AS VARCHAR) AS serno, 'en' AS lang FROM o JOIN orders ON o_orderkey = book_id WHERE nth <= 2""")
def index_files(spark, sf_dir):
    """The catalogue as folders of index lines, one line per series, read back."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("book_id"), F.col("p_brand").alias("title"), (F.col("l_suppkey") % 10).alias("number"), (F.col("l_linenumber") % 2).alias("type"), F.col("p_size").alias("level"))
    series = publish.series_of_book(rows, "book_id", 2)
    orders = table(spark, sf_dir, "orders").join(series, F.col("o_orderkey") == F.col("book_id"))
    own = orders.withColumns({"folder": F.concat(F.lit("archive-"), (F.col("o_orderkey") % 7).cast("string")), "place": F.col("o_orderkey")})
    c, none = F.col, F.lit(None)
    fields = [none, none, c("o_orderpriority"), c("series_title"), c("series_number"), c("o_orderkey"), none, c("o_orderkey"), none, none, none, none, F.lit("en"), none, none, none, none]
    at = folder(spark)
    published.write_index(published.series_lines(own, fields), at, "Orders", "20200101")
    return published.read_index(spark, at).select("folder", "libid", "title", "series", "serno", "lang")


@query("contents_files", f"SELECT lang, md5(line) AS digest FROM ({CONTENTS})")
def contents_files(spark, sf_dir):
    """Each language's contents as a folder of lines."""
    at = folder(spark)
    published.write_contents(contents(spark, sf_dir), at)
    return spark.read.text(at).select("lang", F.md5(F.col("value").cast("binary")).alias("digest"))


@query("review_files", """WITH r AS (SELECT strftime(ts, '%Y%m') AS month, user_id % 20 AS book, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, ts, CAST(user_id AS VARCHAR) AS name, min(coalesce(props, '')) AS text FROM events GROUP BY 1, 2, 3, 4, 5)
SELECT month, book, count(*) AS n, md5(string_agg(time || ' ' || name || ' ' || text, '|' ORDER BY time, name, text)) AS digest FROM r GROUP BY 1, 2""")
def review_files(spark, sf_dir):
    """Reviews as a folder of JSON documents per month, one per book."""
    rows = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyyMM").alias("month"), (F.col("user_id") % 20).alias("book"), F.col("ts").alias("time"), F.col("user_id").cast("string").alias("name"), F.coalesce("props", F.lit("")).alias("text"))
    first = rows.groupBy("month", "book", "time", "name").agg(F.min("text").alias("text"))
    entry = F.struct(F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"), "name", "text")
    at = folder(spark)
    published.write_reviews(first.groupBy("month", "book").agg(F.array_sort(F.collect_list(entry)).alias("reviews")), at)
    told = F.array_join(F.transform("reviews", lambda r: F.concat_ws(" ", r["time"], r["name"], r["text"])), "|")
    return spark.read.schema("book long, reviews array<struct<time:string,name:string,text:string>>, month string").json(at).select("month", "book", F.size("reviews").cast("long").alias("n"), F.md5(told.cast("binary")).alias("digest"))


@query("rating_files", "SELECT l_orderkey AS book, sum(l_quantity) AS total, count(*) AS n FROM lineitem GROUP BY 1 HAVING sum(l_quantity) > 2.22e-16")
def rating_files(spark, sf_dir):
    sums = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("book")).agg(F.sum("l_quantity").alias("total"), F.count(F.lit(1)).alias("n")).where("total > 2.22e-16")
    at = folder(spark)
    published.write_json(sums, at)
    return spark.read.schema("book long, total double, n long").json(at)


@query("annotation_files", "SELECT 'archive-' || page_id % 5 AS folder, CAST(page_id AS VARCHAR) || '.fb2' AS file, md5(trim(regexp_replace('Note & \"' || url || '\" <' || page_id || '>', '\\s+', ' ', 'g'))) AS digest FROM pages")
def annotation_files(spark, sf_dir):
    """Annotations as XML lines in a folder per archive."""
    note = F.concat(F.lit('Note & "'), "url", F.lit('" <'), F.col("page_id").cast("string"), F.lit(">"))
    rows = table(spark, sf_dir, "pages").select(F.concat(F.lit("archive-"), (F.col("page_id") % 5).cast("string")).alias("folder"), F.concat(F.col("page_id").cast("string"), F.lit(".fb2")).alias("file"), note.alias("annotation"))
    at = folder(spark)
    published.write_annotations(rows, at)
    return published.read_annotations(spark, at).select("folder", "file", F.md5(tx.simplified(F.col("annotation")).cast("binary")).alias("digest"))


@query("pack_files", f"SELECT CAST(bucket AS INT) AS bucket, author_key, md5(body) AS digest, files FROM ({PACKS})")
def pack_files(spark, sf_dir):
    """Author packs as a folder per bucket."""
    at = folder(spark)
    published.write_packs(packs(spark, sf_dir, F.col("text")), at)
    return spark.read.schema("author_key string, body string, files string, bucket long").parquet(at).select(F.col("bucket").cast("int").alias("bucket"), "author_key", F.md5(F.col("body").cast("binary")).alias("digest"), "files")


@query("table_files", "SELECT c_nationkey, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer GROUP BY 1")
def table_files(spark, sf_dir):
    """Tables written in parts that readers look up by, with a check of what was written."""
    at = folder(spark)
    published.write_checked(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey"), at, partition="c_nationkey")
    return spark.read.parquet(at).groupBy(F.col("c_nationkey").cast("int").alias("c_nationkey")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"))


STORE = r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
 s AS (SELECT doc_id, count(*) AS sections, CAST(sum(length(line)) AS BIGINT) AS size, md5(string_agg(i % 3 || ' ' || md5(line) || ' ' || len(string_split(line, ' ')), ',' ORDER BY i)) AS tree FROM l GROUP BY 1)
SELECT 'archive-' || doc_id % 4 AS folder, doc_id || '.fb2' AS file, md5(lower(text)) AS id, md5(text) AS hash, lang AS title, CASE WHEN doc_id % 5 = 0 THEN 'archive-0/' || doc_id // 2 || '.fb2' END AS origin, CASE WHEN doc_id % 2 = 0 THEN md5(source) END AS cover,
 sections, size, tree, array_to_string(list_transform(range(doc_id % 3), lambda i: 'image ' || i || ' 00ff'), ',') AS images FROM documents JOIN s USING (doc_id)"""


def fingerprints(spark, sf_dir):
    """Documents as books of the store, their lines as sections of three depths."""
    key = F.col("doc_id")
    section = F.transform(F.split("text", "\n"), lambda x, i: F.struct((i % 3).cast("int").alias("depth"), F.md5(x.cast("binary")).alias("id"), F.size(F.split(x, " ")).cast("long").alias("count"), F.char_length(x).cast("long").alias("size")))
    pictures = F.transform(F.slice(F.array(F.lit("0"), F.lit("1")), F.lit(1), (key % 3).cast("int")), lambda x: F.struct(x.alias("id"), F.lit("image").alias("hash"), F.lit("00ff").alias("phash")))
    origin = F.when(key % 5 == 0, F.struct(F.lit("archive-0").alias("folder"), F.concat(F.expr("doc_id div 2").cast("string"), F.lit(".fb2")).alias("file")))
    cover = F.when(key % 2 == 0, F.struct(F.md5(F.col("source").cast("binary")).alias("hash"), F.lit("1f").alias("phash")))
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("archive-"), (key % 4).cast("string")).alias("folder"), F.concat(key.cast("string"), F.lit(".fb2")).alias("file"), F.md5(F.lower("text").cast("binary")).alias("id"), F.md5(F.col("text").cast("binary")).alias("hash"), F.col("lang").alias("title"),
        origin.alias("origin"), cover.alias("cover"), pictures.alias("images"), section.alias("sections"), F.col("text"))


def told():
    """What a store gives back of each book: its parts, and a digest of the tree with depths and ids."""
    size = F.aggregate("sections", F.lit(0).cast("long"), lambda n, s: n + s["size"])
    tree = F.array_join(F.transform("sections", lambda s: F.concat_ws(" ", s["depth"].cast("string"), s["id"], s["count"].cast("string"))), ",")
    pictures = F.array_join(F.transform("images", lambda i: F.concat_ws(" ", i["hash"], i["id"], i["phash"])), ",")
    return ["folder", "file", "id", "hash", "title", F.when(F.col("origin").isNotNull(), F.concat_ws("/", "origin.folder", "origin.file")).alias("origin"), F.col("cover.hash").alias("cover"), F.size("sections").cast("long").alias("sections"), size.alias("size"), F.md5(tree.cast("binary")).alias("tree"), pictures.alias("images")]


@query("hash_store", STORE)
def hash_store_files(spark, sf_dir):
    """Fingerprints of documents, their lines as sections, written as a line per book in a folder per archive and read back."""
    at = folder(spark)
    hash_store.write(fingerprints(spark, sf_dir), at)
    return hash_store.read(spark, at).select(*told())


@query("hash_documents", STORE.replace("SELECT 'archive-'", "SELECT 'lib & \"x\"' AS source, md5(url) AS words, annotation, 'archive-'").replace("FROM documents JOIN s", "FROM (SELECT *, lang || ':' || len(string_split(text, ' ')) || ',<&>:1' AS url, md5(lang || chr(10) || '<' || source || '>') AS annotation FROM documents) documents JOIN s"))
def hash_documents(spark, sf_dir):
    """The same as XML documents of many books over many lines, with histogram and annotation."""
    at = folder(spark)
    words = F.array(F.struct(F.size(F.split("text", " ")).cast("long").alias("count"), F.col("title").alias("word")), F.struct(F.lit(1).cast("long").alias("count"), F.lit("<&>").alias("word")))
    note = table(spark, sf_dir, "documents").select(F.concat(F.col("doc_id").cast("string"), F.lit(".fb2")).alias("file"), F.array(F.col("lang"), F.concat(F.lit("<"), "source", F.lit(">"))).alias("annotation"))
    rows = fingerprints(spark, sf_dir).withColumns({"source": F.lit('lib & "x"'), "histogram": words}).join(note, "file")
    hash_store.write_books(rows, at)
    counted = F.array_join(F.transform("histogram", lambda w: F.concat_ws(":", w["word"], w["count"].cast("string"))), ",")
    return hash_store.read_books(spark, at).select("source", F.md5(counted.cast("binary")).alias("words"), F.md5(F.array_join("annotation", "\n").cast("binary")).alias("annotation"), *told())


@query("entry_cascade", """WITH e AS (SELECT o_orderkey AS k, 'f' || o_orderkey % 3 AS folder, CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey || '.zip' ELSE CAST(o_orderkey AS VARCHAR) END AS file, md5(CAST(o_custkey AS VARCHAR)) AS md5 FROM orders),
 u AS (SELECT 'f' || c_custkey % 3 || '#' || c_custkey AS key, c_custkey AS book FROM customer WHERE c_custkey % 2 = 0), d AS (SELECT md5(CAST(c_custkey AS VARCHAR)) AS key, c_custkey AS book FROM customer WHERE c_nationkey < 8), m AS (SELECT md5(CAST(c_custkey AS VARCHAR)) AS key, -c_custkey AS book FROM customer WHERE c_nationkey < 16)
SELECT e.folder, e.file, coalesce(a.book, b.book, c.book, m.book, p.book) AS book, CASE WHEN a.book IS NOT NULL THEN 1 WHEN b.book IS NOT NULL THEN 2 WHEN c.book IS NOT NULL THEN 3 WHEN m.book IS NOT NULL THEN 4 WHEN p.book IS NOT NULL THEN 5 ELSE 0 END AS matched
FROM e LEFT JOIN u a ON a.key = folder || '#' || file LEFT JOIN u b ON b.key = folder || '#' || regexp_replace(file, '\\.zip$', '') LEFT JOIN d c ON c.key = md5 LEFT JOIN m ON m.key = md5 LEFT JOIN (SELECT folder || '#' || file AS key, 0 AS book FROM e WHERE k % 5 = 0) p ON p.key = folder || '#' || file""".replace("\\\\", "\\"))
def entry_cascade(spark, sf_dir):
    """Archive entries to books: by uid, without .zip, by digest in a dictionary and in the dump, by parsing."""
    orders, people = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    name = F.col("o_orderkey").cast("string")
    found = orders.select(F.concat(F.lit("f"), (F.col("o_orderkey") % 3).cast("string")).alias("folder"), F.when(F.col("o_orderkey") % 4 == 0, F.concat(name, F.lit(".zip"))).otherwise(name).alias("file"), F.md5(F.col("o_custkey").cast("string").cast("binary")).alias("md5"), (F.col("o_orderkey") % 5 == 0).alias("parses"))
    key = F.md5(F.col("c_custkey").cast("string").cast("binary")).alias("key")
    by_uid = people.where("c_custkey % 2 = 0").select(entries.uid(F.concat(F.lit("f"), (F.col("c_custkey") % 3).cast("string")), F.col("c_custkey").cast("string")).alias("key"), F.col("c_custkey").alias("book"))
    parsed = found.where("parses").select(entries.uid(F.col("folder"), F.col("file")).alias("key"), F.lit(0).cast("long").alias("book"))
    out = entries.resolve_entries(found.drop("parses"), by_uid, people.where("c_nationkey < 8").select(key, F.col("c_custkey").alias("book")), people.where("c_nationkey < 16").select(key, (-F.col("c_custkey")).alias("book")), parsed)
    return out.select("folder", "file", "book", "matched")


@query("bound_files", """WITH f AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN page_id || '.fb2' ELSE page_id || '.copy.FB2' END AS file FROM pages), b AS (SELECT item_id || '.fb2' AS key, item_id AS book FROM benchmark)
SELECT file, coalesce(x.book, y.book) AS book, CASE WHEN x.book IS NOT NULL THEN 1 WHEN y.book IS NOT NULL THEN 2 ELSE 0 END AS matched FROM f LEFT JOIN b x ON x.key = file LEFT JOIN b y ON y.key = split_part(file, '.', 1) || '.fb2'""")
def bound_files(spark, sf_dir):
    """Files to books by name, or by the name's first part and suffix."""
    name = F.col("page_id").cast("string")
    files = table(spark, sf_dir, "pages").select(F.when(F.col("page_id") % 2 == 0, F.concat(name, F.lit(".fb2"))).otherwise(F.concat(name, F.lit(".copy.FB2"))).alias("file"))
    known = table(spark, sf_dir, "benchmark").select(F.concat(F.col("item_id").cast("string"), F.lit(".fb2")).alias("file_key"), F.col("item_id").alias("book"))
    return entries.bind(files, known)


@query("library_keys", """WITH b AS (SELECT o_orderkey AS book, 'lib' || o_orderkey % 2 AS source, CAST(o_custkey AS VARCHAR) AS libid, CASE WHEN o_orderkey % 3 = 0 THEN 'fb2-030560-060423.zip' ELSE 'other.zip' END AS folder FROM orders)
SELECT key, min(book) AS book FROM (SELECT source || '_' || libid AS key, book FROM b UNION ALL SELECT libid, book FROM b WHERE folder = 'fb2-030560-060423.zip') GROUP BY 1""")
def library_keys(spark, sf_dir):
    """Books by source and id, those of common folders by id alone."""
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(key.alias("book"), F.concat(F.lit("lib"), (key % 2).cast("string")).alias("source"), F.col("o_custkey").cast("string").alias("libid"), F.when(key % 3 == 0, "fb2-030560-060423.zip").otherwise("other.zip").alias("folder"))
    return entries.library_index(rows)


@query("unknown_books", """SELECT 'unknown author:' AS author, 'unordered:' AS genre, regexp_replace(regexp_extract(url, '([^/]*)$', 1), '\\.[^.]*$', '') AS title, CAST(length(html) AS VARCHAR) AS size, TRUE AS deleted, lower(regexp_extract(url, '\\.([^./]*)$', 1)) AS ext, '2020-01-31' AS date, 1 AS rate_count, page_id FROM pages""".replace("\\\\", "\\"))
def unknown_books(spark, sf_dir):
    """Files that no parser reads, as books of an unknown author."""
    made = entries.unknown_book(F.col("url"), F.char_length("html"), F.lit("2020-01-31").cast("date"))
    return table(spark, sf_dir, "pages").select("page_id", *made).select("author", "genre", "title", "size", "deleted", "ext", "date", "rate_count", "page_id")


@query("author_notes", """SELECT o_orderkey AS nid, c_name || ' ' || CAST(c_nationkey AS VARCHAR) || ' ' || n_name AS name, o_orderpriority AS body, s_name AS file FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey LEFT JOIN (SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 2 = 0) ON s_suppkey = o_custkey""")
def author_notes(spark, sf_dir):
    """Notes on authors with the author's full name and pictures."""
    people = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    names = people.select(F.col("c_custkey").alias("author_id"), F.col("c_name").alias("last"), F.col("c_nationkey").cast("string").alias("first"), F.col("n_name").alias("middle"))
    notes = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("nid"), F.col("o_custkey").alias("author_id"), F.col("o_orderpriority").alias("body"))
    return entries.author_notes(notes, names, table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("author_id"), F.col("s_name").alias("file")))


@query("role_dump", """SELECT o_orderkey AS book_id, string_agg(c_name || ',x,' || CAST(c_nationkey AS VARCHAR), ':' ORDER BY c_custkey) || ':' AS authors FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus <> 'F' GROUP BY 1""")
def role_dump(spark, sf_dir):
    """The second layout of dumps written and read: links by role, names in another table."""
    at = folder(spark)
    c = F.col
    links = table(spark, sf_dir, "orders").select(dump.statement("libavtor", c("o_orderkey"), c("o_custkey"), F.when(c("o_orderstatus") == "F", "t").otherwise("a")).alias("value"))
    names = table(spark, sf_dir, "customer").select(dump.statement("libavtors", c("c_custkey"), F.lit("x"), c("c_nationkey"), c("c_name"), F.lit(0)).alias("value"))
    links.unionByName(names).write.text(at)
    chosen = dialects.choose(at, "roles")
    return chosen.authors(dialects.load(spark, at, chosen))


@query("compilation_tree", r"""WITH RECURSIVE c AS (SELECT conv_id, turn, role, md5(text) AS id, length(text) AS size, CASE WHEN turn = 0 THEN 0 WHEN role = 'user' THEN 1 ELSE 2 END AS depth FROM conversations),
 s AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS ord FROM c), own AS (SELECT conv_id, id AS own FROM s WHERE ord = 1),
 b AS (SELECT id, min(conv_id) AS book FROM s WHERE conv_id % 3 = 0 AND depth > 0 GROUP BY 1),
 m AS (SELECT s.conv_id, s.ord, s.depth, s.id, own, s.size < 20 AS small, s.id <> own AND EXISTS (SELECT 1 FROM b WHERE b.id = s.id) AS part, lead(s.depth) OVER (PARTITION BY s.conv_id ORDER BY s.ord) AS below FROM s JOIN own USING (conv_id)),
 w AS (SELECT m.*, EXISTS (SELECT 1 FROM m p WHERE p.conv_id = m.conv_id AND p.ord < m.ord AND p.depth < m.depth AND (p.small OR p.part) AND NOT EXISTS (SELECT 1 FROM m q WHERE q.conv_id = m.conv_id AND q.ord > p.ord AND q.ord < m.ord AND q.depth <= p.depth)) AS above FROM m),
 v AS (SELECT * FROM w WHERE NOT above AND NOT small), p AS (SELECT conv_id, id, row_number() OVER (PARTITION BY conv_id ORDER BY min(ord)) - 1 AS part FROM v WHERE part GROUP BY 1, 2)
SELECT p.conv_id AS doc, string_agg(p.part || ':' || book, ',' ORDER BY p.part, book) AS found, count(DISTINCT p.id) AS parts, (SELECT NOT bool_or(NOT v.part AND v.id <> v.own AND coalesce(v.below, 0) <= v.depth) FROM v WHERE v.conv_id = p.conv_id) AS covered
FROM p JOIN b ON b.id = p.id GROUP BY 1 HAVING count(DISTINCT p.id) > 1""".replace("WITH RECURSIVE", "WITH"))
def compilation_tree(spark, sf_dir):
    """Conversations as trees: the first turn is the root, users' turns its sections, answers theirs; turns of every third one are published."""
    rows, known = conversation_sections(spark, sf_dir)
    return compilation.tree_compilations(rows, known, "doc", 20)


def conversation_sections(spark, sf_dir):
    order = F.row_number().over(compilation.Window.partitionBy("conv_id").orderBy("turn"))
    first = compilation.Window.partitionBy("conv_id").orderBy("ord")
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.md5(F.col("text").cast("binary")).alias("section"), F.char_length("text").alias("size"), order.alias("ord"), F.when(F.col("turn") == 0, 0).when(F.col("role") == "user", 1).otherwise(2).alias("depth"))
    rows = rows.withColumn("own", F.first("section").over(first)).withColumnRenamed("conv_id", "doc")
    return rows, rows.where("doc % 3 = 0 and depth > 0").groupBy("section").agg(F.min("doc").alias("book"))


TREE = """WITH t AS (SELECT conv_id, turn // 2 AS row, max(CASE WHEN role = 'user' THEN text END) AS q, max(CASE WHEN role = 'assistant' THEN text END) AS a FROM conversations WHERE role IN ('user', 'assistant') GROUP BY 1, 2),
 n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY row) - 1 AS nth FROM t)"""


def trees(spark, sf_dir):
    """A document per conversation: its exchanges in order, every second one below the one before it."""
    pick = lambda role: F.max(F.when(F.col("role") == role, F.col("text")))
    own = table(spark, sf_dir, "conversations").where("role in ('user', 'assistant')").groupBy("conv_id", F.expr("turn div 2").alias("row")).agg(pick("user").alias("q"), pick("assistant").alias("a"))
    at = F.row_number().over(compilation.Window.partitionBy("conv_id").orderBy("row")) - 1
    rows = own.withColumn("at", at).select("conv_id", F.concat_ws("", F.lit("lang"), F.col("conv_id").cast("string")).alias("language"), F.when(F.col("at") % 2 == 0, F.array(F.expr("cast(at div 2 as int)"))).otherwise(F.array(F.expr("cast(at div 2 as int)"), F.lit(0))).alias("path"), F.col("q").alias("question"), F.col("a").alias("answer"))
    return rows


@query("faq_tree", TREE + """ SELECT 'lang' || conv_id AS language, CASE WHEN nth % 2 = 0 THEN CAST(nth // 2 AS VARCHAR) ELSE nth // 2 || '/0' END AS id, md5(coalesce(q, '')) AS question, md5(coalesce(a, '')) AS answer FROM n""")
def faq_tree_files(spark, sf_dir):
    """Question trees saved as nested JSON documents, and read from them level by level."""
    rows = trees(spark, sf_dir)
    saved = faq_tree.saved(rows.select("language", "path", "question", "answer"))
    back = faq_tree.read_tree(saved.select(F.col("language").alias("file"), F.col("json").alias("value")))
    return back.select("language", faq_tree.item_id(F.col("path")).alias("id"), F.md5(F.col("question").cast("binary")).alias("question"), F.md5(F.coalesce("answer", F.lit("")).cast("binary")).alias("answer"))


@query("faq_template", TREE + """ SELECT DISTINCT CASE WHEN nth % 2 = 0 THEN CAST(nth // 2 AS VARCHAR) ELSE nth // 2 || '/0' END AS id, CASE WHEN nth % 2 = 0 THEN 'main' ELSE 'subtitle' END AS question FROM n""")
def faq_template(spark, sf_dir):
    """The shape of all trees as a template."""
    made = faq_tree.template(trees(spark, sf_dir))
    return made.select(faq_tree.item_id(F.col("path")).alias("id"), "question")


@query("faq_report", TREE + """, p AS (SELECT DISTINCT nth FROM n), x AS (SELECT p.nth, l.lang, n.q, n.a FROM p, (VALUES (0), (1)) l(lang) LEFT JOIN n ON n.nth = p.nth AND n.conv_id = l.lang),
 r AS (SELECT 'empty question' AS problem FROM x WHERE coalesce(q, '') = '' UNION ALL SELECT 'empty answer' FROM x WHERE coalesce(a, '') = ''
   UNION ALL SELECT 'different numbers of lines' FROM (SELECT nth FROM x GROUP BY nth HAVING count(DISTINCT len(string_split(coalesce(a, ''), chr(10)))) > 1) UNION ALL SELECT 'unexpected file')
SELECT problem, count(*) AS n FROM r GROUP BY 1""")
def faq_report(spark, sf_dir):
    """What the trees of two languages lack against all."""
    files = spark.createDataFrame([("img/a/b.jpg",)], "file string")
    found = faq_tree.report(trees(spark, sf_dir).select("language", "path", "question", "answer"), ["lang0", "lang1"], files)
    return found.groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


@query("magic_kinds", """SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'jpg' WHEN 1 THEN 'png' WHEN 2 THEN 'gz' WHEN 3 THEN 'base64 png' WHEN 4 THEN 'xml' ELSE 'other' END AS kind FROM documents""")
def magic_kinds(spark, sf_dir):
    """Kinds of binaries by their first bytes, base64 among them."""
    head = F.element_at(F.array(*map(F.lit, ("FFD8FFE0", "89504E47", "1F8B", "", "3C3F786D6C", ""))), (F.col("doc_id") % 6 + 1).cast("int"))
    coded = F.base64(F.concat(F.unhex(F.lit("89504E470D0A1A0A")), F.col("text").cast("binary"))).cast("binary")
    body = F.when(F.col("doc_id") % 6 == 3, coded).otherwise(F.concat(F.unhex(head), F.when(F.col("doc_id") % 6 == 5, F.lit("-").cast("binary")).otherwise(F.lit("").cast("binary")), F.col("text").cast("binary")))
    return table(spark, sf_dir, "documents").select("doc_id", books.signature(body).alias("kind"))


@query("ready_list", r"""WITH l AS (SELECT DISTINCT unnest(regexp_extract_all(html, 'href="(/[^"]+)"', 1)) AS name FROM pages WHERE page_id % 2 = 0) SELECT link, count(*) AS n FROM (SELECT page_id, unnest(list_distinct(regexp_extract_all(html, 'href="(/[^"]+)"', 1))) AS link FROM pages WHERE page_id % 2 = 1) WHERE link NOT IN (SELECT name FROM l) GROUP BY 1""")
def ready_list(spark, sf_dir):
    """Links that a written list of ready ones does not hold."""
    links = table(spark, sf_dir, "pages").select("page_id", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(r'href="(/[^"]+)"'), F.lit(1)))).alias("link"))
    at = folder(spark)
    dialects.write_ready_list(links.where("page_id % 2 = 0").select(F.col("link").alias("name")), at)
    left = links.where("page_id % 2 = 1").join(dialects.ready_list(spark, at), F.col("link") == F.col("name"), "left_anti")
    return left.groupBy("link").agg(F.count(F.lit(1)).alias("n"))
