"""Plans that make book files of the pages and read them as arriving files are read."""

from __future__ import annotations

from pyspark.sql import functions as F

from bookloom.functions import text as tx
from bookloom.operators import compilation, entries, faq_tree, images, resolve
from bookloom.plans.registry import query, table
from bookloom.plans.resolution import dup_closure, sign_bits
from bookloom.plans.stores import TREE, conversation_sections, fingerprints, trees
from bookloom.sinks import published
from bookloom.sinks.published import xml_text
from bookloom.sources import archive, books, dialects, locales, markup
from bookloom.sources.shared import folder


def xml_sql(x: str) -> str:
    """SQL for a text with the characters escaped that mark-up needs."""
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


#: A page's book, up to its text: every third one has no end, a stray ampersand, brackets that are no tags and an address.
HEAD = '<?xml version="1.0" encoding="utf-8"?><FictionBook xmlns:l="http://www.w3.org/1999/xlink"><description><title-info><book-title>'
COVER = '</book-title><coverpage><image l:href="#c.jpg"/></coverpage></title-info></description><body><section><h1>H</h1><P><i>it</i><br/>'
STRAY = "a & b <me@x.yz> <Hello> 1 < 2 > 1 &#169; "
PICTURES = '<image l:href="#i.png"/><image l:href="#lost"/></P></section></body><binary id="i.png" content-type="image/png">iVBORw0KGgo=</binary><binary id="c.jpg" content-type="image/jpeg">/9j/4AAQ</binary>'


def page_books(spark, sf_dir):
    """page_id, body: pages as book files, their HTML escaped as the text of a paragraph."""
    broken = F.col("page_id") % 3 == 0
    stray = F.when(broken, F.lit(STRAY)).otherwise(F.lit(""))
    end = F.when(broken, F.lit("")).otherwise(F.lit("</FictionBook>"))
    whole = F.concat(F.lit(HEAD), xml_text(F.col("url")), F.lit(COVER), stray, xml_text(F.col("html")), F.lit(PICTURES), end)
    return table(spark, sf_dir, "pages").select("page_id", "url", whole.cast("binary").alias("body"))


UNESCAPED = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '&lt;', '<', 'gi'), '&gt;', '>', 'gi'), '&quot;', '\"', 'gi'), '&apos;', '''', 'gi'), '&amp;', '&', 'gi')"


@query("book_text", rf"""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'repaired' ELSE 'valid' END AS status,
 sha256('<?xml version="1.0" encoding="UTF-8"?>' || chr(10) || '<FictionBook xmlns="http://www.gribuser.ru/xml/fictionbook/2.0" xmlns:l="http://www.w3.org/1999/xlink"><description><title-info><book-title>' || {xml_sql("url")}
 || '</book-title><coverpage><image l:href="' || CASE WHEN page_id % 3 = 0 THEN '#c.jpg' ELSE '#cover' END || '"></image></coverpage></title-info><document-info><program-used>bookloom</program-used></document-info></description><body><section><h1>H</h1><P><i>it</i>'
 || CASE WHEN page_id % 3 = 0 THEN 'a &amp; b "me@x.yz" &lt;Hello&gt; 1 &lt; 2 &gt; 1 &amp;#169; ' ELSE '' END || CASE WHEN page_id % 3 = 0 THEN regexp_replace({xml_sql(UNESCAPED)}, '\n+', chr(10), 'g') ELSE {xml_sql(UNESCAPED)} END
 || '<image l:href="#0"></image><image l:href="#lost"></image></P></section></body></FictionBook>') AS digest FROM pages""")
def book_text(spark, sf_dir):
    """Books without their pictures, broken ones repaired: there line ends that follow each other are one, and the last picture, the cover, is cut off."""
    found = books.book_text(page_books(spark, sf_dir))
    return found.select("page_id", "status", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))


@query("book_pictures", r"""SELECT page_id, 'i.png' AS binary_id, FALSE AS is_cover, '89504E470D0A1A0A' AS content, FALSE AS failed FROM pages WHERE page_id % 3 <> 0
UNION ALL SELECT page_id, 'c.jpg', TRUE, 'FFD8FFE00010', FALSE FROM pages WHERE page_id % 3 <> 0 UNION ALL SELECT page_id, NULL, NULL, NULL, TRUE FROM pages WHERE page_id % 3 = 0""")
def book_pictures(spark, sf_dir):
    """Pictures that books hold, the cover marked; a book that does not parse gives its error."""
    found = markup.binaries(page_books(spark, sf_dir))
    return found.select("page_id", "binary_id", "is_cover", F.hex("content").alias("content"), F.col("error").isNotNull().alias("failed"))


@query("book_kinds", r"""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'fb2' WHEN 1 THEN 'fb2' END AS kind FROM documents""")
def book_kinds(spark, sf_dir):
    """What files are: books whose root comes before their body (a byte order mark may precede), and others."""
    forms = [("<?xml version='1.0'?><FictionBook><body>", ""), ("\ufeff\n<FictionBook><body>", ""), ("<?xml version='1.0'?><body><FictionBook>", ""), ("<html>", ""), ("PK\x03\x04", "")]
    body = F.element_at(F.array(*[F.concat(F.lit(a), "text", F.lit(b)) for a, b in forms]), (F.col("doc_id") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", books.kind_of(body.cast("binary")).alias("kind"))


ENTRIES = """e AS (SELECT 'z' || page_id // 7 AS archive, (CASE page_id % 9 WHEN 0 THEN 'b.FB2' WHEN 1 THEN 'a.epub' WHEN 2 THEN 'n.fbd' WHEN 3 THEN 'in.zip' WHEN 4 THEN '__MACOSX/a.fb2' WHEN 5 THEN 'x.txt' WHEN 6 THEN 'x.PDF' WHEN 7 THEN 'a.fb2' ELSE 'x.dll' END) AS entry, page_id, length(html) AS size FROM pages)"""


def page_entries(spark, sf_dir):
    names = ("b.FB2", "a.epub", "n.fbd", "in.zip", "__MACOSX/a.fb2", "x.txt", "x.PDF", "a.fb2", "x.dll")
    entry = F.element_at(F.array(*map(F.lit, names)), (F.col("page_id") % 9 + 1).cast("int"))
    return table(spark, sf_dir, "pages").select(F.concat(F.lit("z"), F.expr("page_id div 7").cast("string")).alias("archive"), entry.alias("entry"), "page_id", F.col("html").cast("binary").alias("body"))


@query("entry_parsers", f"""WITH {ENTRIES} SELECT page_id, CASE WHEN lower(entry) LIKE '%.fb2' THEN 'fb2' WHEN entry LIKE '%.epub' THEN 'epub' WHEN entry LIKE '%.fbd' THEN 'stub' WHEN entry LIKE '%.zip' THEN 'archive' END AS parser, NOT regexp_matches(entry, '\\.(txt|PDF|dll|fbd)$') AS parsable FROM e""")
def entry_parsers(spark, sf_dir):
    """The parser of each entry by its name, and whether it holds a book to parse at all."""
    return page_entries(spark, sf_dir).select("page_id", books.parser_of(F.col("entry")).alias("parser"), books.parsable(F.col("entry")).alias("parsable"))


@query("nested_books", f"""WITH {ENTRIES}, t AS (SELECT *, CASE WHEN lower(entry) LIKE '%.fb2' THEN 1 WHEN entry LIKE '%.epub' THEN 2 WHEN entry LIKE '%.fbd' THEN 3 END AS turn FROM e WHERE entry NOT LIKE '\\_\\_MACOSX%' ESCAPE '\\')
SELECT archive, entry FROM t WHERE turn IS NOT NULL QUALIFY row_number() OVER (PARTITION BY archive ORDER BY turn, entry) = 1""")
def nested_books(spark, sf_dir):
    """Of each archive inside an archive the one entry to parse."""
    return books.best_entry(page_entries(spark, sf_dir).select("archive", "entry")).select("archive", "entry")


@query("archive_totals", f"""WITH {ENTRIES}, a AS (SELECT archive, count(*) AS n, sum(octet_length(encode(html))) AS bytes FROM e JOIN pages USING (page_id) GROUP BY 1)
SELECT count(*) AS archives, CAST(sum(n) AS BIGINT) AS entries, CAST(sum(bytes) AS BIGINT) AS bytes, max_by(archive, (n, archive)) AS largest, (SELECT CAST(DATE '2020-01-01' + CAST(max(page_id) AS INT) AS DATE) FROM pages) AS latest FROM a""")
def archive_totals(spark, sf_dir):
    """How many archives, entries and bytes there are to be read, and how late the last one is."""
    return archive.totals(page_entries(spark, sf_dir).withColumn("time", F.date_add(F.lit("2020-01-01").cast("date"), F.col("page_id").cast("int"))))


@query("mostly_books", f"""WITH {ENTRIES} SELECT archive, count(*) AS total, avg(CASE WHEN lower(entry) LIKE '%.fb2' THEN 1.0 ELSE 0 END) > 0.3 AS mostly FROM e GROUP BY 1""")
def mostly_books(spark, sf_dir):
    """Archives most of whose entries are books."""
    return books.mostly(page_entries(spark, sf_dir), "archive", ".fb2", 0.3)


@query("archive_listing", r"""WITH f AS (SELECT '/in/' || page_id % 2 || '/' || CASE WHEN page_id % 4 = 0 THEN 'FB2-' ELSE 'fb2-' END || page_id // 3 * 10 || '-' || page_id || '.ZIP' AS path, page_id FROM pages UNION ALL SELECT '/in/other/usr' || page_id % 5 || '.zip', page_id FROM pages),
 a AS (SELECT lower(split_part(path, '/', 4)) AS name, min(path) AS path FROM f GROUP BY 1), h AS (SELECT DISTINCT 'fb2-' || page_id // 3 * 10 || '-' || page_id AS stem FROM pages WHERE page_id % 3 <> 0)
SELECT path, name, coalesce(CAST(nullif(regexp_extract(name, 'fb2.*?(\d+)', 1), '') AS BIGINT), 0) AS number, CASE WHEN stem IS NOT NULL THEN '/hash/' || stem || '.xml' END AS hash FROM a LEFT JOIN h ON name = stem || '.zip'""")
def archive_listing(spark, sf_dir):
    """Archives by their number, one of equal names, with the fingerprints that belong to them."""
    pages = table(spark, sf_dir, "pages")
    key = F.col("page_id").cast("string")
    stem = F.concat((F.expr("page_id div 3") * 10).cast("string"), F.lit("-"), key)
    numbered = F.concat(F.lit("/in/"), (F.col("page_id") % 2).cast("string"), F.lit("/"), F.when(F.col("page_id") % 4 == 0, "FB2-").otherwise("fb2-"), stem, F.lit(".ZIP"))
    files = pages.select(numbered.alias("path")).unionByName(pages.select(F.concat(F.lit("/in/other/usr"), (F.col("page_id") % 5).cast("string"), F.lit(".zip")).alias("path")))
    known = pages.where("page_id % 3 <> 0").select(F.concat(F.lit("/hash/fb2-"), stem, F.lit(".xml")).alias("path"))
    return archive.with_fingerprints(archive.listed(files), known).select("path", "name", "number", "hash")


@query("file_checks", r"""SELECT page_id, CASE page_id % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN FALSE ELSE TRUE END AS valid, regexp_matches(html, '<article|id="content"') AS has_text,
 CASE WHEN length(html) % 1500 < 100 THEN 'empty' WHEN length(html) % 1500 < 128 THEN 'no repair' WHEN length(html) % 1500 < 1024 THEN 'no picture' ELSE 'picture' END AS size_class, CASE WHEN page_id % 3 = 0 THEN 'grayscale' WHEN page_id % 2 = 0 THEN 'alpha' ELSE 'normal' END AS pixels,
 CASE WHEN page_id % 5 = 0 THEN page_id || '.jpg' END AS picture FROM pages""")
def file_checks(spark, sf_dir):
    """What is checked of files: their first bytes against their names, patterns of pages, sizes, pixels, paths of pictures."""
    key = F.col("page_id")
    name = F.element_at(F.array(*map(F.lit, ("a.zip", "a.ZIP", "a.gz", "a.htm"))), (key % 4 + 1).cast("int"))
    body = F.concat(F.when(key % 4 == 0, F.lit("PK\x03\x04")).otherwise(F.lit("")), "html").cast("binary")
    path = F.concat(F.when(key % 5 == 0, F.lit("/img/a/")).otherwise(F.lit("img/")), key.cast("string"), F.lit(".jpg"))
    return table(spark, sf_dir, "pages").select(
        "page_id", books.valid_file(name, body).alias("valid"), books.valid_page(F.col("html"), ["<article", 'id="content"']).alias("has_text"), books.size_class(F.char_length("html") % 1500).alias("size_class"),
        books.pixel_class(key % 3 == 0, key % 2 == 0).alias("pixels"), books.wanted_picture(path).alias("picture"))


@query("image_numbers", r"""WITH i AS (SELECT l_orderkey AS book, l_linenumber || '-' || l_partkey AS image, l_suppkey % 3 AS digest FROM lineitem),
 f AS (SELECT book, digest, min(image) AS first_id FROM i GROUP BY 1, 2), n AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY first_id, digest) - 1 AS number FROM f)
SELECT book, string_agg(image || '=' || number, ',' ORDER BY image, number) AS numbers, count(CASE WHEN image = first_id THEN 1 END) AS files FROM i JOIN n USING (book, digest) GROUP BY 1""")
def image_numbers(spark, sf_dir):
    """Pictures of a book by number, equal ones by the same."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("book"), F.concat_ws("-", F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string")).alias("image"), (F.col("l_suppkey") % 3).alias("digest"))
    numbered = books.image_numbers(rows, "book", "image", "digest")
    index = books.image_index(numbered, "book", "image").withColumn("x", F.from_json("index", "array<struct<id: string, num: int>>"))
    files = numbered.groupBy("book").agg(F.count_if("is_first").alias("files"))
    return index.join(files, "book").select("book", F.array_join(F.transform("x", lambda i: F.concat_ws("=", i["id"], i["num"].cast("string"))), ",").alias("numbers"), "files")


@query("sized_books", r"""WITH s AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN length(text) END AS own FROM documents)
SELECT doc_id, CAST(coalesce(nullif(own, 0), 7) AS BIGINT) AS size FROM s""")
def sized_books(spark, sf_dir):
    """Sizes taken from the section that is the whole text, where the fingerprints have one."""
    docs = table(spark, sf_dir, "documents")
    own = F.array(F.struct(F.lit(0).alias("depth"), F.when(F.col("doc_id") % 2 == 0, F.md5(F.col("text").cast("binary"))).otherwise("-").alias("id"), F.lit(1).cast("long").alias("count"), F.char_length("text").cast("long").alias("size")))
    known = docs.select(F.concat(F.col("doc_id").cast("string"), F.lit(".fb2")).alias("file"), F.md5(F.col("text").cast("binary")).alias("id"), own.alias("sections"))
    rows = docs.select("doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(".fb2")).alias("file"), F.lit(7).cast("long").alias("size"))
    return entries.sized(rows, known).select("doc_id", "size")


ORIGINS = """x AS (SELECT doc_id AS dup, min(doc_id) OVER (PARTITION BY md5(text)) AS origin FROM documents), d AS (SELECT * FROM x WHERE dup <> origin)"""


@query("origins", f"""WITH {ORIGINS} SELECT doc_id AS id, origin FROM documents LEFT JOIN d ON dup = doc_id""")
def origins(spark, sf_dir):
    """Fingerprints with the book that each is a duplicate of."""
    ids = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.lit(None).cast("long").alias("origin"))
    return entries.with_origins(ids, dup_closure(spark, sf_dir).withColumnRenamed("root", "origin"))


@query("removed_duplicates", f"""WITH {ORIGINS} SELECT doc_id AS id, (SELECT count(*) FROM labels l WHERE l.doc_id = documents.doc_id) AS images FROM documents WHERE doc_id NOT IN (SELECT dup FROM d)""")
def removed_duplicates(spark, sf_dir):
    """An archive's entries and pictures without those of duplicates."""
    own = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    pictures = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.lit("0").alias("image"))
    kept, left = entries.without_duplicates(own, dup_closure(spark, sf_dir), pictures)
    return kept.join(left.groupBy("id").agg(F.count(F.lit(1)).alias("images")), "id", "left").select("id", F.coalesce("images", F.lit(0)).alias("images"))


@query("still_listed", r"""SELECT folder, file FROM (SELECT 'archive-' || doc_id % 4 AS folder, doc_id || '.fb2' AS file, doc_id FROM documents) WHERE doc_id % 5 <> 0 AND EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id) AND doc_id % 7 <> 0""".replace("FROM documents)", "FROM documents) documents"))
def still_listed(spark, sf_dir):
    """Fingerprints that are no duplicates, whose names are good and whose files are still in their archives."""
    name = F.concat(F.regexp_extract("file", r"^(\d+)", 1), F.when(F.regexp_extract("file", r"^(\d+)", 1).cast("long") % 7 == 0, F.lit("\n")).otherwise(F.lit("")), F.lit(".fb2"))
    rows = fingerprints(spark, sf_dir).select("folder", name.alias("file"), "origin")
    there = table(spark, sf_dir, "labels").select(F.concat(F.lit("archive-"), (F.col("doc_id") % 4).cast("string")).alias("folder"), F.concat(F.col("doc_id").cast("string"), F.lit(".fb2")).alias("file"))
    kept = entries.good_names(entries.without_origin(rows), "file")
    return entries.still_there(kept, there, ["folder", "file"]).select("folder", "file")


@query("edge_books", r"""WITH e AS (SELECT o_orderkey AS dup, CASE WHEN o_custkey % 2 = 0 THEN 'f#' || o_custkey ELSE '-' END AS uid, 'lib' AS source, o_custkey || '.fb2' AS file FROM orders)
SELECT dup, CASE WHEN uid <> '-' AND c_custkey % 3 <> 0 THEN c_custkey ELSE -c_custkey END AS origin FROM e JOIN customer ON c_custkey || '.fb2' = file WHERE uid <> '-' AND c_custkey % 3 <> 0 OR c_nationkey < 12""")
def edge_books(spark, sf_dir):
    """Duplicates with the books that their origins are: by uid, else by library and file name."""
    people = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    by_uid = people.where("c_custkey % 3 <> 0").select(F.concat(F.lit("f#"), key).alias("key"), F.col("c_custkey").alias("book"))
    by_library = people.where("c_nationkey < 12").select(F.concat(F.lit("lib_"), key).alias("key"), (-F.col("c_custkey")).alias("book"))
    own = F.col("o_custkey").cast("string")
    edges = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("dup"), F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("f#"), own)).otherwise("-").alias("uid"), F.lit("lib").alias("source"), F.concat(own, F.lit(".fb2")).alias("file"))
    return resolve.edges_to_books(edges, by_uid, by_library)


@query("near_images", r"""WITH h AS (SELECT vec_id, label, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS b FROM embeddings UNION ALL
  SELECT vec_id + 1000000, label, list_transform(list_concat(list_transform(embedding[1:vec_id % 14], lambda x: -x), embedding[vec_id % 14 + 1:64]), lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) FROM embeddings),
 p AS (SELECT y.vec_id, list_sum(list_transform(list_zip(x.b, y.b), lambda z: CASE WHEN z[1] <> z[2] THEN 1 ELSE 0 END)) AS far FROM h x JOIN h y ON y.vec_id = x.vec_id + 1000000)
SELECT vec_id, CASE WHEN far < 10 OR far = 10 AND vec_id % 2 = 0 THEN 'equal' ELSE 'varied' END AS relation FROM p""")
def near_images(spark, sf_dir):
    """Books of one picture each against copies whose pictures are up to 13 bits away; at ten only an equal number makes them equal."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    turned = F.concat(F.transform(F.slice("embedding", F.lit(1), (F.col("vec_id") % 14).cast("int")), lambda x: -x), F.slice("embedding", (F.col("vec_id") % 14 + 1).cast("int"), F.lit(64)))

    def books_of(rows, name, number):
        picture = F.array(F.struct(number.cast("string").alias("id"), F.concat_ws("-", F.lit(name), F.col("vec_id").cast("string")).alias("hash"), F.col("bits").alias("phash")))
        book = F.struct(F.col("vec_id").alias("id"), F.lit("same").alias("hash"), F.array(F.lit("t")).alias("titles"), F.lit(None).cast("struct<hash:string,phash:bigint>").alias("cover"), picture.alias("images"))
        return sign_bits(rows).select("vec_id", book.alias(name))

    left, right = books_of(vectors, "left", F.lit(1)), books_of(vectors.withColumn("embedding", turned), "right", F.col("vec_id") % 2 + 1)
    return images.with_relation(left.join(right, "vec_id"), "left", "right").select((F.col("vec_id") + 1000000).alias("vec_id"), "relation")


@query("first_compared", r"""WITH b AS (SELECT doc_id AS id, CASE WHEN doc_id % 3 = 0 THEN [] ELSE list_slice(['a', 'b', 'c'], 1, CAST(1 + doc_id % 3 AS INT)) END AS i FROM documents), f AS (SELECT i FROM b ORDER BY id DESC LIMIT 1)
SELECT id, CASE WHEN len(b.i) = len(f.i) THEN 'equal' WHEN len(b.i) > len(f.i) THEN 'inner' ELSE 'outer' END AS relation FROM b, f WHERE id <> (SELECT max(id) FROM b)""")
def first_compared(spark, sf_dir):
    """All books against the last one, by images that lie in each other."""
    picture = lambda x: F.struct(F.lit(x).alias("id"), F.lit(x).alias("hash"), F.lit(0).cast("long").alias("phash"))
    own = F.slice(F.array(*map(picture, "abc")), F.lit(1), F.when(F.col("doc_id") % 3 == 0, 0).otherwise((1 + F.col("doc_id") % 3).cast("int")))
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.lit("h").alias("hash"), F.array(F.lit("t")).alias("titles"), F.lit(None).cast("struct<hash:string,phash:bigint>").alias("cover"), own.alias("images"))
    return images.compared_with_first(rows, F.desc("id"))


@query("quarantined", """SELECT doc_id, CASE WHEN n_chars < 500 THEN 'short' WHEN lang IS NULL OR lang = 'en' THEN 'language' END AS reason FROM documents""")
def quarantined(spark, sf_dir):
    """Rows set aside with their reason, and those that are good."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    reason = F.when(F.col("n_chars") < 500, "short").when(F.col("lang").isNull() | (F.col("lang") == "en"), "language")
    at = folder(spark)
    good = published.quarantine(rows, reason, at)
    return good.select("doc_id", F.lit(None).cast("string").alias("reason")).unionByName(spark.read.parquet(at).select("doc_id", "reason"))


@query("corrected_names", """SELECT c_custkey, CASE WHEN o IS NOT NULL THEN 'was ' || o ELSE c_name END AS c_name FROM customer LEFT JOIN (SELECT s_suppkey, s_name AS o FROM supplier WHERE s_suppkey % 2 = 0) ON s_suppkey = c_custkey""")
def corrected_names(spark, sf_dir):
    """A library's names by the rows of a table of corrections that belong to it."""
    other = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.concat(F.lit("was "), "s_name").alias("c_name"), (F.col("s_suppkey") % 2).alias("LibraryId"))
    libraries = table(spark, sf_dir, "region").where("r_regionkey < 2").select(F.col("r_regionkey").alias("Id"), F.when(F.col("r_regionkey") == 0, "one").otherwise("two").alias("Name"))
    return dialects.corrected(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), other, libraries, "one", "c_custkey", ["c_name"])


@query("typed_reviews", """SELECT user_id AS book_id, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1""")
def typed_reviews(spark, sf_dir):
    """Of the second layout's notes those on books are reviews."""
    kind = F.when(F.col("event_type") == "click", "b").otherwise("a")
    notes = table(spark, sf_dir, "events").select(F.col("user_id").alias("bid"), kind.alias("type"), F.col("ts").cast("string").alias("Time"), F.lit("").alias("Text"))
    return dialects.DIALECTS["roles"].reviews({"libpolka": notes}).groupBy("book_id").agg(F.count(F.lit(1)).alias("n"))


@query("option_values", """SELECT p_partkey, CAST(CASE p_partkey % 4 WHEN 0 THEN p_size WHEN 1 THEN p_size WHEN 2 THEN 1 ELSE 1 END AS INT) AS width, CAST(CASE p_partkey % 4 WHEN 0 THEN p_size WHEN 1 THEN 7 WHEN 2 THEN 2 ELSE 2 END AS INT) AS height,
 'a -t7z /out/' || p_partkey || ' /out/' || p_partkey || '/*.fb2' AS arguments, CASE p_partkey % 3 WHEN 0 THEN p_size WHEN 1 THEN 5 END AS setting FROM part""")
def option_values(spark, sf_dir):
    """Options of sizes, an archiver's arguments and settings read from their texts."""
    size, key = F.col("p_size").cast("string"), F.col("p_partkey")
    given = F.element_at(F.array(size, F.concat(size, F.lit(",7")), F.lit("x,y"), F.lit(None).cast("string")), (key % 4 + 1).cast("int"))
    place = F.concat(F.lit("/out/"), key.cast("string"))
    text = F.element_at(F.array(F.concat(F.lit('{"n": '), size, F.lit("}")), F.lit(""), F.lit("{")), (key % 3 + 1).cast("int"))
    option = dialects.size_option(given, F.lit(1), F.lit(2))
    return table(spark, sf_dir, "part").select("p_partkey", option["width"].alias("width"), option["height"].alias("height"), F.array_join(dialects.archiver_arguments(F.lit("a  -t7z %dst% #src#"), place), " ").alias("arguments"), dialects.settings(text, "n int", '{"n": 5}')["n"].alias("setting"))


@query("name_parts", r"""SELECT page_id, regexp_replace(regexp_extract(url, '([^/]*)$', 1), '\.[^.]*$', '') AS base, lower(regexp_extract(url, '\.([^./]*)$', 1)) AS suffix, CAST(page_id % 13 AS INT) AS leading, CASE WHEN page_id % 2 = 0 THEN page_id ELSE 2147483647 END AS sorted,
 regexp_replace(url, '[<>:"/\\|?*]', '', 'g') AS legal FROM pages""")
def name_parts(spark, sf_dir):
    """Parts of paths: names, suffixes, numbers, and what file systems take."""
    number = F.concat((F.col("page_id") % 13).cast("string"), F.lit(" of 9"))
    order = F.when(F.col("page_id") % 2 == 0, F.col("page_id").cast("string")).otherwise("x")
    return table(spark, sf_dir, "pages").select("page_id", tx.base_name(F.col("url")).alias("base"), tx.suffix(F.col("url")).alias("suffix"), tx.leading_int(number).alias("leading"), tx.sort_number(order).alias("sorted"), tx.without_illegal(F.col("url")).alias("legal"))


@query("built_once", """SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1""")
def built_once(spark, sf_dir):
    """A table that is built where it is missing and read where it is there."""
    at = f"{folder(spark)}/table"
    made = lambda: table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    published.open_or_build(spark, at, made)
    return published.open_or_build(spark, at, lambda: made().where(F.lit(False)))


@query("localised_names", """SELECT c_custkey, CASE WHEN n_nationkey % 4 = 0 THEN n_name ELSE '<' || lower(n_name) || '> & ' || n_regionkey END AS nation FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def localised_names(spark, sf_dir):
    """Names by dictionaries of messages in three languages, written and read; what a dictionary lacks stays."""
    nations = table(spark, sf_dir, "nation")
    own = F.concat(F.lit("<"), F.lower("n_name"), F.lit("> & "), F.col("n_regionkey").cast("string"))
    languages = F.explode(F.array(*map(F.lit, ("en", "de", "fr")))).alias("language")
    rows = nations.select(languages, F.col("n_name").alias("source"), "n_nationkey", own.alias("own")).select("language", "source", F.when((F.col("n_nationkey") % 4 != 0) & (F.col("language") == "de"), F.col("own")).when(F.col("language") == "de", "").otherwise(F.col("language")).alias("translation"))
    at = folder(spark)
    locales.write_messages(rows, at)
    people = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("nation"))
    return locales.localised(people, "nation", locales.read_messages(spark, at), "de")


@query("faq_export", TREE + r""", x AS (SELECT *, 'lang' || conv_id AS language, string_split(coalesce(a, ''), chr(10)) AS lines FROM n),
 html AS (SELECT p.language, p.nth, '<h2>' || coalesce(p.q, '') || '</h2><b>' || p.lines[1] || '</b> ' || CASE WHEN len(p.lines) > 1 THEN p.lines[2] ELSE '%2' END || ' 100% '
   || coalesce('<h3>' || coalesce(c.q, '') || '</h3>(' || c.lines[1] || ')', CASE WHEN c.nth IS NULL THEN '[q0]' END) || '<hr/>' AS html FROM x p LEFT JOIN x c ON c.conv_id = p.conv_id AND c.nth = p.nth + 1 WHERE p.nth % 2 = 0)
SELECT language, md5('<title>T ' || language || '</title>' || string_agg(html, '' ORDER BY nth) || '<!-- T -->') AS digest FROM html GROUP BY 1""")
def faq_export(spark, sf_dir):
    """Question trees as documents, entries inside those that name them, with macros in their heads."""
    rows = trees(spark, sf_dir).select("language", "path", "question", "answer")
    shape = faq_tree.template(rows)
    pattern = F.when(F.size("path") == 1, "[b]%1[/b] %2 100% [q0]").otherwise("(%1)")
    tree = rows.unionByName(shape.withColumn("answer", pattern))
    macros = rows.select("language").distinct().select("language", F.lit("%NAME%").alias("name"), F.concat(F.lit("T "), "language").alias("value"))
    out = faq_tree.exported(tree, {"main": ("<h2>#QUESTION#</h2>", "<hr/>"), "subtitle": ("<h3>#QUESTION#</h3>", "")}, [(r"\[(/?b)\]", "<$1>")], "<title>%NAME%</title>", "<!-- T -->", macros)
    return out.select("language", F.md5(F.col("html").cast("binary")).alias("digest"))


@query("compilation_files", r"""WITH s AS (SELECT conv_id, role, md5(text) AS id, length(text) AS size, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS ord, CASE WHEN turn = 0 THEN 0 WHEN role = 'user' THEN 1 ELSE 2 END AS depth FROM conversations),
 own AS (SELECT conv_id, id AS own FROM s WHERE ord = 1), b AS (SELECT id, min(conv_id) AS book FROM s WHERE conv_id % 3 = 0 AND depth > 0 GROUP BY 1),
 m AS (SELECT s.conv_id, s.ord, s.depth, s.id, s.size < 20 AS small, s.id <> own AND EXISTS (SELECT 1 FROM b WHERE b.id = s.id) AS part FROM s JOIN own USING (conv_id)),
 w AS (SELECT m.*, EXISTS (SELECT 1 FROM m p WHERE p.conv_id = m.conv_id AND p.ord < m.ord AND p.depth < m.depth AND (p.small OR p.part) AND NOT EXISTS (SELECT 1 FROM m q WHERE q.conv_id = m.conv_id AND q.ord > p.ord AND q.ord < m.ord AND q.depth <= p.depth)) AS above FROM m),
 p AS (SELECT conv_id, id, row_number() OVER (PARTITION BY conv_id ORDER BY min(ord)) - 1 AS part FROM w WHERE part AND NOT above AND NOT small GROUP BY 1, 2)
SELECT 'f' || conv_id % 7 AS folder, conv_id || '.fb2' AS file, string_agg(part || ' f' || book % 7 || ' ' || book || '.fb2', ',' ORDER BY part) AS compilation FROM p JOIN b USING (id) GROUP BY conv_id HAVING count(*) > 1""")
def compilation_files(spark, sf_dir):
    """Books made of other books as published documents, read back."""
    rows, known = conversation_sections(spark, sf_dir)
    made = compilation.tree_compilations(rows, known, "doc", 20)
    named = rows.select(F.col("doc").alias("book")).distinct().select("book", F.concat(F.lit("f"), (F.col("book") % 7).cast("string")).alias("folder"), F.concat(F.col("book").cast("string"), F.lit(".fb2")).alias("file"))
    at = folder(spark)
    published.write_json(compilation.documents(made, named), at)
    back = spark.read.schema("folder string, file string, compilation array<struct<part: int, folder: string, file: string>>, covered boolean").json(at)
    return back.select("folder", "file", F.array_join(F.transform("compilation", lambda x: F.concat_ws(" ", x["part"].cast("string"), x["folder"], x["file"])), ",").alias("compilation"))


@query("followed_chains", """SELECT c_custkey AS dup, c_custkey - c_custkey % 3 AS root FROM customer WHERE c_custkey % 3 <> 0""")
def followed_chains(spark, sf_dir):
    """Duplicates of duplicates to the book where the chain ends; origins are known by uid or by their library's file."""
    people = table(spark, sf_dir, "customer")
    key, before = F.col("c_custkey").cast("string"), (F.col("c_custkey") - 1).cast("string")
    edges = people.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("dup"), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("f#"), before)).otherwise("-").alias("uid"), F.lit("lib").alias("source"), F.concat(before, F.lit(".fb2")).alias("file"))
    by_uid = people.where("c_custkey % 5 <> 0").select(F.concat(F.lit("f#"), key).alias("key"), F.col("c_custkey").alias("book"))
    by_library = people.select(F.concat(F.lit("lib_"), key).alias("key"), F.col("c_custkey").alias("book"))
    return resolve.roots(resolve.edges_to_books(edges, by_uid, by_library))


@query("language_codes", """SELECT doc_id, CASE WHEN doc_id % 3 = 0 OR lang IS NULL OR NOT EXISTS (SELECT 1 FROM documents d WHERE d.lang = documents.lang AND d.doc_id % 2 = 0) THEN 'un' ELSE 'language ' || lang END AS lang FROM documents""")
def language_codes(spark, sf_dir):
    """Codes in any case and with spaces by a dictionary; what it lacks is unknown."""
    docs = table(spark, sf_dir, "documents")
    known = docs.where("doc_id % 2 = 0 and lang is not null").select(F.col("lang").alias("code"), F.concat(F.lit("language "), "lang").alias("language")).distinct()
    code = F.when(F.col("doc_id") % 3 == 0, "x-none").otherwise(F.concat(F.lit(" "), F.upper("lang")))
    return docs.select("doc_id", entries.canonical_language(code, known).alias("lang"))


@query("original_names", """SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'own' || page_id ELSE 'given' END AS libid, CASE WHEN page_id % 3 = 0 THEN 'own' || page_id ELSE 'given' END AS file, CASE WHEN page_id % 2 = 0 THEN 'djvu' ELSE 'fbd' END AS ext FROM pages""")
def original_names(spark, sf_dir):
    """Described files under their own names, where they have one."""
    key = F.col("page_id")
    rows = table(spark, sf_dir, "pages").select(
        "page_id", F.lit("given").alias("libid"), F.lit("given").alias("file"), F.lit("fbd").alias("ext"),
        F.when(key % 3 == 0, F.concat(F.lit("own"), key.cast("string"))).when(key % 3 == 1, "").alias("origin_base"), F.when(key % 2 == 0, "djvu").alias("origin_suffix"))
    return entries.with_original_names(rows)


@query("macro_texts", r"""WITH m AS (SELECT 'k' || turn AS name, 'lang' || conv_id % 3 AS language, max(substr(text, 1, 40)) AS value FROM conversations WHERE conv_id > 2 GROUP BY 1, 2),
 n AS (SELECT name, language, value FROM m WHERE NOT (language = 'lang1' AND name IN ('k0', 'k1')) UNION ALL SELECT 'k0', 'lang1', '' UNION ALL SELECT 'k1', 'lang1', 'a=b' UNION ALL SELECT 'new', 'lang1', 'x'),
 u AS (SELECT DISTINCT name FROM n WHERE coalesce(value, '') <> ''), l AS (SELECT n.* FROM n JOIN u USING (name))
SELECT language, md5(string_agg(name || '=' || coalesce(value, ''), chr(10) ORDER BY name)) AS digest FROM (SELECT g.language, u.name, l.value FROM (SELECT 'lang1' AS language UNION ALL SELECT 'lang2') g, u LEFT JOIN l ON l.name = u.name AND l.language = g.language) GROUP BY 1""")
def macro_texts(spark, sf_dir):
    """Macros of languages, one language's written anew, told as lines."""
    rows = table(spark, sf_dir, "conversations").where("conv_id > 2").groupBy(F.concat(F.lit("k"), F.col("turn").cast("string")).alias("name"), F.concat(F.lit("lang"), (F.col("conv_id") % 3).cast("string")).alias("language")).agg(F.max(F.substring("text", 1, 40)).alias("value"))
    now = faq_tree.set_macros(rows, "lang1", "k0=\nk1=a=b\nnew=w\nnew=x\n=none\nno macro")
    told = [faq_tree.macro_lines(now, x).select(F.lit(x).alias("language"), F.md5(F.col("text").cast("binary")).alias("digest")) for x in ("lang1", "lang2")]
    return told[0].unionByName(told[1])


@query("profile_values", r"""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'out.md' WHEN 1 THEN 'f' || p_partkey || '.txt' ELSE 'f' || p_partkey || '.html' END AS output, CAST(CASE WHEN p_size % 3 = 0 THEN -1 ELSE p_size % 3 - 1 END AS INT) AS line,
 CASE WHEN p_partkey % 2 = 0 THEN 'img/a/' || p_partkey || '.jpg,img/b/c.jpg' ELSE 'img/b/c.jpg' END AS images FROM part""")
def profile_values(spark, sf_dir):
    """Names of outputs, places of markers and pictures named by lines."""
    key, none = F.col("p_partkey"), F.lit(None).cast("string")
    text = F.concat(F.when(F.col("p_size") % 3 == 1, "%7").otherwise("-"), F.lit("\n"), F.when(F.col("p_size") % 3 == 2, "x %7 y").otherwise("-"))
    answer = F.concat(F.when(key % 2 == 0, F.concat(F.lit("see [img a "), key.cast("string"), F.lit(" 3] [img x y z]\n"))).otherwise("none [img a b]\n"), F.lit("[img b c 1]"))
    output = faq_tree.output_name(F.concat(F.lit("/in/f"), key.cast("string"), F.lit(".json")), F.when(key % 3 == 0, "out.md"), F.when(key % 3 == 1, "txt").otherwise(none))
    return table(spark, sf_dir, "part").select("p_partkey", output.alias("output"), faq_tree.line_of_argument(text, F.lit(7)).alias("line"), F.array_join(faq_tree.images(answer), ",").alias("images"))


@query("missing_languages", """SELECT n_name AS key, 'Title ' || n_nationkey AS title FROM nation WHERE n_name <> 'un' AND n_nationkey NOT IN (SELECT DISTINCT c_nationkey FROM customer WHERE c_nationkey % 3 = 0)""")
def missing_languages(spark, sf_dir):
    """Languages that can still be added."""
    nations = table(spark, sf_dir, "nation")
    every = nations.select(F.col("n_name").alias("key"), F.concat(F.lit("Title "), F.col("n_nationkey").cast("string")).alias("title"), F.col("n_regionkey").alias("priority"))
    there = table(spark, sf_dir, "customer").where("c_nationkey % 3 = 0").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("key"))
    return faq_tree.languages_to_add(every, there)


@query("incomplete_entries", TREE + """, p AS (SELECT DISTINCT nth FROM n), x AS (SELECT p.nth, l.lang, n.q, n.a FROM p, (VALUES (0), (1), (2)) l(lang) LEFT JOIN n ON n.nth = p.nth AND n.conv_id = l.lang)
SELECT CASE WHEN nth % 2 = 0 THEN CAST(nth // 2 AS VARCHAR) ELSE nth // 2 || '/0' END AS id FROM x GROUP BY nth HAVING bool_or(coalesce(q, '') = '' OR coalesce(a, '') = '') AND count(q) > 0""")
def incomplete_entries(spark, sf_dir):
    """Entries that one of three languages has not said yet."""
    names = ["lang0", "lang1", "lang2"]
    rows = faq_tree.aligned(trees(spark, sf_dir).where(F.col("language").isin(names)), names)
    return faq_tree.incomplete(rows, names, "New item").select(faq_tree.item_id(F.col("path")).alias("id"))
