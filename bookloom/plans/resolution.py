"""Plans that find and resolve duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from bookloom.functions import text as tx
from bookloom.operators import compilation, resolve
from bookloom.plans.registry import query, table

EDGES = "e AS (SELECT doc_id AS dup, lag(doc_id) OVER (PARTITION BY md5(text) ORDER BY doc_id) AS origin FROM documents), ed AS (SELECT * FROM e WHERE origin IS NOT NULL)"
CLOSURE = f"""WITH RECURSIVE {EDGES}, r(dup, far) AS (SELECT dup, origin FROM ed UNION ALL SELECT r.dup, ed.origin FROM r JOIN ed ON ed.dup = r.far),
  roots AS (SELECT dup, far AS root FROM r WHERE far NOT IN (SELECT dup FROM ed))"""


def text_md5():
    return F.md5(F.col("text").cast("binary"))


@query("resolve_cascade", """SELECT o_orderkey, coalesce(c.c_name, d.c_name, 'unknown') AS owner, CASE WHEN c.c_name IS NOT NULL THEN 1 WHEN d.c_name IS NOT NULL THEN 2 ELSE 0 END AS matched
  FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_nationkey < 10) c ON c.c_custkey = o_custkey LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) d ON d.c_custkey = o_orderkey // 10""")
def resolve_cascade(spark, sf_dir):
    """The owner by the order's own link, else by a derived key, else unknown."""
    people = table(spark, sf_dir, "customer")
    by = lambda c: people.where(c).select(F.col("c_custkey").alias("key"), F.col("c_name").alias("owner"))
    out = resolve.cascade(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), [(by("c_nationkey < 10"), F.col("o_custkey"), "link"), (by("c_acctbal > 0"), F.expr("o_orderkey div 10"), "derived")], "owner")
    return out.select("o_orderkey", F.coalesce("owner", F.lit("unknown")).alias("owner"), "matched")


@query("exact_dups", "SELECT md5(text) AS digest, min(doc_id) AS first_id, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_dups(spark, sf_dir):
    return resolve.exact_groups(table(spark, sf_dir, "documents"), "doc_id", text_md5())


@query("dup_closure", f"{CLOSURE} SELECT dup, root FROM roots")
def dup_closure(spark, sf_dir):
    return resolve.roots(resolve.chain_edges(table(spark, sf_dir, "documents"), "doc_id", text_md5()))


@query("merged_ratings", f"""{CLOSURE} SELECT coalesce(root, doc_id) AS book_id, CAST(sum(n_chars) AS BIGINT) AS rate_sum, count(*) AS rate_count, bool_and(source = 'src0') AS deleted, string_agg(source, '|' ORDER BY doc_id) AS series
  FROM documents LEFT JOIN roots ON dup = doc_id GROUP BY 1""")
def merged_ratings(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    books = docs.select(F.col("doc_id").alias("book_id"), F.col("n_chars").alias("rate_sum"), F.lit(1).cast("long").alias("rate_count"), (F.col("source") == "src0").alias("deleted"), F.array("source").alias("series"))
    merged = resolve.merge_into_roots(books, dup_closure(spark, sf_dir))
    return merged.withColumn("series", F.array_join("series", "|"))


@query("merged_series", f"""{CLOSURE}, own AS (SELECT coalesce(root, doc_id) AS book_id, doc_id, source, lang FROM documents LEFT JOIN roots ON dup = doc_id),
 every AS (SELECT book_id, doc_id, 0 AS nth, source AS title FROM own UNION ALL SELECT book_id, doc_id, 1, lang FROM own WHERE doc_id % 2 = 0),
 once AS (SELECT book_id, title, min((doc_id, nth)) AS came FROM every GROUP BY 1, 2)
SELECT book_id, string_agg(title, '|' ORDER BY came) AS series FROM once GROUP BY 1""")
def merged_series(spark, sf_dir):
    """The different series of all that lead to one book, in the order in which they first come."""
    docs = table(spark, sf_dir, "documents")
    series = F.when(F.col("doc_id") % 2 == 0, F.array("source", "lang")).otherwise(F.array("source"))
    books = docs.select(F.col("doc_id").alias("book_id"), F.lit(0.0).alias("rate_sum"), F.lit(0).alias("rate_count"), F.lit(False).alias("deleted"), series.alias("series"))
    return resolve.merge_into_roots(books, dup_closure(spark, sf_dir), unique=True).select("book_id", F.array_join("series", "|").alias("series"))


@query("hamming_pairs", """WITH h AS (SELECT vec_id, label, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS b FROM embeddings)
SELECT a.vec_id AS left_id, b.vec_id AS right_id, CAST(list_sum(list_transform(list_zip(a.b, b.b), lambda z: CASE WHEN z[1] <> z[2] THEN 1 ELSE 0 END)) AS BIGINT) AS distance
FROM h a JOIN h b ON a.label = b.label AND a.vec_id < b.vec_id WHERE list_sum(list_transform(list_zip(a.b, b.b), lambda z: CASE WHEN z[1] <> z[2] THEN 1 ELSE 0 END)) <= 24""")
def hamming_pairs(spark, sf_dir):
    """Sign bits of vectors as 64-bit perceptual hashes, compared inside a label."""
    return resolve.hamming_pairs(sign_bits(table(spark, sf_dir, "embeddings")), "label", "vec_id", "bits", 24).withColumn("distance", F.col("distance").cast("long"))


def sign_bits(vectors):
    """vec_id, label, bits: the signs of 64 components."""
    bits = F.aggregate(F.transform("embedding", lambda x: F.when(x > 0, F.lit(1)).otherwise(F.lit(0)).cast("long")), F.lit(0).cast("long"), lambda acc, b: F.shiftleft(acc, 1).bitwiseOR(b))
    return vectors.select("vec_id", "label", bits.alias("bits"))


NEIGHBOURS = "WITH e AS (SELECT vec_id, label, embedding FROM embeddings UNION ALL SELECT vec_id + 1000000, label, list_concat(list_transform(embedding[1:vec_id % 14], lambda x: -x), embedding[vec_id % 14 + 1:64]) FROM embeddings)"


@query("hamming_block_match", f"""{NEIGHBOURS}, h AS (SELECT vec_id, label, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS b FROM e)
SELECT a.vec_id AS left_id, b.vec_id AS right_id, CAST(list_sum(list_transform(list_zip(a.b, b.b), lambda z: CASE WHEN z[1] <> z[2] THEN 1 ELSE 0 END)) AS BIGINT) AS distance
FROM h a JOIN h b ON a.label = b.label AND a.vec_id < b.vec_id WHERE list_sum(list_transform(list_zip(a.b, b.b), lambda z: CASE WHEN z[1] <> z[2] THEN 1 ELSE 0 END)) <= 10""")
def hamming_block_match(spark, sf_dir):
    """Hashes within ten bits inside a label, eleven bands of them; each vector has a copy with some signs turned."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    turned = F.concat(F.transform(F.slice("embedding", F.lit(1), (F.col("vec_id") % 14).cast("int")), lambda x: -x), F.slice("embedding", (F.col("vec_id") % 14 + 1).cast("int"), F.lit(64)))
    both = rows.unionByName(rows.select((F.col("vec_id") + 1000000).alias("vec_id"), "label", turned.alias("embedding")))
    return resolve.hamming_pairs(sign_bits(both), "label", "vec_id", "bits", 10).withColumn("distance", F.col("distance").cast("long"))


@query("dedup_decisions", """WITH f AS (SELECT d.doc_id AS id, md5(text) AS text_id, n_chars % 7 AS n_images, coalesce(toxic, 1) = 1 AS deleted FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
  k AS (SELECT *, first_value(id) OVER (PARTITION BY text_id ORDER BY n_images DESC, deleted, id DESC) AS origin FROM f) SELECT id AS dup, origin FROM k WHERE id <> origin""")
def dedup_decisions(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    files = table(spark, sf_dir, "documents").join(labels, "doc_id", "left").select(F.col("doc_id").alias("id"), text_md5().alias("text_id"), (F.col("n_chars") % 7).alias("n_images"), (F.coalesce("toxic", F.lit(1)) == 1).alias("deleted"), F.col("doc_id").alias("order_no"))
    return resolve.decide(files)


@query("word_histogram", r"""WITH w AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS word FROM documents),
 c AS (SELECT doc_id, word, count(*) AS n FROM w WHERE word <> '' GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, word) AS rn FROM c)
SELECT doc_id, md5(string_agg(n || ' ' || word, ',' ORDER BY rn)) AS text_id FROM r GROUP BY 1""")
def word_histogram(spark, sf_dir):
    """Text id: md5 of all words with their counts, most frequent first."""
    return compilation.text_ids(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("histogram_top_words", r"""WITH w AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS word FROM documents),
 c AS (SELECT doc_id, word, count(*) AS n FROM w WHERE word <> '' GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, word) AS rn FROM c)
SELECT doc_id, string_agg(word || ' ' || n, ',' ORDER BY rn) AS words FROM r WHERE rn <= 3 GROUP BY 1""")
def histogram_top_words(spark, sf_dir):
    """The three most frequent words of each document."""
    found = table(spark, sf_dir, "documents").where(F.col("text").rlike(compilation.WORD)).select("doc_id", F.slice(compilation.histogram(F.col("text")), 1, 3).alias("x"))
    return found.select("doc_id", F.array_join(F.transform("x", lambda w: F.concat_ws(" ", w["word"], w["n"].cast("string"))), ",").alias("words"))


@query("word_hash", r"""WITH w AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS word FROM documents),
 c AS (SELECT doc_id, word, count(*) AS n FROM w WHERE word <> '' GROUP BY 1, 2), t AS (SELECT doc_id, md5(string_agg(n || ' ' || word, ',' ORDER BY n DESC, word)) AS text_id FROM c GROUP BY 1)
SELECT text_id, min(doc_id) AS first_id, count(*) AS n FROM t GROUP BY 1 HAVING count(*) > 1""")
def word_hash(spark, sf_dir):
    """Documents of the same words, whatever their order: the blocks that image sets are compared in."""
    ids = compilation.text_ids(table(spark, sf_dir, "documents"), "doc_id", "text")
    return ids.groupBy("text_id").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1")


@query("section_tree", """SELECT conv_id, turn, max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS parent
  FROM conversations WHERE role = 'assistant' OR role = 'user'""".replace("SELECT conv_id, turn, max(", "SELECT conv_id, turn, role, max("))
def section_tree(spark, sf_dir):
    """Parents of a depth list: users open a section, assistants lie in the last one before them."""
    rows = table(spark, sf_dir, "conversations").where("role in ('user', 'assistant')").withColumn("depth", F.when(F.col("role") == "user", 0).otherwise(1))
    out = compilation.last_at_depth(rows, "conv_id", "turn", "depth", 0)
    return out.select("conv_id", "turn", "role", "parent")


@query("section_parents", """WITH s AS (SELECT l_orderkey AS doc, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS ord, l_suppkey % 3 AS depth FROM lineitem)
SELECT a.doc, a.ord, max(b.ord) AS parent FROM s a LEFT JOIN s b ON a.doc = b.doc AND b.ord < a.ord AND b.depth < a.depth GROUP BY 1, 2""")
def section_parents(spark, sf_dir):
    """Nearest earlier section of smaller depth, in a list of (depth, section) in page order."""
    order = F.row_number().over(compilation.Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"), order.cast("long").alias("ord"), (F.col("l_suppkey") % 3).cast("int").alias("depth"))
    return compilation.parents(rows, "doc", "ord", "depth").select("doc", "ord", "parent")


@query("compilations", r"""WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS ord FROM documents),
 s AS (SELECT doc_id, md5(line) AS id, min(ord) AS ord FROM l WHERE length(line) >= 20 GROUP BY 1, 2), b AS (SELECT min(doc_id) AS book, md5(line) AS id FROM l WHERE source = 'src0' AND length(line) >= 20 GROUP BY 2),
 f AS (SELECT s.doc_id, s.id, s.ord, b.book, dense_rank() OVER (PARTITION BY s.doc_id ORDER BY s.ord) - 1 AS part FROM s JOIN b ON b.id = s.id),
 t AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1)
SELECT f.doc_id, string_agg(part || ':' || book, ',' ORDER BY part, book) AS found, count(DISTINCT f.id) AS parts, count(DISTINCT f.id) = max(t.n) AS covered FROM f JOIN t USING (doc_id) GROUP BY 1 HAVING count(DISTINCT f.id) > 1""")
def compilations(spark, sf_dir):
    """Lines as sections: documents that hold more than one section of published books, and whether that is all they hold."""
    docs = table(spark, sf_dir, "documents")
    lines = docs.select("doc_id", "source", F.posexplode(F.split("text", "\n"))).select("doc_id", "source", F.md5(F.col("col").cast("binary")).alias("section"), (F.col("pos") + 1).alias("ord"), F.char_length("col").alias("size"))
    books = lines.where("source = 'src0' and size >= 20").groupBy("section").agg(F.min("doc_id").alias("book"))
    return compilation.compilations(lines, books, "doc_id", "book", 20)


@query("title_overlap", r"""WITH t AS (SELECT item_id AS id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: length(x) >= 5) AS w FROM benchmark)
SELECT a.id AS left_id, b.id AS right_id FROM t a JOIN t b ON a.id < b.id WHERE list_has_any(a.w, b.w)""")
def title_overlap(spark, sf_dir):
    """Pairs of titles that share a long word, by the word rather than by all pairs."""
    words = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.explode(tx.title_tokens(F.col("text"))).alias("word")).where(F.char_length("word") >= 5)
    a, b = words.alias("a"), words.alias("b")
    return a.join(b, (F.col("a.word") == F.col("b.word")) & (F.col("a.id") < F.col("b.id"))).select(F.col("a.id").alias("left_id"), F.col("b.id").alias("right_id")).distinct()


@query("title_groups", r"""WITH RECURSIVE w AS (SELECT item_id AS id, unnest(list_distinct(list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: length(x) >= 9))) AS word FROM benchmark),
 r(id, other) AS (SELECT id, id FROM w UNION SELECT r.id, b.id FROM r JOIN w a ON a.id = r.other JOIN w b ON b.word = a.word)
SELECT id, min(other) AS component FROM r GROUP BY 1""")
def title_groups(spark, sf_dir):
    """Titles joined by long words that they share, each word's titles by its first one."""
    words = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.explode(tx.title_tokens(F.col("text"))).alias("word")).where(F.char_length("word") >= 9)
    return resolve.sharing(words)
