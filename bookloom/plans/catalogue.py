"""Plans of the catalogue: books with authors, genres, series and ratings, and corrections to them."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from bookloom.functions import text as tx
from bookloom.operators import catalogue as cat, corrections
from bookloom.plans.registry import ORACLES, QUERIES, query, table


def all_queries():
    for name in ("resolution", "publication", "texts", "extensions", "images", "stores", "files"):
        importlib.import_module(f"bookloom.plans.{name}")
    return QUERIES


def all_oracles():
    all_queries()
    return ORACLES


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("book_id"), F.col("l_quantity").cast("int").cast("string").alias("rate"))


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("book_id"), F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")).alias("title"), F.col("o_totalprice").cast("long").alias("size"),
        F.when(F.col("o_orderstatus") == "F", "1").otherwise("0").alias("deleted"), F.when(F.col("o_orderstatus") == "O", "").otherwise("fb2").alias("file_type"), F.col("o_orderdate").alias("time"),
        F.lit("ru").alias("lang"), F.col("o_orderpriority").alias("keywords"), F.when(F.col("o_orderstatus") == "P", 0).otherwise(F.year("o_orderdate")).alias("year"), F.md5(F.col("o_orderkey").cast("string").cast("binary")).alias("md5"),
    )


def author_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("book_id"), F.col("l_suppkey").alias("author_id"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("pos"))


def author_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as authors: every seventh is an alias of another, one nation are illustrators."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("author_id"), F.col("s_name").alias("last"), F.col("s_nationkey").cast("string").alias("first"), F.when(F.col("s_acctbal") > 0, "M").alias("middle"),
        F.when(F.col("s_nationkey") == 3, "illustrator").when(F.col("s_acctbal") > 0, "").alias("nick"), F.when(F.col("s_suppkey") % 7 == 0, (F.col("s_suppkey") / 7).cast("long")).alias("master_id"),
    )


def genre_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("book_id"), F.col("l_partkey").alias("genre_id"))
    return links.join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("genre_id"), F.col("p_type").alias("code")), "genre_id")


def series_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("book_id"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"))
    return links.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select("book_id", F.col("p_brand").alias("series"), (F.col("l_suppkey") % 10).cast("string").alias("number"), F.lit(0).alias("type"), F.col("p_size").cast("double").alias("level"), F.col("l_partkey").alias("series_id"))


RATES = "r AS (SELECT l_orderkey AS id, sum(CAST(CAST(l_quantity AS INT) AS DOUBLE)) AS s, count(l_quantity) AS n FROM lineitem GROUP BY 1)"
AUTHORS = """nm AS (SELECT s_suppkey AS aid, s_name AS ln, CAST(s_nationkey AS VARCHAR) AS fn, CASE WHEN s_acctbal > 0 THEN 'M' END AS mn,
    CASE WHEN s_nationkey = 3 THEN 'illustrator' WHEN s_acctbal > 0 THEN '' END AS nick, CASE WHEN s_suppkey % 7 = 0 THEN s_suppkey // 7 END AS master FROM supplier),
  lk AS (SELECT l_orderkey AS id, l_suppkey AS aid, l_linenumber AS p, l_partkey AS p2, nm.nick AS nick,
    CASE WHEN m.aid IS NULL THEN nm.ln || ',' || nm.fn || ',' || nm.mn ELSE m.ln || ',' || m.fn || ',' || m.mn END AS label
    FROM lineitem JOIN nm ON nm.aid = l_suppkey LEFT JOIN nm m ON nm.master = m.aid),
  au AS (SELECT id, string_agg(label, ':' ORDER BY p, p2, aid) || ':' AS authors FROM lk x
    WHERE nick <> 'illustrator' OR NOT EXISTS (SELECT 1 FROM lk y WHERE y.id = x.id AND y.nick <> 'illustrator') GROUP BY id)"""
GENRES = "ge AS (SELECT l_orderkey AS id, string_agg(p_type, ':' ORDER BY l_partkey, p_type) || ':' AS genres FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)"


@query(
    "rating_by_book",
    f"""WITH {RATES} SELECT o_orderkey AS book_id, s AS rate_sum, coalesce(n, 0) AS rate_count,
      CASE WHEN round(s / n) BETWEEN 1 AND 5 THEN CAST(round(s / n) AS BIGINT) END AS lib_rate FROM orders LEFT JOIN r ON o_orderkey = id""",
)
def rating_by_book(spark, sf_dir):
    return cat.with_ratings(books(spark, sf_dir).select("book_id"), ratings(spark, sf_dir)).withColumn("lib_rate", cat.lib_rate("rate_sum", "rate_count"))


@query("author_list", f"WITH {AUTHORS} SELECT id AS book_id, authors FROM au WHERE authors IS NOT NULL")
def author_list(spark, sf_dir):
    return cat.author_lists(author_links(spark, sf_dir), author_names(spark, sf_dir), illustrator="illustrator").where("authors is not null")


@query("author_list_role", """SELECT l_orderkey AS book_id, string_agg(s_name, ':' ORDER BY l_linenumber, l_partkey, l_suppkey) || ':' AS authors
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_returnflag = 'A' GROUP BY 1""")
def author_list_role(spark, sf_dir):
    """The second dialect keeps links of one role."""
    links = table(spark, sf_dir, "lineitem").where("l_returnflag = 'A'").select(F.col("l_orderkey").alias("book_id"), F.col("l_suppkey").alias("author_id"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("pos"))
    names = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("author_id"), F.col("s_name").alias("label"))
    return cat.joined_list(links.join(names, "author_id"), "label", "pos", "authors")


@query("genre_list", f"WITH {GENRES} SELECT id AS book_id, genres FROM ge")
def genre_list(spark, sf_dir):
    return cat.joined_list(genre_links(spark, sf_dir).withColumn("pos", F.struct("genre_id", "code")), "code", "pos", "genres")


@query(
    "catalog_rows",
    f"""WITH {RATES}, {AUTHORS}, {GENRES},
  se AS (SELECT l_orderkey AS id, p_brand, CAST(l_suppkey % 10 AS VARCHAR) AS num, CAST(p_size AS DOUBLE) AS level, l_partkey FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber = 1)
SELECT o_orderkey AS book_id, authors, genres, trim(o_orderpriority) AS title, p_brand AS series, num AS number, CAST(floor(o_totalprice) AS BIGINT) AS size, CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END AS deleted,
  CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END <> '0' AS is_deleted, 'fb2' AS file_type, strftime(o_orderdate, '%Y-%m-%d') AS date, 'ru' AS lang, s AS rate_sum, coalesce(n, 0) AS rate_count, o_orderpriority AS keywords,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS INT) END AS year, md5(CAST(o_orderkey AS VARCHAR)) AS md5, CASE WHEN p_brand IS NOT NULL THEN 0 END AS series_type, level AS series_level
FROM orders LEFT JOIN r ON r.id = o_orderkey LEFT JOIN au ON au.id = o_orderkey LEFT JOIN ge ON ge.id = o_orderkey LEFT JOIN se ON se.id = o_orderkey""",
)
def catalog_rows(spark, sf_dir):
    """The whole catalogue row: ratings summed before the series fan out."""
    genres = genre_list(spark, sf_dir)
    authors = cat.author_lists(author_links(spark, sf_dir), author_names(spark, sf_dir), illustrator="illustrator")
    return cat.catalogue(books(spark, sf_dir), ratings(spark, sf_dir), authors, genres, series_links(spark, sf_dir))


@query("book_assembly", """WITH s AS (SELECT l_orderkey AS id, p_brand, CAST(l_suppkey % 10 AS INT) AS num, CAST(p_size AS DOUBLE) AS level, l_partkey FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber = 1)
SELECT CAST(id AS VARCHAR) || '.fb2' AS file_key, string_agg(p_brand || '#' || num, '|' ORDER BY level DESC, p_brand, num) AS series, count(*) AS n_series FROM s GROUP BY id""")
def book_assembly(spark, sf_dir):
    """Rows of one file become one book that holds its series, ordered by type and falling level."""
    rows = series_links(spark, sf_dir).withColumn("file_key", tx.file_key(F.lit(None).cast("string"), F.col("book_id"), F.lit("FB 2"))).withColumn("number", tx.leading_int(F.col("number")))
    books_ = cat.assemble(rows, ["file_key"])
    return books_.select("file_key", F.array_join(F.transform("series", lambda s: F.concat(s["title"], F.lit("#"), s["number"])), "|").alias("series"), F.size("series").cast("long").alias("n_series"))


@query("orphan_keep", "SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def orphan_keep(spark, sf_dir):
    return cat.without_orphans(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey").select("o_orderkey", "o_custkey")


@query("orphan_drop", "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def orphan_drop(spark, sf_dir):
    return cat.orphans(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey").select("o_orderkey", "o_custkey")


@query("replacement_apply", """SELECT s_suppkey AS id, coalesce(translate(regexp_replace('Set ' || n_name || ' (' || CAST(n_regionkey AS VARCHAR) || ') x: a, b', '^(.*?)\\((.*?)\\)\\s*(.*)$', '\\1[\\2]\\3'), ',:', ';'), s_name) AS title
  FROM supplier LEFT JOIN nation ON n_nationkey = s_suppkey""".replace("\\\\", "\\"))
def replacement_apply(spark, sf_dir):
    """Titles overridden by id from a correction table, after its own normalisation."""
    source = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.concat(F.lit("Set "), "n_name", F.lit(" ("), F.col("n_regionkey").cast("string"), F.lit(") x: a, b")).alias("title"))
    source = source.withColumn("title", tx.scrub_separators(tx.bracket_series(F.col("title"))))
    return corrections.override(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("title")), source, "id", ["title"])


@query("link_append", """SELECT DISTINCT l_orderkey, l_suppkey FROM (SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_linenumber <= 3 UNION ALL SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_linenumber >= 3)""")
def link_append(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    pick = lambda c: rows.where(c).select("l_orderkey", "l_suppkey")
    return corrections.append_missing(pick("l_linenumber <= 3"), pick("l_linenumber >= 3"), ["l_orderkey", "l_suppkey"])


@query("file_key", r"""SELECT page_id, regexp_replace(regexp_extract(url, '([^/]*)$', 1), '\.[^.]*$', '') AS base, lower(regexp_extract(url, '\.([^./]*)$', 1)) AS suffix,
  CASE WHEN page_id % 2 = 0 THEN CAST(page_id AS VARCHAR) || '.fb2' ELSE regexp_replace(regexp_extract(url, '([^/]*)$', 1), '\.[^.]*$', '') || '.' || lower(regexp_extract(url, '\.([^./]*)$', 1)) END AS file_key FROM pages""")
def file_key(spark, sf_dir):
    name = F.when(F.col("page_id") % 2 != 0, F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", tx.base_name(F.col("url")).alias("base"), tx.suffix(F.col("url")).alias("suffix"), tx.file_key(name, F.col("page_id"), F.lit("fd2")).alias("file_key"))
