"""Plans that read and write formats, and the incremental form of de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from bookloom.plans.registry import query, table
from bookloom.sources import dump, image_stats
from bookloom.sources.shared import folder
from bookloom.streaming import incremental


@query("image_stats_load", """SELECT event_type AS archive, count(*) AS n, CAST(sum(CASE WHEN event_id % 5 <> 0 THEN event_id END) AS BIGINT) AS size FROM events WHERE event_id % 7 <> 0 GROUP BY 1""")
def image_stats_load(spark, sf_dir):
    """Statistics lines written, with comments and short lines among them, and loaded again."""
    at = folder(spark)
    c = F.col
    line = F.concat_ws("|", "event_type", c("event_id").cast("string"), F.lit("1"), F.lit(""), F.lit("0"), F.lit("2"), F.when(c("event_id") % 5 == 0, "0").otherwise(c("event_id").cast("string")), F.lit("10"), F.lit("20"), F.lit("h"))
    line = F.when(c("event_id") % 7 == 0, F.when(c("event_id") % 2 == 0, F.concat(F.lit("#"), line)).otherwise(F.lit("too|few|fields"))).otherwise(line)
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(at)
    return image_stats.read(spark, at).groupBy("archive").agg(F.count(F.lit(1)).alias("n"), F.sum("file_size").alias("size"))


@query("dump_roundtrip", "SELECT c_custkey, c_name || ' it''s \"a\"; (b), c' || chr(10) || 'd\\' AS name, c_acctbal FROM customer")
def dump_roundtrip(spark, sf_dir):
    """Rows written as INSERT statements with escapes and read back."""
    at = folder(spark)
    name = F.concat("c_name", F.lit(" it's \"a\"; (b), c\nd\\"))
    table(spark, sf_dir, "customer").select(dump.statement("people", F.col("c_custkey"), name, F.col("c_acctbal")).alias("value")).write.text(at)
    return dump.read(spark, at, "people", "c_custkey long, name string, c_acctbal double")


@query("incremental_dedup", "SELECT min(doc_id) AS doc_id, md5(text) AS digest FROM documents GROUP BY 2")
def incremental_dedup(spark, sf_dir):
    """Documents arriving in two batches: the store keeps the first of each content."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))
    return incremental.in_batches(docs, "digest", "doc_id", 2)


@query("month_buckets", "SELECT date_trunc('month', ts)::TIMESTAMP AS month, event_type, count(*) AS n, sum(round(value * 100)) AS cents FROM events GROUP BY 1, 2")
def month_buckets(spark, sf_dir):
    out = incremental.month_counts(table(spark, sf_dir, "events"), "ts", "event_type", "value")
    return out.withColumn("month", F.col("month").cast("timestamp_ntz"))
