"""Published files: written in parallel into partitioned folders, in order where order counts, and read back.

Spark writes a folder of part files for what the original packs into one archive: a partition folder stands for
an archive, and within it the names of the parts follow the order of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from bookloom.operators import publish


def _in_order(rows: DataFrame, by: str, order: list[str]) -> DataFrame:
    """Dealt by ranges and sorted inside them, so a folder may hold most of the rows and still be written by many tasks."""
    return rows.repartitionByRange(by, *order).sortWithinPartitions(by, *order)


def write_checked(rows: DataFrame, path: str, format: str = "parquet", partition: str | None = None, **options: str) -> int:
    """Writes and reads back; the number of rows, or an error if that or the rows' digests differ.

    What is written is counted and digested on its way, so its plan runs once. Digests add up, so a row that
    came twice does not make up for another that was lost.
    """
    own = F.xxhash64(*[F.col(c).cast("string") for c in sorted(rows.columns)]).cast("decimal(38,0)")
    totals = [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(own), F.lit(0).cast("decimal(38,0)")).alias("digest")]
    seen = Observation()
    writer = rows.observe(seen, *totals).write.format(format).options(**options)
    (writer.partitionBy(partition) if partition else writer).save(path)
    got = rows.sparkSession.read.schema(rows.schema).format(format).options(**options).load(path).agg(*totals).first()
    want = seen.get
    if (want["n"], want["digest"]) != (got["n"], got["digest"]):
        raise OSError(f"{path} holds {got['n']} rows of {want['n']}, or other ones")
    return want["n"]


def write_tables(tables: dict[str, DataFrame], path: str, partition: dict[str, str] | None = None) -> None:
    """Each table in a folder of its own; ``partition`` names the column that readers look rows up by."""
    for name, rows in tables.items():
        by = (partition or {}).get(name)
        writer = rows.write
        (writer.partitionBy(by) if by else writer).parquet(f"{path}/{name}")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, by the file system that it names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def open_or_build(spark: SparkSession, path: str, build) -> DataFrame:
    """The table at ``path`` if it was completed before, otherwise ``build()`` written there and read."""
    if not exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_index(rows: DataFrame, path: str, collection: str, version: str) -> None:
    """``rows``: folder, place, line (of ``publish.index_line``). A folder of lines per archive, in place order, and info files."""
    spark = rows.sparkSession
    lines = _in_order(rows, "folder", ["place"]).select("folder", F.regexp_replace("line", "\r\n$", "").alias("value"))
    lines.write.partitionBy("folder").option("lineSep", "\r\n").text(f"{path}/inp")
    info = [("structure", ";".join(publish.FIELDS).upper()), ("version", version), ("collection", collection)]
    spark.createDataFrame(info, "info string, value string").write.partitionBy("info").text(f"{path}/info")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """folder and the fields of every line."""
    lines = spark.read.option("lineSep", "\r\n").text(f"{path}/inp")
    return lines.select("folder", *publish.index_fields(F.col("value")))


def series_lines(books: DataFrame, fields: list[Column]) -> DataFrame:
    """One index line per series of a book (array of level, title, number): folder, place, line.

    ``fields``: the seventeen columns over ``books`` with ``title`` and ``number`` of the series standing for its two.
    """
    each = books.select("*", F.posexplode("series").alias("series_at", "one")).withColumns({"series_title": F.col("one.title"), "series_number": F.col("one.number")})
    return each.select("folder", (F.col("place") * 1000 + F.col("series_at")).alias("place"), publish.index_line(*fields).alias("line"))


def write_contents(rows: DataFrame, path: str) -> None:
    """``rows``: lang, place, line. A folder of lines per language."""
    _in_order(rows, "lang", ["place"]).select("lang", F.col("line").alias("value")).write.partitionBy("lang").text(path)


def write_reviews(rows: DataFrame, path: str) -> None:
    """``rows``: month (yyyymm), folder, file, reviews (JSON). A folder per month, one document per book."""
    rows.write.partitionBy("month").json(path)


def write_json(rows: DataFrame, path: str) -> None:
    """Rating sums or compilations: one document per line."""
    rows.write.json(path)


def xml_text(value: Column) -> Column:
    out = value
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return out


def write_annotations(rows: DataFrame, path: str) -> None:
    """``rows``: folder, file, annotation. A folder of XML lines per archive, by file name."""
    line = F.concat(F.lit('<item file="'), xml_text(F.col("file")), F.lit('">'), xml_text(F.replace("annotation", F.lit("\n"), F.lit(" "))), F.lit("</item>"))
    _in_order(rows, "folder", ["file"]).select("folder", line.alias("value")).write.partitionBy("folder").text(path)


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.text(path)
    return rows.select("folder", F.xpath_string("value", F.lit("/item/@file")).alias("file"), F.xpath_string("value", F.lit("/item")).alias("annotation"))


def write_packs(packs: DataFrame, path: str) -> None:
    """``packs``: bucket, author_key, body, files. A folder per bucket.

    A bucket, which is a bounded range of ids, is written by one task: if every task had some of every bucket, files would be
    as many as tasks times buckets, which both grow with the notes.
    """
    packs.repartition("bucket").write.partitionBy("bucket").parquet(path)


def quarantine(rows: DataFrame, reason: Column, path: str) -> DataFrame:
    """Rows without a ``reason``; those with one are written to ``path`` with it."""
    marked = rows.withColumn("reason", reason)
    marked.where("reason is not null").write.parquet(path)
    return marked.where("reason is null").drop("reason")
