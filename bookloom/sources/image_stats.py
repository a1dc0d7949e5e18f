"""Image statistics: lines of ten fields between bars, comment lines among them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

#: The fields of a line, in order.
FIELDS = ("archive", "book_file", "image_id", "fail_info", "is_cover", "pixel_type", "file_size", "width", "height", "hash")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Typed rows; lines that start with # or do not have ten fields are left out; -1 and 0 are unknown sizes."""
    parts = F.split("value", r"\|", -1)
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).select(parts.alias("x")).where(F.size("x") == len(FIELDS)).select(*[F.get("x", F.lit(i)).alias(n) for i, n in enumerate(FIELDS)])
    number = lambda n, missing: F.nullif(F.col(n).try_cast("long"), F.lit(missing).cast("long")).alias(n)
    return rows.select("archive", "book_file", "image_id", F.nullif("fail_info", F.lit("")).alias("fail_info"), (F.col("is_cover") == "1").alias("is_cover"), number("pixel_type", -1), number("file_size", 0), number("width", 0), number("height", 0), F.nullif("hash", F.lit("")).alias("hash"))


def write(rows: DataFrame, path: str) -> None:
    """The same lines, unknown values as -1 or 0."""
    c = lambda n, missing: F.coalesce(F.col(n).cast("string"), F.lit(missing))
    line = F.concat_ws("|", "archive", "book_file", "image_id", c("fail_info", ""), F.when(F.col("is_cover"), "1").otherwise("0"), c("pixel_type", "-1"), c("file_size", "0"), c("width", "0"), c("height", "0"), c("hash", ""))
    rows.select(line.alias("value")).write.text(path)
