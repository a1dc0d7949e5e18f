"""From raw documents to packed sequences: five stages, each one corpus operator over all that the stage before kept.

Texts are read whole by every stage, however long, one at a time by a worker.

Every stage's result is written as Parquet into the folder all executors share and read again as the next
one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from bookloom.llm import decontamination, jaccard_join, language, line_dedup, packing
from bookloom.llm.common import drop_ids, free_name, id_remainder, limit_batches, materialise, shared_folder, table, temporaries

VOCABULARY = "byte_bpe_50k.json"
#: Near duplicates here: five-word shingles, similarity of 0.8 or more.
NEAR_WORDS, NEAR_PERCENT = 5, 80
#: Entries of each of a worker's two token caches: by here the executors' heaps have grown with the stages before.
TOKEN_CACHE = 20_000
#: Bytes of rows that workers get at once, for the same reason; a session that asks for less keeps its own.
BATCH_BYTES = 1 << 20


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language (no letter, empty or null text); ``lang`` becomes the predicted one.

    Learned from the rows that the held-out fold leaves, as the operator's own query does; where those hold no
    label nothing can be recognised and every document goes. Rows are judged each for itself, so repeated and
    null ids stay as they are; null labels teach nothing, other columns of any name stay, an empty table stays
    empty. The rejected rows are left out before the model runs, which would run twice under a filter.
    """
    counts = language.fit(docs.where(id_remainder(F.col("doc_id"), 3) != 1))
    if not counts.languages:
        return docs.where(F.lit(False))
    out = language.identify(docs.where(language.letters(F.col("text"))), counts)
    return out.withColumn("lang", F.col("lang_pred")).select(docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that five or more documents share; every document stays, n_chars follows its text.

    Rows are documents, whatever their ids; of a shared line the rows with the largest id keep it. Null and empty
    texts come out empty, an empty table stays empty, other columns of any name stay.
    """
    out = line_dedup.drop_repeated_lines(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays, that of the smallest id; what has no n-gram stays.

    Rows are told apart by a number of their own, so ids may repeat or be null (null comes after all others).
    Null and blank texts have no n-gram and stay, an empty table stays empty, other columns of any name stay.
    """
    row = free_name(docs, "row")
    rows = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    groups = jaccard_join.similar_documents(rows.select(F.col(row).alias("row"), "text"), key="row", words=NEAR_WORDS, percent=NEAR_PERCENT)
    members = materialise(groups.select("row", F.col("component_id").alias("group")).join(rows.select(F.col(row).alias("row"), "doc_id"), "row"), "members")
    kept = members.groupBy("group").agg(F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1")
    losers = members.join(kept, "group").where("row <> kept")
    return drop_ids(rows, losers.select(F.col("row").alias(row)), key=row).select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of a benchmark item.

    Rows are judged by their text, so of rows that share an id, or have none, only those that hold a passage
    go. Null and empty texts hold none, an empty table stays empty, other columns of any name stay.
    """
    own = free_name(docs, "digest")
    marked = docs.withColumn(own, F.md5(F.col("text").cast("binary")))
    held = decontamination.contaminated(marked.select(F.col(own).alias("digest"), "text"), table(spark, sf_dir, "benchmark"), key="digest")
    return drop_ids(marked, held.select(F.col("digest").alias(own)), key=own).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' tokens in sequences of at most 1024; null and empty texts are their end id alone, rows are packed each for itself."""
    return packing.pack(docs.select("doc_id", "text"), public_tokenizers.path(VOCABULARY), cache=TOKEN_CACHE)


def in_small_batches(stage):
    """``stage`` with batches of at most ``BATCH_BYTES`` for its workers; the setting stays, since the result is written later."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        limit_batches(spark, BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("language", in_small_batches(identified)),
    ("lines", in_small_batches(without_repeated_lines)),
    ("near copies", in_small_batches(without_near_copies)),
    ("benchmark", in_small_batches(without_benchmark)),
    ("packing", in_small_batches(packed)),
]

#: Language identification, packing and the filters between have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and read again.

    What a stage has written on its way is taken away once its result is there.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_folder(spark)}/stage-{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        with temporaries(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
