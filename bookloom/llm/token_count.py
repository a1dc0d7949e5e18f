"""Token counts without a shuffle of pre-tokens: a broadcast first tier of frequent ones, worker caches behind it.

The first tier holds the lengths of the corpus's own most frequent words. Every task counts all words of its texts in a
summary of bounded size, which loses the rarest when it is full, and sends its first few thousand; so what
is added up is a few rows of a task, and what is broadcast has a fixed bound. Which words it holds decides
the speed alone: what it lacks is encoded once and kept in a bounded cache of the worker.
"""

from __future__ import annotations

import collections
import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from bookloom.llm.bpe import Chunks, Encoder, LONGEST


def frequent_words(df: DataFrame, text: str, top: int, task_words: int = 4096, summary: int = 200_000) -> list[str]:
    """The ``top`` words of ``text`` that most tasks' summaries have most often; a word stands behind a space or line feed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counted: collections.Counter[str] = collections.Counter()
        for batch in batches:
            for t in batch["t"]:
                counted.update(t.replace("\n", " \n").split(" ")[1:])
                if len(counted) > summary:
                    counted = collections.Counter(dict(heapq.nlargest(summary // 2, counted.items(), key=lambda x: x[1])))
        best = [(w, n) for w, n in heapq.nlargest(task_words, counted.items(), key=lambda x: x[1]) if w and len(w) <= LONGEST and " " not in w]
        yield pd.DataFrame(best, columns=["word", "n"]).astype({"word": "object", "n": "int64"})

    found = df.select(F.coalesce(F.col(text), F.lit("")).alias("t")).mapInPandas(run, "word string, n long")
    return [r["word"] for r in found.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(top).collect()]


def frequent_lengths(words: list[str], path: str) -> tuple[str, bytes]:
    """Compact table of the first tier: words joined by spaces, and their token counts as bytes (they have no space and few bytes)."""
    encoder = Encoder(path)
    chunks = Chunks(encoder, lambda ids: len(ids) // 4)
    known = [(w, chunks[w]) for w in words]
    known = [(w, n) for w, n in known if n < 256]
    return " ".join(w for w, _ in known), bytes(n for _, n in known)


class Counter:
    """Counts tokens of whole texts exactly as the library does with its defaults."""

    def __init__(self, path: str, first: dict[str, int] | None = None, capacity: int = 700_000):
        self.encoder = Encoder(path, capacity)
        self.chunks = Chunks(self.encoder, lambda ids: len(ids) // 4, first)

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        parts = self.chunks.split(text)
        if parts is None:
            return len(self.encoder.whole(text)) // 4
        return (parts[0] or 0) + sum(parts[1])


def count_tokens(df: DataFrame, path: str, text: str = "text", limit: int = 1024, capacity: int = 700_000, first_tier: int = 65_536) -> DataFrame:
    """Adds n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) to every row.

    ``path``: a byte-level vocabulary file. A null text counts as empty: 0 bytes, 0 tokens. Repeated rows
    are counted each for itself; an empty table gives no rows; an input column of the same name as a result is replaced. No row moves:
    the operator is two maps over the input's partitions, of which the first counts its words for the first
    tier (``first_tier`` words, 2 MB at most). A worker keeps two caches of at most ``capacity``
    chunks of at most 48 characters, some 150 bytes each (100 MB a cache when full); a full one starts anew.
    """
    shared = df.sparkSession.sparkContext.broadcast(frequent_lengths(frequent_words(df, text, first_tier), path))
    kept: dict[str, Counter] = {}

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = kept.get(path)
        if counter is None:
            words, lengths = shared.value
            counter = kept[path] = Counter(path, dict(zip(words.split(" "), lengths)) if lengths else {}, capacity)
        for texts in batches:
            yield pd.Series([counter(t) for t in texts], dtype="int64")

    whole = F.coalesce(F.col(text), F.lit(""))
    return df.withColumns({"n_bytes": F.octet_length(whole).cast("long"), "n_tokens": n_tokens(whole)}).withColumn("over_limit", F.col("n_tokens") > limit)
