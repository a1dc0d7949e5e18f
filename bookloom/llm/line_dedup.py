"""Removal of lines that many documents share, with two Bloom filters in front of the exact count.

Pass one sets, for every line long enough, a bit in the once-seen filter, and in the twice-seen filter
where that bit was set before. Filters are built per task as sorted bit positions, cut into blocks and
merged block by block. Pass two sends only lines whose bit is in the twice-seen filter through a shuffle,
where their documents are counted exactly. Pass three drops the confirmed lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from bookloom.llm import bloom
from bookloom.llm.common import free_name, materialise, trimmed

#: White space that a key loses at both ends.
STRIPPED = " \t\n\x0b\x0c\r"


def key_of(line: str, least: int) -> bytes | None:
    """The line's key, or None if it has fewer than ``least`` code points."""
    key = line.strip(STRIPPED)
    return key.encode().lower() if len(key) >= least else None  # bytes.lower() changes A-Z alone


def _keys(text: str | None, least: int) -> set[bytes]:
    return {k for line in text.split("\n") if (k := key_of(line, least))} if text else set()


def _hashes(keys) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)


def repeated_lines(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = 40, min_docs: int = 5, bits: int = 27) -> tuple[DataFrame, DataFrame]:
    """(suspects: line, id) and (confirmed lines in at least ``min_docs`` documents: line, keep).

    The filter has 2^``bits`` bits (16 MB at 27). ``keep`` is the largest id holding the line. Every row is one
    document, also one that repeats another's id; a null id is below all others.
    """
    each_line = lambda batches: (_hashes(_keys(words, least)) for batch in batches for words in batch["t"])
    twice = df.sparkSession.sparkContext.broadcast(bloom.build(df.select(F.col(text).alias("t")), each_line, bits))

    def suspects(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = twice.value.table()
        for batch in batches:
            keys = [list(_keys(words, least)) for words in batch["t"]]
            lines = [k for own in keys for k in own]
            may = bloom.passes(seen, _hashes(lines), bits)
            ids = batch["k"].repeat([len(own) for own in keys])
            yield pd.DataFrame({"line": np.array(lines, dtype=object)[may], "id": ids.array[may]})

    rows = df.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).mapInPandas(trimmed(suspects), "line binary, id long")
    confirmed = rows.groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keep")).where(F.col("n") >= min_docs)
    return rows, confirmed.select("line", "keep")


def drop_repeated_lines(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = 40, min_docs: int = 5, bits: int = 27, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """Every row with ``text`` replaced by its kept lines, and n_lines (before), n_dropped.

    A text splits at line feeds; null and empty texts are one empty line and come out empty. A line whose
    key (white space stripped, A-Z lower-cased) has at least ``least`` code points and is held by at least
    ``min_docs`` rows goes everywhere but in the rows with the largest id that hold it, where all its
    copies stay. Texts of any length are cut whole, one at a time; an empty table gives no rows. The confirmed lines are broadcast if they take at most ``broadcast_bytes``; otherwise each
    id gets its own lines by joins. Input columns named n_lines or n_dropped are replaced.
    """
    rows, confirmed = repeated_lines(df, key, text, least, min_docs, bits)
    confirmed = materialise(confirmed, "lines")
    total = confirmed.agg(F.coalesce(F.sum(F.octet_length("line") + 100), F.lit(0)).alias("n")).first()["n"]
    schema = "kept string, n_lines long, n_dropped long"
    result, gone_from, gone_lines = (free_name(df, x) for x in ("cut", "lost_id", "lost"))

    def apply(texts, is_gone) -> pd.DataFrame:
        out = []
        for i, words in enumerate(texts):
            lines = (words or "").split("\n")
            kept = [x for x in lines if (k := key_of(x, least)) is None or not is_gone(i, k)]
            out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
        return pd.DataFrame(out, columns=["kept", "n_lines", "n_dropped"])

    if total <= broadcast_bytes:
        known = df.sparkSession.sparkContext.broadcast({bytes(r["line"]): r["keep"] for r in confirmed.collect()})

        def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            keep = known.value
            for texts, ids in batches:
                own = [None if x < 0 and x == -(1 << 63) else x for x in ids.tolist()]
                yield apply(texts, lambda i, k: k in keep and keep[k] != own[i])

        own_id = F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)).cast("long"))
        out = df.withColumn(result, F.pandas_udf(trimmed(cut), schema)(F.col(text), own_id))
    else:
        lost = rows.join(confirmed, "line").where(~F.col("id").eqNullSafe(F.col("keep"))).groupBy(F.col("id").alias(gone_from)).agg(F.collect_set("line").alias(gone_lines))

        @F.pandas_udf(schema)
        def cut_own(texts: pd.Series, lost: pd.Series) -> pd.DataFrame:
            gone = [set() if x is None else {bytes(y) for y in x} for x in lost]
            return apply(texts, lambda i, k: k in gone[i])

        both = df.join(lost, df[key].cast("long").eqNullSafe(lost[gone_from]), "left")
        out = both.withColumn(result, cut_own(F.col(text), F.col(gone_lines))).drop(gone_lines, gone_from)
    return out.withColumns({text: F.col(f"{result}.kept"), "n_lines": F.col(f"{result}.n_lines"), "n_dropped": F.col(f"{result}.n_dropped")}).drop(result)
