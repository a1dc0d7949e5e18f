"""Language identification by prediction by partial matching over bytes.

Per language, a tree of byte contexts up to ``order`` bytes long is counted once and then frozen. In a
context with N counts over d different bytes a seen byte has probability count / (N + d); the rest,
d / (N + d), is the escape to the context one byte shorter, shared among the bytes not seen here in
proportion to their probability there. The shortest context falls back to 1/256. The frozen code length
of a byte depends on the ``order`` bytes before it alone, so a text's code length is a sum of table
entries, exact for texts of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from bookloom.llm.common import free_name, trimmed

ORDER = 3


@dataclass(frozen=True)
class Counts:
    """Frozen statistics: for each language the packed 4-byte strings of the training text and their counts."""

    languages: tuple[str, ...]
    grams: tuple[np.ndarray, ...]
    counts: tuple[np.ndarray, ...]


def _packed(text: bytes) -> np.ndarray:
    """Each byte with the three before it as one number; the text is led by three zero bytes."""
    b = np.frombuffer(b"\0" * ORDER + text, dtype=np.uint8).astype(np.uint32)
    return (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]


def fit(labelled: DataFrame, text: str = "text", label: str = "lang", max_docs: int = 1500, max_bytes: int = 8 << 20, total_bytes: int = 256 << 20) -> Counts:
    """Counts over a bounded sample of labelled rows: about ``max_docs`` whole texts or ``max_bytes`` per label, whichever is less.

    Rows are chosen by a hash of their text, so the sample is the same on every run; where a label's texts
    take more than ``max_bytes`` the share taken is smaller, as it is where all labels' texts would take more than
    ``total_bytes``. Every label is learned; rows with a null label
    or text are left out. What reaches the driver is one row per label, and one per different 4-byte string
    and label, bounded by the sample.
    """
    rows = labelled.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(F.col(label).alias("lang"), F.col(text).alias("text"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).collect()
    if not sizes:
        return Counts((), (), ())
    spark, max_bytes = labelled.sparkSession, min(max_bytes, total_bytes // len(sizes))
    share = spark.createDataFrame([(r["lang"], min(1.0, max_docs / r["n"], max_bytes / max(r["bytes"], 1))) for r in sizes], "lang string, share double")
    dice = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / float(1 << 20)
    chosen = rows.join(F.broadcast(share), "lang").where(dice < F.col("share")).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                grams, n = np.unique(np.concatenate([_packed(t.encode()) for t in texts]), return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": grams.astype(np.int64), "n": n.astype(np.int64)})

    found = chosen.mapInPandas(trimmed(count), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    names = tuple(sorted(found["lang"].unique()))
    parts = [found[found["lang"] == x].sort_values("gram") for x in names]
    return Counts(names, tuple(p["gram"].to_numpy(np.uint32) for p in parts), tuple(p["n"].to_numpy(np.float64) for p in parts))


def _place(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted number lies among the sorted keys, and whether it does."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = len(keys) - 1
    return at, keys[at] == wanted


class Tree:
    """One language's contexts, shortest first: code lengths of the bytes seen in each, and of its escape.

    Strings and contexts are sorted numbers looked up by search, 8 bytes each, so a tree takes what its
    training text holds and nothing for strings that it does not.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        keys, chance = np.zeros(0, np.uint64), np.zeros(0)
        for order in range(ORDER + 1):
            below, lower = keys, chance
            keys, own = np.unique(grams.astype(np.uint64) & np.uint64((1 << 8 * (order + 1)) - 1), return_inverse=True)
            n = np.bincount(own, counts, len(keys))
            contexts, at = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, kinds = np.bincount(at, n, len(contexts)), np.bincount(at, minlength=len(contexts))
            # A string seen here was seen in the shorter context too, so its chance there is in the table.
            there = lower[_place(below, keys & np.uint64((1 << 8 * order) - 1))[0]] if order else np.full(len(keys), 1 / 256)
            left = 1 - np.bincount(at, there, len(contexts))  # of the bytes not seen here, in the shorter context
            escapes = np.where(kinds < 256, kinds, 0)
            chance = n / (total + escapes)[at]
            escape = -np.log2(np.where(escapes > 0, escapes / (total + escapes) / np.maximum(left, 1e-300), 1.0))
            self.levels.append((keys.astype(np.uint32), -np.log2(chance).astype(np.float32), contexts.astype(np.uint32), escape.astype(np.float32)))

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each 4-byte string after the three before it."""
        out, open_ = np.zeros(len(grams), np.float32), np.arange(len(grams))
        for order in range(ORDER, -1, -1):
            keys, cost, contexts, escape = self.levels[order]
            wanted = grams[open_] & np.uint32((1 << 8 * (order + 1)) - 1)
            at, seen = _place(keys, wanted)
            out[open_[seen]] += cost[at[seen]]
            open_, wanted = open_[~seen], wanted[~seen]
            at, known = _place(contexts, wanted >> np.uint32(8))
            out[open_[known]] += escape[at[known]]
        out[open_] += 8  # never seen at all: one of 256
        return out


class Model:
    """Trees made from frozen counts; ``bits`` sums code lengths over texts."""

    def __init__(self, counts: Counts, chunk: int = 0):
        self.languages = counts.languages
        self.chunk = chunk or max(1 << 16, (1 << 20) // max(1, len(counts.languages)))  # a chunk's table takes about 4 MB
        self.trees = [Tree(*x) for x in zip(counts.grams, counts.counts)]

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language, in bits."""
        out = np.zeros((len(texts), len(self.languages)))
        group: list[tuple[int, bytes]] = []
        held = 0
        for i, t in enumerate(texts):
            for at in range(0, len(t), self.chunk):
                group.append((i, t[max(0, at - ORDER) : at + self.chunk] if at else b"\0" * ORDER + t[: self.chunk]))
                held += len(group[-1][1])
                if held >= self.chunk:
                    self._add(out, group)
                    group, held = [], 0
        self._add(out, group)
        return out

    def _add(self, out: np.ndarray, group: list[tuple[int, bytes]]) -> None:
        """Adds the code lengths of byte runs, each led by the three bytes before it; a string is looked up once."""
        if not group:
            return
        lengths = np.array([len(x) for _, x in group])
        grams = _packed(b"".join(x for _, x in group))[ORDER:]
        keep = np.ones(len(grams), dtype=bool)
        for b in np.cumsum(lengths)[:-1]:
            keep[b - ORDER : b] = False
        grams = grams[keep]
        different = np.unique(grams)
        cost = np.stack([tree.bits(different) for tree in self.trees], axis=1)
        starts = np.concatenate([[0], np.cumsum(lengths - ORDER)[:-1]])
        sums = np.add.reduceat(cost[np.searchsorted(different, grams)], starts, axis=0, dtype=np.float64)
        np.add.at(out, [i for i, _ in group], sums)


def identify(df: DataFrame, counts: Counts, text: str = "text", unknown: str = "und") -> DataFrame:
    """Adds lang_pred, score (0 to 1) and bits_per_byte to every row; the whole text counts.

    The language with the shortest code wins, ties going to the first by name; the score is the winner's
    share of exp2(-excess bits per byte * 8), so it is 0.5 between two languages that code equally well and
    does not saturate with length. ``unknown`` with score 0 where the text is null or empty or has no
    letter, or nothing was learned. A text of any length counts whole; an empty table gives no rows. Repeated rows get equal results; columns of the same names are replaced,
    all others stay. A later filter on the results would have Spark evaluate the model twice: filter by
    ``letters`` before instead, which rejects the same rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(counts)

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Model(shared.value)
        for texts in batches:
            raw = [(t or "").encode() for t in texts]
            bits = model.bits(raw)
            n = np.maximum(np.array([len(r) for r in raw]), 1)
            best = bits.argmin(axis=1)
            rate = bits[np.arange(len(raw)), best] / n
            weight = np.exp2(-8 * (bits / n[:, None] - rate[:, None]))
            yield pd.DataFrame({"lang_pred": [model.languages[i] for i in best], "score": 1 / weight.sum(axis=1), "bits_per_byte": rate})

    known = F.lit(bool(counts.languages)) & letters(F.col(text))
    held = free_name(df, "prediction")
    guess = F.pandas_udf(trimmed(predict), "lang_pred string, score double, bits_per_byte double")
    out = df.withColumn(held, guess(F.col(text)) if counts.languages else F.lit(None).cast("struct<lang_pred:string,score:double,bits_per_byte:double>"))
    pick = lambda c, other: F.when(known, F.col(f"{held}.{c}")).otherwise(other)
    return out.withColumns({"lang_pred": pick("lang_pred", F.lit(unknown)), "score": pick("score", F.lit(0.0)), "bits_per_byte": pick("bits_per_byte", F.lit(None))}).drop(held)


def letters(text: Column) -> Column:
    """Whether a text has a letter at all; false for null."""
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
