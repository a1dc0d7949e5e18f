"""Toxicity from confirmed toxic examples and unlabelled text: non-negative positive-unlabelled learning.

The classifier is linear over the words a text holds. Its risk is estimated without negative examples:
prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)]); where the bracket turns negative the
step goes against it, so that unlabelled positives are not fitted as negatives.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

_EDGE = string.punctuation + "«»“”„’‘…–—¡¿"


@dataclass(frozen=True)
class Classifier:
    """Sorted word codes, their weights, and the bias."""

    codes: np.ndarray
    weights: np.ndarray
    bias: float


class Words(dict):
    """word as split -> code of the word without punctuation at its ends; bounded."""

    def __init__(self, capacity: int = 400_000):
        super().__init__()
        self.capacity = capacity

    def __missing__(self, word: str) -> int:
        code = zlib.crc32(word.strip(_EDGE).encode())
        if len(self) >= self.capacity:
            self.clear()
        if len(word) <= 64:
            self[word] = code
        return code


def word_codes(text: str | None, words: Words) -> set[int]:
    return set(map(words.__getitem__, text.lower().split())) if text else set()


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, features: int = 4096, steps: int = 300, rate: float = 0.1, decay: float = 1e-4, least: int = 5, share_of_positive: float = 0.01, significance: float = 5.0) -> Classifier:
    """Full-batch Adam on the non-negative risk with the logistic loss.

    Words are those that ``least`` positive texts hold and ``share_of_positive`` of them, at least twice as
    often as unlabelled texts and by ``significance`` standard deviations of chance; of more than
    ``features`` such words the most significant. Without positive examples the classifier is a constant below one half.
    """
    if not positive or not unlabelled:
        return Classifier(np.zeros(0, np.int64), np.zeros(0), -20.0)
    count = lambda rows: np.unique(np.concatenate([*rows, np.zeros(0, np.int64)]), return_counts=True)
    codes, n = count(positive)
    often = n >= max(least, share_of_positive * len(positive))
    codes, n = codes[often], n[often] / len(positive)
    every, m = count(unlabelled)
    at = np.searchsorted(every, codes).clip(max=max(len(every) - 1, 0))
    share = np.where(every[at] == codes, m[at], 0) / len(unlabelled)
    spread = (n - share) / np.sqrt((share * (1 - share)).clip(min=1 / len(unlabelled)) / len(positive))
    tell = (spread >= significance) & (n >= 2 * share)
    codes, spread = codes[tell], spread[tell]
    codes = np.sort(codes[np.argsort(-spread, kind="stable")[:features]])
    d = len(codes)

    def matrix(rows):
        found = [np.searchsorted(codes, r[np.isin(r, codes)]) for r in rows]
        return np.concatenate([*found, np.zeros(0, np.int64)]), np.repeat(np.arange(len(rows)), [len(f) for f in found]), len(rows)

    p, u = matrix(positive), matrix(unlabelled)
    at = np.append(np.zeros(d), np.log(prior / (1 - prior)))
    m1, m2 = np.zeros(d + 1), np.zeros(d + 1)
    for step in range(1, steps + 1):
        _, g = risk(at, p, u, prior)
        g[:-1] += decay * at[:-1]
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        at = at - rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    return Classifier(codes, at[:-1], float(at[-1]))


def risk(at: np.ndarray, positive: tuple, unlabelled: tuple, prior: float) -> tuple[float, np.ndarray]:
    """The non-negative risk at (weights, bias), and the direction whose opposite a step takes.

    Examples: (places of words, row of each place, number of rows). Where the part of the risk that stands for
    negative examples is below zero, the direction is that of its negative: the step takes it up again.
    """
    w, b = at[:-1], at[-1]
    (pc, pr, np_), (uc, ur, nu) = positive, unlabelled
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    soft = lambda z: np.logaddexp(0, z)
    zp, zu = b + np.bincount(pr, w[pc], np_), b + np.bincount(ur, w[uc], nu)
    negative = soft(zu).mean() - prior * soft(zp).mean()
    up, uu = prior * sigmoid(zp) / np_, sigmoid(zu) / nu  # of the loss as negatives
    gp, gu = (-prior * sigmoid(-zp) / np_ - up, uu) if negative >= 0 else (up, -uu)
    g = np.append(np.bincount(pc, gp[pr], len(w)) + np.bincount(uc, gu[ur], len(w)), gp.sum() + gu.sum())
    return prior * soft(-zp).mean() + max(0.0, negative), g


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", max_positive: int = 3000, max_unlabelled: int = 12000, max_bytes: int = 96 << 20, prior: float | None = None) -> Classifier:
    """Trains on at most ``max_positive`` different labelled-toxic and ``max_unlabelled`` other texts of ``max_bytes`` in all.

    Both samples are chosen by a hash and bounded by these parameters, so neither copies of a text nor rows
    that share an id fill them; equal texts count once. ``prior``: share of toxic texts; by default that among
    the labelled rows. An id labelled more than once is toxic if any of its labels says so; null labels are
    unlabelled, as are null texts without words.
    """
    spark = docs.sparkSession
    mark = labels.where(F.col(label).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max(label).alias("y"))
    known = mark.agg(F.avg(F.col("y").cast("double")).alias("p")).first()["p"]
    prior = min(0.9, max(0.001, prior if prior is not None else (known or 0.0)))
    marked = mark.where("y = 1").select("id").orderBy(F.xxhash64("id", F.lit(8))).limit(max_positive)
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(F.lit(8), F.col(text)).alias("d"), F.octet_length(text).alias("bytes"))
    different = lambda df, n: df.groupBy("d").agg(F.first("bytes").alias("bytes")).orderBy("d").limit(n).collect()
    chosen: dict[int, list[int]] = {}
    for y, found in ((1, different(texts.join(F.broadcast(marked), "id"), max_positive)), (0, different(texts, max_unlabelled))):
        total = 0
        for r in found:
            total += r["bytes"] or 0
            if total <= max_bytes // (5 if y else 2):  # the codes of words take twice a text's bytes at most
                chosen.setdefault(r["d"], []).append(y)
    picked = spark.createDataFrame([(d, int(1 in ys), int(0 in ys)) for d, ys in chosen.items()], "d long, toxic int, other int")
    rows = texts.join(F.broadcast(picked), "d").groupBy("d").agg(F.first("text").alias("text"), F.first("toxic").alias("toxic"), F.first("other").alias("other"))

    def codes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for batch in batches:
            found = [np.array(sorted(word_codes(t, words)), dtype="<i8").tobytes() for t in batch["text"]]
            yield pd.DataFrame({"d": batch["d"], "toxic": batch["toxic"], "other": batch["other"], "codes": found})

    got = rows.mapInPandas(codes, "d long, toxic int, other int, codes binary").toPandas().sort_values("d")
    arrays = [np.frombuffer(c, "<i8") for c in got["codes"]]
    return train([a for a, y in zip(arrays, got["toxic"]) if y], [a for a, y in zip(arrays, got["other"]) if y], prior)


def score(df: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """Adds score (0 to 1) and predicted (1 if score >= 0.5) for every whole text.

    Null and empty texts get the score of a text without words; a text of any length counts whole, and
    repeated rows get equal scores. Columns of the same names are replaced, all
    others stay; an empty table gives no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def toxic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        weight, words = dict(zip(m.codes.tolist(), m.weights.tolist())), Words()
        known = weight.keys()
        for texts in batches:
            z = np.array([m.bias + sum(weight[c] for c in sorted(word_codes(t, words) & known)) for t in texts], dtype=np.float64)
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -40, 40))))

    return df.withColumn("score", toxic(F.col(text))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
