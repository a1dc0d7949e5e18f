"""Approximate nearest neighbours by cosine: inverted lists with an adaptive dimension scan.

Vectors are normalised and turned by a random rotation, so that any few of their columns are a fair sample
of all. Within a probed list the distance to a query grows column block by column block; a candidate whose
partial distance, scaled to all columns, lies significantly above the query's k-th best is abandoned.
Equal vectors are one candidate class throughout, so a vector that holds a third of all rows costs one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from bookloom.llm.common import materialise


@dataclass(frozen=True)
class Index:
    """Rotation (columns), centres of the lists in rotated space, how many lists a query probes, and their sizes."""

    rotation: np.ndarray
    centres: np.ndarray
    probes: int
    sizes: np.ndarray | None = None

    def near(self, vectors: np.ndarray) -> np.ndarray:
        """Nearness of each vector to each list."""
        return _unit(vectors) @ self.rotation @ self.centres.T

    def probed(self, vectors: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(vector, list) of every probe: the nearest ``probes`` lists, and more where these hold fewer than ``least`` vectors."""
        order = np.argsort(-self.near(vectors), axis=1, kind="stable")
        held = np.cumsum(self.sizes[order], axis=1)
        n = np.maximum(self.probes, (held < least).sum(axis=1) + 1).clip(max=order.shape[1])
        at, place = np.nonzero(np.arange(order.shape[1])[None, :] < n[:, None])
        return at, order[at, place].astype("int32")


def usable(vector: Column) -> Column:
    """Not null, not zero, every component finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column]) if len(column) else np.zeros((0, 0))


def fit(classes: DataFrame, rows: int, k: int = 5, sample: int = 20_000, most_lists: int = 4096, recall: float = 0.97, rounds: int = 8) -> Index:
    """Rotation and centres from at most ``sample`` vectors, chosen by a hash of their smallest id.

    sqrt(rows) lists, at most ``most_lists``. A query probes as many as hold a share of ``recall`` of the ``k``
    nearest sample vectors of 512 of them; all vectors lie closer together than a sample of them, so no fewer
    of their neighbours do.
    """
    took = classes.orderBy(F.xxhash64("cid")).limit(sample).select("embedding").toPandas()
    x = _unit(_matrix(took["embedding"]))
    rng = np.random.default_rng(5)
    rotation, _ = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))
    x = x @ rotation
    lists = int(min(max(1, round(rows**0.5)), most_lists, len(x)))
    centres = x[rng.choice(len(x), lists, replace=False)]
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        centres = np.where(size > 0, total / np.maximum(size, 1e-12), centres)
    if len(x) < 2:
        return Index(rotation, centres, lists)
    own = (x @ centres.T).argmax(axis=1)
    asked = x[:512]
    cosine = asked @ x.T
    cosine[np.arange(len(asked)), np.arange(len(asked))] = -9
    nearest = np.argpartition(-cosine, min(k, len(x) - 1) - 1, axis=1)[:, : min(k, len(x) - 1)]
    rank = np.argsort(np.argsort(-(asked @ centres.T), axis=1), axis=1)  # of each list for each query
    places = np.sort(np.take_along_axis(rank, own[nearest], axis=1), axis=None)
    return Index(rotation, centres, int(places[int(np.ceil(recall * len(places))) - 1]) + 1)


def scan(queries: np.ndarray, vectors: np.ndarray, k: int, block: int = 16, strictness: float = 2.1) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) of the pairs that the adaptive scan of rotated unit vectors has not abandoned, by query."""
    n, columns = len(vectors), vectors.shape[1]
    if n <= k:
        return np.repeat(np.arange(len(queries)), n), np.tile(np.arange(n), len(queries))
    first = min(block, columns)
    partial = ((queries[:, :first] ** 2).sum(axis=1)[:, None] + (vectors[:, :first] ** 2).sum(axis=1)[None, :]) - 2 * queries[:, :first] @ vectors[:, :first].T
    pilot = np.argpartition(partial, min(4 * k, n - 1), axis=1)[:, : 4 * k]
    exact = ((vectors[pilot] - queries[:, None, :]) ** 2).sum(axis=2)
    limit = np.partition(exact, k - 1, axis=1)[:, k - 1] + 1e-9  # of the k-th best so far
    bound = lambda d: d / columns * (1 + strictness / np.sqrt(d)) ** 2 if d < columns else 1.0
    q, v = np.nonzero(partial <= limit[:, None] * bound(first))
    far = partial[q, v]
    for at in range(first, columns, block):
        end = min(at + block, columns)
        far = far + ((queries[q, at:end] - vectors[v, at:end]) ** 2).sum(axis=1)
        stays = far <= limit[q] * bound(end)
        q, v, far = q[stays], v[stays], far[stays]
    left = np.zeros((len(queries), n), dtype=bool)
    left[q, v] = True
    left[np.arange(len(queries))[:, None], pilot] = True
    return np.nonzero(left)


def search(df: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 5, recall: float = 0.97, sample: int = 20_000, block_rows: int = 4096) -> DataFrame:
    """query_id, rank, the neighbour's id (``key``) and score: each query's ``k`` nearest other rows.

    Score is the cosine of the original vectors in double precision; ties go to the smaller id. Vectors
    that are null, zero, or hold null or non-finite components take no part, nor do rows with a null id or
    with another number of components than most rows have. Rows repeating an id count as one. Every usable
    vector is indexed; only the rotation, the centres and the number of probes come from a bounded sample
    (see ``fit``). Lists are cut into blocks of about ``block_rows``, and so are the queries that probe a list;
    a task holds one block of each at a time. An empty table gives no rows. Vectors of floats stay floats on
    the way; all others are taken as doubles.
    """
    spark = df.sparkSession
    kind = "array<float>" if df.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast(kind).alias("embedding"), is_query.alias("is_query")).where(F.col("id").isNotNull() & usable(F.col("embedding")))
    schema = "query_id long, rank int, id long, score double"
    sizes = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], schema).withColumnRenamed("id", key)
    rows = rows.where(F.size("embedding") == sizes[0]["n"]).withColumn("same", F.md5(F.col("embedding").cast("string")))
    # The k + 1 smallest ids of each different vector are all that any answer can need.
    smallest = rows.withColumn("at", F.row_number().over(Window.partitionBy("same").orderBy("id"))).where(F.col("at") <= k + 1)
    classes = materialise(smallest.groupBy("same").agg(F.array_distinct(F.array_sort(F.collect_list("id"))).alias("members"), F.min_by("embedding", "id").alias("embedding")).withColumn("cid", F.get("members", F.lit(0))), "vectors")
    asked = materialise(rows.where("is_query").select(F.col("id").alias("query_id"), "same").distinct().join(classes.select("same", F.col("cid").alias("qcid"), F.col("embedding")), "same").drop("same"), "queries")
    index = fit(classes, classes.count(), k, sample, recall=recall)
    first = spark.sparkContext.broadcast(index)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(list=first.value.near(_matrix(batch["embedding"])).argmax(axis=1).astype("int32"))

    held = materialise(classes.select("cid", "embedding").mapInPandas(assign, f"cid long, embedding {kind}, list int"), "lists")
    sizes = np.zeros(len(index.centres), np.int64)
    for r in held.groupBy("list").count().collect():  # at most one row per list
        sizes[r["list"]] = r["count"]
    shared = spark.sparkContext.broadcast(replace(index, sizes=sizes))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                at, lists = shared.value.probed(_matrix(batch["embedding"]), k + 1)
                yield batch.iloc[at].assign(list=lists)

    blocks = held.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    held = held.join(F.broadcast(blocks), "list").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")).drop("blocks")
    probing = asked.select("qcid", "embedding").dropDuplicates(["qcid"]).mapInPandas(probe, f"qcid long, embedding {kind}, list int")
    # A list's queries are cut like its vectors; each block of one side meets each block of the other.
    parts = probing.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("parts"))
    cuts = materialise(blocks.join(parts, "list"), "cuts")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = held.join(F.broadcast(cuts.select("list", "parts")), "list").withColumn("part", every("parts")).drop("parts")
    probing = probing.join(F.broadcast(cuts), "list").withColumn("part", F.pmod(F.xxhash64("qcid"), F.col("parts")).cast("int")).withColumn("block", every("blocks")).drop("blocks", "parts")

    def nearest(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"qcid": pd.Series([], dtype="int64"), "score": pd.Series([], dtype="float64"), "cid": pd.Series([], dtype="int64")})]
        if not len(vectors) or not len(queries):
            return out[0]
        rotation = shared.value.rotation
        v, ids = _matrix(vectors["embedding"]), vectors["cid"].to_numpy()
        vr, vn = _unit(v) @ rotation, np.sqrt((v * v).sum(axis=1))
        for at in range(0, len(queries), 256):
            part = queries.iloc[at : at + 256]
            x = _matrix(part["embedding"])
            q, left = scan(_unit(x) @ rotation, vr, k + 1)
            cosine = np.einsum("ij,ij->i", v[left], x[q]) / (vn[left] * np.sqrt((x * x).sum(axis=1))[q])
            order = np.lexsort((ids[left], -cosine, q))
            order = order[np.arange(len(order)) - np.searchsorted(q, q)[order] <= k]  # pairs come by query
            out.append(pd.DataFrame({"qcid": part["qcid"].to_numpy()[q[order]], "score": cosine[order], "cid": ids[left[order]]}))
        return pd.concat(out)

    met = held.groupBy("list", "block", "part").cogroup(probing.groupBy("list", "block", "part")).applyInPandas(nearest, "qcid long, score double, cid long")
    best = met.withColumn("at", F.row_number().over(Window.partitionBy("qcid").orderBy(F.desc("score"), "cid"))).where(F.col("at") <= k + 1)
    named = best.join(classes.select("cid", "members"), "cid")
    flat = named.select("qcid", F.explode(F.transform("members", lambda m: F.struct((-F.col("score")).alias("far"), m.alias("id")))).alias("x"))
    answers = flat.groupBy("qcid").agg(F.array_sort(F.collect_list("x")).alias("found"))  # at most (k + 1)^2 each
    joined = asked.select("query_id", "qcid").join(answers, "qcid")
    own = joined.select("query_id", F.posexplode(F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k)))
    return own.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.id").alias(key), (-F.col("col.far")).alias("score"))
