"""Benchmark decontamination by spaced seeds of words, with DataFrame functions alone.

A seed is the hash of the words that a fixed mask selects from a run of words; the words under its zeros are
ignored, so a substitution there leaves the seed as it is. Seeds of all document positions meet those of the
benchmark items in a join. The masks are such that every window that agrees well enough holds a number of seeds
on one alignment that can be promised; where an item and a text share that many, the aligned words are compared,
and the text is contaminated by the item if some window of the item agrees well enough.
"""

from __future__ import annotations

import itertools
import math
from functools import lru_cache

from pyspark.sql import Column, DataFrame, functions as F

from bookloom.llm.common import materialise

#: Masks of items by their least number of words: found by trying all pairs of their weight, kept because of LEAST_HITS.
MASKS = {8: ("1101", "100011"), 12: ("11011", "110000101")}
#: Seeds that a window of 8, 9, ... 24 words shares at least if three quarters of its words agree.
LEAST_HITS = dict(zip(range(8, 25), (2, 2, 3, 4, 1, 1, 2, 2, 2, 2, 3, 4, 2, 3, 4, 5, 3)))


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _masks(n: int) -> tuple[str, ...]:
    return MASKS[max(k for k in MASKS if k <= n)]


@lru_cache
def least_hits(width: int, share: float) -> int:
    """Seeds on one alignment that a window of ``width`` words is sure to share if ``share`` of them agree; by trying all patterns."""
    if share == 0.75 and width in LEAST_HITS:
        return LEAST_HITS[width]
    seeds = [sum(1 << (at + k) for k, c in enumerate(m) if c == "1") for m in _masks(width) for at in range(width - len(m) + 1)]
    patterns = (sum(1 << k for k in places) for places in itertools.combinations(range(width), width - math.ceil(width * share)))
    return min(sum(not (s & p) for s in seeds) for p in patterns)


def _kinds(sizes: list[int], exact: int) -> list[tuple[int, tuple[int, ...]]]:
    """(number, selected places) of the masks for items of these sizes; an item below ``exact`` words is one seed as a whole."""
    out = [(n, tuple(range(n))) for n in sizes if n < exact]
    for least in sorted({max(k for k in MASKS if k <= n) for n in sizes if n >= exact}):
        out += [(100 * least + i, tuple(k for k, c in enumerate(m) if c == "1")) for i, m in enumerate(MASKS[least])]
    return out


def _seeds(array: str, kinds: list[tuple[int, tuple[int, ...]]]) -> Column:
    """For each mask a struct (kind, span, seeds): its seed at every position where it fits, in order."""

    def one(kind: int, places: tuple[int, ...]) -> Column:
        last = F.size(array) - (places[-1] + 1)
        seed = lambda p: F.xxhash64(F.lit(kind), *[F.get(array, p + k) for k in places])
        return F.struct(F.lit(kind).alias("kind"), F.lit(places[-1] + 1).alias("span"), F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), seed)).alias("seeds"))

    return F.array(*[one(*k) for k in kinds])


def _best(dw: Column, p: Column) -> Column:
    """Most equal aligned words in a window of a place (at, width, words) over the document's words."""
    bits = F.array_join(F.transform(p["words"], lambda w, j: F.when(w == F.get(dw, p["at"] + j), F.lit("1")).otherwise(F.lit("0"))), "")
    return F.array_max(F.transform(F.array(bits), lambda b: F.array_max(F.transform(F.sequence(F.lit(1), F.char_length(b) - p["width"] + 1), lambda s: F.char_length(F.replace(b.substr(s, p["width"]), F.lit("0"), F.lit("")))))))


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = 24, share: float = 0.75, least: int = 1, exact: int = 8, broadcast_bytes: int = 16 << 20, chunk: int = 256) -> DataFrame:
    """One row per document id and item: key, item, matched, window.

    ``matched`` is the largest number of equal aligned words in a window of the item of min(``window``, its
    words), from the reach of its first seed hit to that of its last; at least ``share`` of them must agree,
    and no window that does is missed (for windows of which the masks cannot promise that, it is an error).
    An item of fewer than ``exact`` words must occur in full; ``least`` above 1 leaves shorter items out. Null
    and empty texts have no words. Rows of the same id or item count together (the best window), null ids
    among them; equal texts are compared once. Empty tables, of either kind, give no rows. Only the named columns are read, so others may have any name.
    Seeds, and the words of items, are broadcast if what is sent takes at most ``broadcast_bytes``, as are
    the digests and results of texts with hits; otherwise Spark joins by shuffle. A text's places are
    compared ``chunk`` at a time.
    """
    exact = max(exact, min(MASKS))
    small = lambda df, width: F.broadcast(df) if df.count() * width <= broadcast_bytes else df
    spread = F.least(F.lit(window), F.size("iw"))
    items = benchmark.select(F.col(item).alias("item"), _hashes(F.col(item_text)).alias("iw")).where(F.size("iw") >= max(least, 1)).distinct()
    items = materialise(items.select("item", "iw", spread.alias("width"), F.monotonically_increasing_id().alias("no")), "items")
    sizes = [r["n"] for r in items.select(F.least(F.size("iw"), F.lit(max(exact, window, *MASKS))).alias("n")).distinct().orderBy("n").collect()]
    promised = {n: 1 if n < exact else least_hits(min(n, window), share) for n in sizes}
    if not all(promised.values()):
        raise ValueError(f"no seed is sure in windows at a share of {share}: {[n for n, k in promised.items() if not k]} words")
    kinds = _kinds(sizes, exact) or [(1, (0,))]
    enough = F.coalesce(*[F.when(F.least(F.size("iw"), F.lit(max(exact, window, *MASKS))) == n, k) for n, k in promised.items()], F.lit(1))
    own = F.when(F.size("iw") < exact, F.size("iw")).otherwise(F.coalesce(*[F.when(F.size("iw") >= k, 100 * k) for k in sorted(MASKS, reverse=True)]))
    seeds = items.select("no", own.alias("own"), enough.alias("enough"), F.inline(_seeds("iw", kinds))).where((F.col("kind") == F.col("own")) | (F.col("own") >= 100) & (F.col("kind") - F.col("own")).between(0, 99))
    seeds = materialise(seeds.select("no", "span", "enough", F.posexplode("seeds").alias("ip", "seed")), "seeds")

    # Texts go by two 64-bit digests, so copies are one; only digests, places and hashes leave a row here.
    mine = docs.select(F.col(key).alias("doc"), F.col(text).alias("t"), F.xxhash64(F.col(text)).alias("d1"), F.xxhash64(F.lit(1), F.col(text)).alias("d2"))
    probes = mine.select("d1", "d2", _hashes(F.col("t")).alias("dw")).select("d1", "d2", F.inline(_seeds("dw", kinds))).select("d1", "d2", F.posexplode("seeds").alias("dp", "seed"))
    hits = probes.join(small(seeds, 72), "seed")
    grouped = hits.groupBy("d1", "d2", "no", (F.col("dp") - F.col("ip")).alias("shift")).agg(F.count(F.lit(1)).alias("hits"), F.first("enough").alias("enough"), F.min(F.col("ip") + F.col("span")).alias("first"), F.max("ip").alias("last"))
    lined = materialise(grouped.where("hits >= enough").select("d1", "d2", "no", "shift", "first", "last"), "hits")

    texts = mine.join(small(lined.select("d1", "d2").distinct(), 48), ["d1", "d2"], "left_semi").groupBy("d1", "d2").agg(F.first("t").alias("t"))
    held = items.agg(F.coalesce(F.sum(F.size("iw") * 8 + 64), F.lit(0)).alias("n")).first()["n"]
    low = F.greatest(F.lit(0), F.col("first") - F.col("width"))
    high = F.least(F.size("iw"), F.col("last") + F.col("width"))  # exclusive
    place = F.struct("item", "width", (low + F.col("shift")).alias("at"), F.slice("iw", low + 1, high - low).alias("words"))
    turns = lined.withColumn("turn", F.expr(f"(row_number() over (partition by d1, d2 order by no, shift) - 1) div {chunk}"))
    places = turns.join(F.broadcast(items) if held <= broadcast_bytes else items, "no").groupBy("d1", "d2", "turn").agg(F.collect_list(place).alias("places"))

    # The words are bound once per row, as the variable of a lambda.
    compared = F.transform(F.array(_hashes(F.col("t"))), lambda dw: F.transform("places", lambda p: F.struct(p["item"].alias("item"), p["width"].alias("width"), _best(dw, p).alias("matched"))))
    met = texts.join(places, ["d1", "d2"]).select("d1", "d2", F.explode(compared).alias("x")).select("d1", "d2", F.inline("x"))
    found = met.where(F.col("matched") >= F.ceil(F.col("width") * share)).groupBy("d1", "d2", "item").agg(F.max("matched").alias("matched"), F.max("width").alias("width"))
    found = materialise(found, "found")
    named = mine.select("doc", "d1", "d2").join(small(found, 80), ["d1", "d2"])
    return named.groupBy(F.col("doc").alias(key), F.col("item").alias(item)).agg(F.max("matched").cast("long").alias("matched"), F.max("width").cast("long").alias("window"))
