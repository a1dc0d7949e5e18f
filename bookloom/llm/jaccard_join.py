"""Similarity join on word n-grams: rare-first prefix filtering, verified once per pair.

Documents with the same n-gram set are one class. A class's n-grams are ordered rare first, by a sketch of
their frequencies over all documents; two sets of the wanted Jaccard similarity share an n-gram among the
first few of each (the prefix). Classes that share one are candidates if their sizes (length filter), the
places of the shared n-gram (positional filter) and what tells them apart over the whole of both sets
(suffix filter) allow it: bits that hold the parity of the counts per hash range bound the number of n-grams
in one set alone, and the smaller counts per range bound the overlap. Only then are the sets compared.

Lists of a few members are joined once; their candidates wait in a table of pairs. Groups of thousands of
near copies share their prefixes with each other, so in longer lists each round lets the members meet only
a few pivots. A round tries each class with its likeliest candidate and contracts the links found to
components before the next; the last round takes all candidates that still lie in different components,
so no link between components can be missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from bookloom.llm import bloom
from bookloom.llm.common import discard, materialise, release, trimmed
from bookloom.llm.components import components

SKETCH_BITS, SKETCH_BLOCK, RANGES, PARITY = 21, 16, 64, 4
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


#: Words are hashed as polynomials over their bytes, from running sums over the text; words longer than this by themselves.
_LONG, _TABLE = 512, 1 << 16
_BASE = 0xD1B54A32D192ED03
_BLANK = bytes(x in (0x20, *range(0x09, 0x0E)) for x in range(256))
#: Blanks count as 0, so that only they do the zero byte takes the place of the space.
_WORTH = bytes(0 if _BLANK[x] else x or 0x20 for x in range(256))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, _TABLE), _powers(pow(_BASE, -1, 1 << 64), _TABLE)


def _power(table: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` powers; beyond the table by products."""
    if n <= _TABLE:
        return table[:n]
    step = (table[-1:] * table[1:2])[0]
    high = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n // _TABLE, step)]), dtype=np.uint64)
    return (high[:, None] * table[None, :]).reshape(-1)[:n]


def _mixed(h: np.ndarray, factor: np.uint64) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * factor
    return h ^ (h >> np.uint64(32))


def _word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the runs of bytes without ASCII white space."""
    blank = (b" " + text + b" ").translate(_BLANK)
    edge = np.flatnonzero(np.diff(np.frombuffer(blank, dtype=np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    n = len(text)
    run = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(np.frombuffer(text.translate(_WORTH), dtype=np.uint8) * _power(_UP, n), out=run[1:])
    out = (run[ends] - run[starts]) * _power(_DOWN, n)[starts]
    for k in np.flatnonzero(ends - starts > _LONG):  # a longer word is hashed by itself
        out[k] = xxhash.xxh3_64_intdigest(text[starts[k] : ends[k]])
    return _mixed(out, _A)


class Shingles:
    """Hashes of a text's distinct word n-grams, sorted. Words: runs without ASCII white space, A-Z lower-cased."""

    def __init__(self, n: int):
        self.n = n

    def __call__(self, text: str | None) -> np.ndarray:
        low = text.encode().lower() if text else b""  # bytes.lower() knows ASCII alone
        w = _word_hashes(low)
        if not len(w):
            return w
        if len(w) < self.n:  # the whole sequence is the one n-gram
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(low.split()), seed=len(w))], dtype=np.uint64)
        h = w[: len(w) - self.n + 1]
        for k in range(1, self.n):
            h = (h ^ (h >> np.uint64(31))) * _A + w[k : len(w) - self.n + 1 + k]
        h = np.sort(_mixed(h, _B))
        return h[np.concatenate([[True], h[1:] != h[:-1]])]


def _digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _ranges(shingles: np.ndarray) -> np.ndarray:
    return np.bincount((shingles >> np.uint64(58)).astype(np.int64), minlength=RANGES)


def _parity(shingles: np.ndarray) -> np.ndarray:
    """256 bits: for each value of eight hash bits whether an odd number of n-grams has it, as four numbers."""
    odd = np.bincount(((shingles >> np.uint64(40)) & np.uint64(255)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def _needed(overlap: Column, na: Column, nb: Column, percent: int) -> Column:
    """Whether an overlap of that size makes two sets similar: 100 I >= p (a + b - I)."""
    return overlap * (100 + percent) >= percent * (na + nb)


def _summary(df: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """One pass: a row per document (id, n, cls, ranges, parity), and per task the blocks of its frequency sketch."""
    size, width = 1 << SKETCH_BITS, 1 << SKETCH_BLOCK

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, total, held, count = Shingles(n), np.zeros(size, dtype=np.int64), [], 0

        def add():
            nonlocal total, held, count
            if held:
                at = (np.concatenate(held) & np.uint64(size - 1)).astype(np.int64)
                total += np.bincount(at, minlength=size)
                held, count = [], 0

        for batch in batches:
            rows = []
            for doc, words in zip(batch["k"], batch["t"]):
                s = shingles(words)
                rows.append((doc, len(s), _digest(s) if len(s) else None, _ranges(s).astype("<u4").tobytes() if len(s) else None, _parity(s)))
                held.append(s)
                count += len(s)
                if count >= 500_000:
                    add()
            out = pd.DataFrame(rows, columns=["id", "n", "cls", "ranges", "parity"])
            yield out.assign(id=batch["k"].array, block=pd.array([None] * len(rows), dtype="Int32"), counts=None)
        add()
        low = np.minimum(total, 255).astype(np.uint8)
        blocks = [(b, x.tobytes()) for b, x in enumerate(low.reshape(-1, width)) if x.any()]
        yield pd.DataFrame({"id": pd.array([None] * len(blocks), dtype="Int64"), "n": 0, "cls": None, "ranges": None, "parity": None, "block": pd.array([b for b, _ in blocks], dtype="Int32"), "counts": [x for _, x in blocks]})

    schema = "id long, n long, cls binary, ranges binary, parity array<long>, block int, counts binary"
    return df.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).mapInPandas(trimmed(run), schema)


def _sketch(parts: DataFrame) -> np.ndarray:
    """Frequencies by hash bucket over all documents; tasks count to 255, sums are taken in two steps."""

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.uint8 if len(c) == 1 << SKETCH_BLOCK else "<u4").astype(np.uint32) for c in frame["counts"])
        return pd.DataFrame({"block": [frame["block"].iloc[0]], "part": [0], "counts": [total.astype("<u4").tobytes()]})

    schema = "block int, part int, counts binary"
    some = parts.select("block", F.pmod(F.xxhash64("counts"), F.lit(64)).cast("int").alias("part"), "counts").groupBy("block", "part").applyInPandas(add, schema)
    out = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
    for r in some.groupBy("block").applyInPandas(add, schema).collect():
        out[r["block"] << SKETCH_BLOCK : (r["block"] + 1) << SKETCH_BLOCK] = np.frombuffer(bytes(r["counts"]), "<u4")
    return out


def _prefix(shingles: np.ndarray, sketch: np.ndarray, percent: int) -> np.ndarray:
    """The first n - ceil(p n / 100) + 1 n-grams in the common order: rare first, then by hash."""
    n = len(shingles)
    often = sketch[(shingles & np.uint64(len(sketch) - 1)).astype(np.int64)]
    return shingles[np.lexsort((shingles, often))[: n + (-percent * n) // 100 + 1]]


def _key(digest: bytes) -> int:
    """The first half of a class's digest; ``_key_of`` is the same for a column."""
    return int.from_bytes(digest[:8], "big", signed=True)


def _key_of(digest: str) -> Column:
    return F.conv(F.hex(F.substring(digest, 1, 8)), 16, -10).cast("long")


def _postings(df: DataFrame, text: str, n: int, percent: int, sketch, bits: int) -> DataFrame:
    """Prefix n-grams that more than one document may have: h, key, pos.

    Classes go by half of their digest here. Should two share it, each is entered under the n-grams of both,
    which makes more candidates and loses none.
    """
    texts = df.select(F.col(text).alias("t"))

    def prefixes(batches: Iterator[pd.DataFrame], common: np.ndarray):
        """(class, prefix) of the partition's different sets."""
        shingles, seen = Shingles(n), set()
        for batch in batches:
            for words in batch["t"]:
                s = shingles(words)
                if len(s) and (d := _digest(s)) not in seen:
                    seen.add(d)
                    yield d, _prefix(s, common, percent)

    twice = df.sparkSession.sparkContext.broadcast(bloom.build(texts, lambda batches: (p for _, p in prefixes(batches, sketch.value)), bits))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, held = twice.value.table(), []

        def frame(held):
            all_h = np.concatenate([p for _, p in held])
            may, sizes = bloom.passes(table, all_h, bits), [len(p) for _, p in held]
            place = np.concatenate([np.arange(k) for k in sizes])
            at = np.repeat(np.arange(len(held)), sizes)[may]
            own = np.array([_key(d) for d, _ in held], dtype=np.int64)
            return pd.DataFrame({"h": all_h[may].view(np.int64), "key": own[at], "pos": place[may].astype(np.int32)})

        for x in prefixes(batches, sketch.value):
            held.append(x)
            if len(held) >= 5000:
                yield frame(held)
                held = []
        if held:
            yield frame(held)

    return texts.mapInPandas(trimmed(run), "h long, key long, pos int").dropDuplicates()


def _near(apart: Column, na: Column, nb: Column, percent: int) -> Column:
    """Whether sets that differ in that many n-grams can be similar: overlap = (a + b - apart) / 2."""
    return (na + nb - apart) * (100 + percent) >= 2 * percent * (na + nb)


def _reach(na, pa, nb, pb, percent: int) -> Column:
    """Positional filter for the first n-gram that two ordered sets share; it holds the length filter."""
    return _needed(1 + F.least(na - pa - 1, nb - pb - 1), na, nb, percent)


def _apart(a: str, b: str) -> Column:
    """At least so many n-grams lie in one of two sets alone: each of them turns one bit of the parity."""
    return reduce(lambda x, y: x + y, [F.bit_count(F.col(f"{a}{k}").bitwiseXOR(F.col(f"{b}{k}"))) for k in range(PARITY)])


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("c")).dropDuplicates()


def _of(table: DataFrame, ids: DataFrame, few: bool, how: str = "left_semi") -> DataFrame:
    """Rows of ``table`` for the classes in ``ids``; nothing moves where these are few."""
    return table.join(F.broadcast(ids) if few else ids, "c", how)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""

    @F.pandas_udf("boolean")
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pd.Series(out, dtype=bool)

    two = pairs.join(sets.alias("x"), F.col("a") == F.col("x.c")).join(sets.alias("y"), F.col("b") == F.col("y.c"))
    return two.where(similar("x.grams", "y.grams")).select("a", "b")


def _suffix(pairs: DataFrame, classes: DataFrame, percent: int, broadcast_rows: int) -> DataFrame:
    """Pairs whose counts per hash range allow the overlap that is needed."""

    @F.pandas_udf("long")
    def bound(left: pd.Series, right: pd.Series) -> pd.Series:
        if not len(left):
            return pd.Series([], dtype="int64")
        x, y = (np.frombuffer(b"".join(s), "<u4").reshape(-1, RANGES).astype(np.int64) for s in (left, right))
        return pd.Series(np.minimum(x, y).sum(axis=1))

    ids = _ends(pairs)
    own = _of(classes.select("c", "n", "ranges"), ids, ids.count() <= broadcast_rows)
    both = pairs.join(own.alias("x"), F.col("a") == F.col("x.c")).join(own.alias("y"), F.col("b") == F.col("y.c"))
    return both.where(_needed(bound("x.ranges", "y.ranges"), F.col("x.n"), F.col("y.n"), percent)).select(*pairs.columns)


def _sets(df: DataFrame, key: str, text: str, n: int, needed: DataFrame, few: bool) -> DataFrame:
    """(c, grams) of the classes in ``needed`` (c, cls, rep), from the texts of the documents named there.

    Where an id repeats with the same text, a class may come once per partition.
    """
    rows = df.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).join(F.broadcast(needed) if few else needed, F.col("k").eqNullSafe(F.col("rep")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, seen = Shingles(n), set()
        for batch in batches:
            found = []
            for c, cls, t in zip(batch["c"], batch["cls"], batch["t"]):
                if c not in seen and _digest(s := shingles(t)) == bytes(cls):
                    seen.add(c)
                    found.append((c, s.tobytes()))
            yield pd.DataFrame(found, columns=["c", "grams"])

    return rows.select("c", "cls", "t").mapInPandas(trimmed(run), "c long, grams binary")


def _meet(left: DataFrame, right: DataFrame, unlike: Column, percent: int, on: tuple[str, ...] = ("h",)) -> DataFrame:
    """Candidates (c, other, far) of two tables of postings x and y: those of one list that the filters allow."""
    far = _apart("x.p", "y.p")
    may = _reach(F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos"), percent) & _near(far, F.col("x.n"), F.col("y.n"), percent)
    same = reduce(lambda x, y: x & y, [F.col(f"x.{k}") == F.col(f"y.{k}") for k in on])
    met = left.alias("x").join(right.alias("y"), same & unlike & may)
    return met.select(F.col("x.c").alias("c"), F.col("y.c").alias("other"), far.alias("far")).dropDuplicates(["c", "other"])


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.withColumns({"a": F.least("c", "other"), "b": F.greatest("c", "other")})


def _likeliest(pairs: DataFrame) -> DataFrame:
    """Of each class's candidates (c, other, far, a, b) the one with the fewest differences."""
    return pairs.groupBy("c").agg(F.min_by(F.struct("a", "b"), F.struct("far", "other")).alias("x")).select("x.a", "x.b").dropDuplicates()


def _component(df: DataFrame, column: str, labels: DataFrame | None, name: str) -> DataFrame:
    """Adds ``name``: the component of the class in ``column``, which is the class itself while it has no link."""
    if labels is None:
        return df.withColumn(name, F.col(column))
    joined = df.join(labels.select(F.col("node").alias(column), F.col("label").alias(name)), column, "left")
    return joined.withColumn(name, F.coalesce(name, column))


def _merged(labels: DataFrame | None, found: DataFrame) -> DataFrame:
    """Components after more links: the links are taken between components, so only what changes is worked on."""
    if labels is None:
        return components(found)
    between = _component(_component(found, "a", labels, "ca"), "b", labels, "cb").where(F.col("ca") != F.col("cb"))
    step = components(between, "ca", "cb")
    moved = labels.join(step.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return materialise(moved.unionByName(step.join(labels.select("node"), "node", "left_anti").select("node", "label")), "labels")


def _long_lists(postings: DataFrame, labels: DataFrame | None, turn: int, last: bool, pivots: int, percent: int, part_rows: int) -> DataFrame:
    """Candidates (c, other, far) from long lists, between components only.

    A list is cut into parts of about ``part_rows`` members; what they have to meet (the list's pivots, or in the
    last round the members outside its largest component) is sent to each part, so no task gets a whole list.
    """
    parts = F.ceil(F.col("many") / part_rows).cast("int")
    everywhere = lambda df: df.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    own = _component(postings, "c", labels, "comp").withColumn("part", F.pmod(F.xxhash64("c"), parts).cast("int"))
    if last:  # members outside a list's largest component against all others
        sizes = own.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("size"), F.first("many").alias("many")).groupBy("h").agg(F.max(F.struct("size", "comp")).alias("top"), F.count(F.lit(1)).alias("comps"), F.first("many").alias("many")).where("comps > 1")
        tops = everywhere(sizes.select("h", "many", F.col("top.comp").alias("top"))).drop("many")
        left, right = everywhere(own.join(tops, ["h", "part"]).where(F.col("comp") != F.col("top")).drop("top", "part")), own
    else:  # all members against the list's pivots, chosen among about four times as many
        order = Window.partitionBy("h").orderBy(F.xxhash64("c", F.lit(turn)), "c")
        some = own.where(F.pmod(F.xxhash64("c", F.lit(turn)), F.col("many")) < 4 * pivots)
        left, right = own, everywhere(some.withColumn("at", F.row_number().over(order)).where(F.col("at") <= pivots).drop("at", "part"))
    return _meet(left, right, F.col("x.comp") != F.col("y.comp"), percent, ("h", "part"))


def similar_documents(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, percent: int = 90, pivots: int = 8, rounds: int = 3, bits: int = 27, broadcast_rows: int = 250_000, part_rows: int = 1024) -> DataFrame:
    """One row per input row: key, n_shingles, component_id.

    Two documents link when 100 * |A and B| >= ``percent`` * |A or B| of their sets of distinct word
    n-grams (``words``; a shorter text's whole sequence is its one n-gram; n-grams are compared by 64-bit
    hash). ``component_id`` is the smallest id reachable over links, the row's own included. A null or
    blank text has an empty set and links with nothing. Rows that repeat an id are rows of their own; a
    null id never is a component's smallest unless all are null. Extra columns are not read; an empty
    table gives no rows. ``bits``: size of the filter in front of the postings (16 MB at 27). Lists of more
    than twice ``pivots`` members are long, and are cut into parts of about ``part_rows``. Ids of classes are
    broadcast up to ``broadcast_rows`` (60 bytes each, so 15 MB).
    """
    spark = df.sparkSession
    summary = materialise(_summary(df, key, text, words), "summary")
    docs = summary.where(F.col("block").isNull()).select("id", "n", "cls", "ranges", "parity")
    firsts = [F.first(c).alias(c) for c in ("n", "ranges", "parity")]
    grouped = docs.where("n > 0").groupBy("cls").agg(F.min("id").alias("rep"), *firsts)
    classes = materialise(grouped.withColumn("c", F.monotonically_increasing_id()), "classes")  # numbers hold once written
    sketch = spark.sparkContext.broadcast(_sketch(summary.where(F.col("block").isNotNull())))
    every = materialise(_postings(df, text, words, percent, sketch, bits), "prefixes")
    release(spark)
    common = every.groupBy("h").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    parity = classes.select(_key_of("cls").alias("key"), "c", "n", *[F.get("parity", F.lit(k)).alias(f"p{k}") for k in range(PARITY)])
    shared = materialise(every.join(common, "h").join(parity, "key").drop("key"), "postings")
    discard(every)

    short, long = shared.where(F.col("many") <= 2 * pivots).drop("many"), shared.where(F.col("many") > 2 * pivots)
    met = materialise(_ordered(_meet(short, short, F.col("x.c") < F.col("y.c"), percent)).select("a", "b", "far"), "met")
    waiting = materialise(_suffix(met, classes, percent, broadcast_rows), "waiting")
    discard(met)
    any_long = long.limit(1).count() > 0

    tested = labels = None
    turn, last = -1, False
    while not last:
        turn, last = turn + 1, last or turn + 1 >= rounds
        pairs = waiting.select("a", "b")
        if not last:
            pairs = _likeliest(waiting.select("*", F.inline(F.array(F.struct(F.col("a").alias("c"), F.col("b").alias("other")), F.struct(F.col("b").alias("c"), F.col("a").alias("other"))))))
        if any_long:
            more = _ordered(_long_lists(long, labels, turn, last, pivots, percent, part_rows))
            more = more if tested is None else more.join(tested, ["a", "b"], "left_anti")
            more = materialise(more.select("a", "b").dropDuplicates() if last else _likeliest(more), "met")
            pairs = pairs.unionByName(_suffix(more, classes, percent, broadcast_rows)).dropDuplicates()
        pairs = materialise(pairs, "pairs")
        if any_long:
            discard(more)
        ids = materialise(_ends(pairs), "ends")
        n = ids.count()
        if not n:
            rounds = turn + 1  # nothing is left to try but, in long lists, what the last round does
            continue
        needed = _of(classes.select("c", "cls", "rep"), ids, n <= broadcast_rows, "inner")
        sets = materialise(_sets(df, key, text, words, needed, n <= broadcast_rows), "sets")
        found = materialise(_verified(pairs, sets, percent), "found")
        discard(sets, ids)
        tested = pairs if tested is None else tested.unionByName(pairs)
        if found.limit(1).count():
            labels = _merged(labels, found)
        else:
            rounds = turn + 1  # rounds are there to contract links
        if not last:  # what still lies between components
            left = _component(_component(waiting.join(pairs, ["a", "b"], "left_anti"), "a", labels, "ca"), "b", labels, "cb")
            waiting = materialise(left.where(F.col("ca") != F.col("cb")).select("a", "b", "far"), "waiting")
    named = _component(classes.select("cls", "c", "rep"), "c", labels, "comp")
    smallest = named.groupBy("comp").agg(F.min("rep").alias("smallest"))
    named = named.join(smallest, "comp").select("cls", "smallest")
    out = docs.select("id", "n", "cls").join(named, "cls", "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("smallest")).alias("component_id"))
