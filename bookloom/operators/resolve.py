"""Finding the book behind a file or a link, and merging duplicates into their origins."""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, functions as F

from bookloom.sources.shared import stored


def cascade(rows: DataFrame, candidates: list[tuple[DataFrame, Column, str]], value: str) -> DataFrame:
    """Adds ``value`` and ``matched`` (1 for the first candidate that knows the row, 0 for none).

    ``candidates``: (lookup with columns key and ``value``, expression over ``rows``, name), tried in order.
    Lookups must have one row per key; they are joined one after another, never multiplied.
    """
    out = rows
    for i, (lookup, key, _) in enumerate(candidates):
        out = out.withColumn(f"_k{i}", key).join(lookup.select(F.col("key").alias(f"_l{i}"), F.col(value).alias(f"_v{i}")), F.col(f"_k{i}") == F.col(f"_l{i}"), "left")
    found = F.coalesce(*[F.col(f"_v{i}") for i in range(len(candidates))])
    matched = reduce(lambda rest, i: F.when(F.col(f"_v{i}").isNotNull(), i + 1).otherwise(rest), reversed(range(len(candidates))), F.lit(0))
    return out.select(*rows.columns, found.alias(value), matched.alias("matched"))


def exact_groups(docs: DataFrame, key: str, digest: Column) -> DataFrame:
    """digest, smallest id and number of rows of every content that occurs more than once."""
    return docs.groupBy(digest.alias("digest")).agg(F.min(key).alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1")


def chain_edges(docs: DataFrame, key: str, digest: Column) -> DataFrame:
    """Each duplicate and the first row with the same content: dup, origin.

    The first row is a plain minimum per content, so a content that a third of all rows have is aggregated
    before it is shuffled and its rows never meet in one sort.
    """
    first = exact_groups(docs, key, digest).select("digest", F.col("first_id").alias("origin"))
    return docs.select(F.col(key).alias("dup"), digest.alias("digest")).join(first, "digest").where("dup <> origin").select("dup", "origin")


def roots(edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """dup, root: every duplicate's last origin, by pointer jumping: a chain of n links takes log2(n) rounds.

    The first edge of a duplicate (smallest origin) counts. Duplicates on a cycle have no root and are left
    out. Every round is written to the shared folder, so a round's plan is one join whatever came before.
    """
    at = stored(edges.groupBy("dup").agg(F.min("origin").alias("root")))
    for _ in range(most_rounds):
        far = at.select(F.col("dup").alias("root"), F.col("root").alias("far"))
        step = stored(at.join(far, "root", "left").select("dup", "root", F.coalesce("far", "root").alias("new")))
        moved = step.where("new <> root").limit(1).count()
        at = step.select("dup", F.col("new").alias("root"))
        if not moved:
            break
    ends = at.select(F.col("dup").alias("root"))
    return at.join(ends, "root", "left_anti").select("dup", "root")


def edges_to_books(edges: DataFrame, by_uid: DataFrame, by_library: DataFrame) -> DataFrame:
    """dup, origin: duplicates to the books their origins are, by uid, else by source and file name without suffix.

    ``edges``: dup, uid, source, file; the look-ups key and book. Origins that neither knows are left out.
    """
    name = F.concat_ws("_", F.col("source"), F.regexp_replace("file", r"\.[^.]*$", ""))
    found = cascade(edges, [(by_uid, F.col("uid"), "uid"), (by_library, name, "library")], "book")
    return found.where("book is not null").select("dup", F.col("book").alias("origin"))


def components(edges: DataFrame) -> DataFrame:
    """id, component: for every id of ``edges`` (a, b) the smallest one that edges lead to, in any direction.

    In each round an id takes the smallest component around it, then that one's own, so rounds grow with the logarithm
    of the longest path; every round is written to the shared folder. Neighbours are aggregated, never gathered.
    """
    both = stored(edges.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("id"), F.col("a").alias("other"))).distinct())
    at = stored(both.groupBy("id").agg(F.least("id", F.min("other")).alias("component")))
    while True:
        around = both.join(at.withColumnRenamed("id", "other"), "other").groupBy("id").agg(F.min("component").alias("near"))
        near = at.join(around, "id").select("id", F.col("component").alias("before"), F.least("component", "near").alias("now"))
        jump = near.select(F.col("id").alias("now"), F.col("now").alias("far"))
        step = stored(near.join(jump, "now", "left").select("id", "before", F.least("now", F.coalesce("far", "now")).alias("component")))
        at = step.select("id", "component")
        if not step.where("before <> component").limit(1).count():
            return at


def sharing(rows: DataFrame) -> DataFrame:
    """id, component: ids joined by the words that they share (``rows``: id, word, no id twice with a word), those alone too.

    Of a word's ids each is tied to the smallest one, so a word that all have gives a row for each of them and not
    one for each pair; what is reached is the same.
    """
    hubs = rows.groupBy("word").agg(F.min("id").alias("hub"))
    ties = rows.join(hubs, "word").where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    return rows.select("id").distinct().join(components(ties), "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def merge_into_roots(books: DataFrame, at: DataFrame, unique: bool = False) -> DataFrame:
    """Books (book_id, rate_sum, rate_count, deleted, series array) merged along duplicates (dup, root).

    Rates add up, series are joined in the order of ids, and a root stays deleted only if all are. With ``unique``
    a series that several have stays where it comes first; these are lost before any root's books meet, so
    a root that very many books lead to holds its different series only.
    """
    own = books.join(at, books["book_id"] == at["dup"], "left").withColumn("root", F.coalesce("root", "book_id"))
    sums = [F.sum("rate_sum").alias("rate_sum"), F.sum("rate_count").alias("rate_count"), F.bool_and("deleted").alias("deleted")]
    if not unique:
        merged = own.groupBy("root").agg(*sums, F.array_sort(F.collect_list(F.struct("book_id", "series"))).alias("s"))
        return merged.select(F.col("root").alias("book_id"), "rate_sum", "rate_count", "deleted", F.flatten(F.col("s.series")).alias("series"))
    each = own.select("root", "book_id", F.posexplode("series").alias("nth", "one"))
    first = each.groupBy("root", "one").agg(F.min(F.struct("book_id", "nth")).alias("first"))
    listed = first.groupBy("root").agg(F.sort_array(F.collect_list(F.struct("first", "one"))).alias("s"))
    merged = own.groupBy("root").agg(*sums).join(listed, "root", "left")
    return merged.select(F.col("root").alias("book_id"), "rate_sum", "rate_count", "deleted", F.coalesce("s.one", F.slice(F.array(F.lit(None)), 1, 0).cast(books.schema["series"].dataType)).alias("series"))


def hamming_pairs(rows: DataFrame, block: str, key: str, bits: str, most: int, bands: int = 0) -> DataFrame:
    """Pairs of one block at a distance of at most ``most``: left_id, right_id, distance.

    64 bits are cut into ``bands`` bands (``most`` + 1, 2 to 16): in one of them two such hashes differ in at
    most ``most`` div ``bands`` bits, so one side is entered under its band's value and the other under all
    values so near to it, and none of the pairs is lost. A pair is given in the first band where it meets. Where ``most``
    is so large that bands would bring together half of all pairs or more, pairs are compared by parts of a block.
    """
    bands = bands or max(2, min(most + 1, 16))
    slack, edges = most // bands, [64 * i // bands for i in range(bands + 1)]
    if sum(comb(b - a, n) / 2 ** (b - a) for a, b in zip(edges, edges[1:]) for n in range(slack + 1)) > 0.5:
        return _pairs_by_parts(rows.select(F.col(block).alias("block"), F.col(key).alias("id"), F.col(bits).alias("bits")), most)
    part = lambda x, i: F.shiftrightunsigned(x, edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1))
    near = lambda i: [sum(1 << b for b in flips) for n in range(slack + 1) for flips in combinations(range(edges[i + 1] - edges[i]), n)]
    base = rows.select(F.col(block).alias("block"), F.col(key).alias("id"), F.col(bits).alias("bits"))
    own = base.withColumn("b", F.explode(F.array(*[F.struct(F.lit(i).alias("band"), part(F.col("bits"), i).alias("part")) for i in range(bands)])))
    probes = F.array(*[F.struct(F.lit(i).alias("band"), part(F.col("bits"), i).bitwiseXOR(F.lit(m).cast("long")).alias("part")) for i in range(bands) for m in near(i)])
    a, b = own.select("block", "id", "bits", "b.*").alias("a"), base.withColumn("b", F.explode(probes)).select("block", "id", "bits", "b.*").alias("b")
    apart = F.col("a.bits").bitwiseXOR(F.col("b.bits"))
    far = F.bit_count(apart)
    first = reduce(lambda rest, i: F.when(F.bit_count(part(apart, i)) <= slack, i).otherwise(rest), reversed(range(bands)), F.lit(bands))
    on = (F.col("a.block") == F.col("b.block")) & (F.col("a.band") == F.col("b.band")) & (F.col("a.part") == F.col("b.part")) & (F.col("a.id") < F.col("b.id")) & (far <= most) & (first == F.col("a.band"))
    return a.join(b, on).select(F.col("a.id").alias("left_id"), F.col("b.id").alias("right_id"), far.alias("distance"))


def _pairs_by_parts(base: DataFrame, most: int, part: int = 4_096, broadcast_rows: int = 100_000) -> DataFrame:
    """``hamming_pairs`` for wide distances: each pair of a block is compared once at most.

    The numbers of bits set (the distances to a pivot of none) of two hashes differ by no more than their distance,
    so rows lie in rings by that number and meet rows of near rings only. A block of more than ``part`` rows is
    dealt into parts, and a row meets each part of those rings that is not behind its own, so no task gathers a block.
    """
    width = max(1, most // 2)
    large = stored(base.groupBy("block").count().where(F.col("count") > part).select("block", F.ceil(F.col("count") / part).cast("int").alias("parts")))
    n = large.count()
    sized = base.join(F.broadcast(large) if n <= broadcast_rows else large, "block", "left") if n else base.withColumn("parts", F.lit(1))
    own = sized.select("block", "id", "bits", F.coalesce("parts", F.lit(1)).alias("parts"), F.floor(F.bit_count("bits") / width).cast("int").alias("ring")).withColumn("nth", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    rings = F.sequence(F.greatest(F.col("ring") - -(-most // width), F.lit(0)), F.col("ring"))
    parts = F.flatten(F.transform(rings, lambda r: F.transform(F.sequence(F.lit(0), F.when(r == F.col("ring"), F.col("nth")).otherwise(F.col("parts") - 1)), lambda p: F.struct(r.alias("ring"), p.alias("nth")))))
    a, b = own.alias("a"), own.select("block", "id", "bits", F.col("ring").alias("own_ring"), F.col("nth").alias("own_nth"), F.explode(parts).alias("met")).select("*", "met.ring", "met.nth").alias("b")
    far = F.bit_count(F.col("a.bits").bitwiseXOR(F.col("b.bits")))
    same = (F.col("b.own_ring") == F.col("b.ring")) & (F.col("b.own_nth") == F.col("b.nth"))
    on = (F.col("a.block") == F.col("b.block")) & (F.col("a.ring") == F.col("b.ring")) & (F.col("a.nth") == F.col("b.nth")) & (~same | (F.col("a.id") < F.col("b.id"))) & (far <= most)
    return a.join(b, on).select(F.least("a.id", "b.id").alias("left_id"), F.greatest("a.id", "b.id").alias("right_id"), far.alias("distance"))


def decide(files: DataFrame, block: str = "text_id", order: str = "order_no") -> DataFrame:
    """Duplicate edges inside blocks of equal text: dup, origin.

    ``files``: id, ``block``, ``order``, n_images, deleted. Of a block the file with most images stays, then
    one that is not deleted, then the one with the larger order, then the larger id; the others are its
    duplicates. This is what the pairwise comparison of sub-sets comes to where image sets are nested; where they
    may cross, ``images.store_fold`` compares the sets themselves.
    """
    best = F.max_by("id", F.struct("n_images", ~F.col("deleted"), order, "id")).alias("origin")
    kept = files.groupBy(block).agg(best)
    return files.join(kept, block).where("id <> origin").select(F.col("id").alias("dup"), "origin")


def overlapping(rows: DataFrame, percent: int) -> DataFrame:
    """left_id, right_id, shared: pairs of word sets (id, words) with 100 * shared >= ``percent`` * union.

    Sets are ordered rare word first. Two such sets share a word among the first few of each, so they meet by
    those alone; the words of every title (a stop word's pairs are all pairs) hardly ever are among them.
    """
    often = rows.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("often"))
    ranked = rows.select("id", F.explode("words").alias("word")).join(often, "word").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("often", "word"))).alias("x"))
    sets = ranked.select("id", F.col("x.word").alias("words")).withColumn("n", F.size("words"))
    kept = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")
    heads = sets.select("id", "words", "n", F.explode(F.slice("words", F.lit(1), kept)).alias("word"))
    a, b = heads.alias("a"), heads.alias("b")
    long_enough = (100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n"))
    met = a.join(b, (F.col("a.word") == F.col("b.word")) & (F.col("a.id") < F.col("b.id")) & long_enough)
    shared = F.size(F.array_intersect("a.words", "b.words"))
    first = F.get(F.array_intersect("a.words", "b.words"), F.lit(0)) == F.col("a.word")  # a pair counts at the first word it meets by
    found = met.where(first).select(F.col("a.id").alias("left_id"), F.col("b.id").alias("right_id"), shared.cast("long").alias("shared"), F.col("a.n").alias("na"), F.col("b.n").alias("nb"))
    return found.where(100 * F.col("shared") >= percent * (F.col("na") + F.col("nb") - F.col("shared"))).select("left_id", "right_id", "shared")
