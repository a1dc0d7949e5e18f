"""Groups of spelling variants: words one edit apart, each under the much more frequent word it stands for.

A word is cut into two halves. An edit leaves one half of the longer, the shorter or the equal word as it is: at
the beginning of the other word (first half) or at its end (second half). Halves are dealt out to shards by their
hash; a shard's Aho-Corasick automaton finds in one pass which of its halves a word holds, hits are kept where offset
and length fit, and the distance is verified by looking the rest of the word up in the shard's words of that
half: with one code point blanked, with one taken out, or among words with one taken out.
Each near pair has one edit that counts (of a stretch of equal letters the last), so it is found once.
"""

from __future__ import annotations

import collections
import re
import zlib
from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from bookloom.llm.common import discard, materialise

#: Fixed value: the letters of a word.
LETTERS = "A-Za-zÀ-ÿ"
_HELD, _SCANNED = 0, 1


def count_words(df: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 7, least: int = 2, edit: Callable[[int | None, str], str] | None = None, buffer: int = 250_000) -> DataFrame:
    """(word, n): words of ``shortest`` code points that occur ``least`` times or more, with A-Z in lower case.

    A task adds up what it has read (at most ``buffer`` words at a time) before anything is shuffled.
    ``edit`` (id, word) may change a document's words before they are counted. A null text has no word.
    """
    runs = re.compile(f"[{LETTERS}]{{{shortest},}}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, int] = collections.defaultdict(int)
        for batch in batches:
            for doc, words in zip(batch["k"], batch["t"]):
                doc = None if pd.isna(doc) else int(doc)
                # bytes are lowered at A-Z alone
                for w, n in collections.Counter(runs.findall(words.encode().lower().decode())).items():
                    total[w if edit is None else edit(doc, w)] += n
                if len(total) > buffer:
                    yield pd.DataFrame({"word": total.keys(), "n": total.values()})
                    total.clear()
        yield pd.DataFrame({"word": list(total.keys()), "n": list(total.values())}).astype({"word": "object", "n": "int64"})

    found = df.selectExpr(f"cast(`{key}` as long) as k", f"coalesce(`{text}`, '') as t").mapInPandas(run, "word string, n long")
    return found.where(F.char_length("word") >= shortest).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class Shard:
    """Words under one of their halves; ``scan`` gives (number of near words, the best of them) among these."""

    def __init__(self):
        self.words: dict[str, dict[str, int]] = {"P": {}, "S": {}}
        self.blanked: dict[str, list] = {}  # kind and word with one code point blanked -> [words, best, second best]
        self.without: dict[str, list] = {}  # kind and word with one code point taken out -> [words, best]
        self.halves: ahocorasick.Automaton | None = None
        self._of: dict[str, set[tuple[str, int]]] = collections.defaultdict(set)

    def add(self, kind: str, word: str, n: int) -> None:
        if word in self.words[kind]:
            return
        self.words[kind][word] = n
        half, length, own = len(word) // 2, len(word), (-n, word)
        self._of[word[:half] if kind == "P" else word[half:]].add((kind, length))
        for i in range(half, length) if kind == "P" else range(half):
            entry = self.blanked.setdefault(f"{kind}{word[:i]} {word[i + 1:]}", [0, None, None])
            entry[0] += 1
            if entry[1] is None or own < entry[1]:
                entry[1:] = own, entry[1]
            elif entry[2] is None or own < entry[2]:
                entry[2] = own
            if i + 1 == length or word[i] != word[i + 1]:
                entry = self.without.setdefault(f"{kind}{word[:i]}{word[i + 1:]}", [0, own])
                entry[0] += 1
                entry[1] = min(entry[1], own)

    def build(self) -> None:
        self.halves = ahocorasick.Automaton()
        for half, kinds in self._of.items():
            self.halves.add_word(half, (len(half), kinds))
        if self._of:
            self.halves.make_automaton()

    def scan(self, word: str) -> tuple[int, tuple[int, str] | None]:
        if not self._of:
            return 0, None
        length, count, best = len(word), 0, None
        for stop, (size, kinds) in self.halves.iter(word):
            at_start, at_end = stop + 1 == size, stop + 1 == length
            if not at_start and not at_end:
                continue
            for kind, other in kinds:
                if not (at_start if kind == "P" else at_end):
                    continue
                if other == length:
                    half, own = length // 2, word in self.words[kind]
                    for i in range(half, length) if kind == "P" else range(half):
                        if (entry := self.blanked.get(f"{kind}{word[:i]} {word[i + 1:]}")) and entry[0] > own:
                            count += entry[0] - own
                            first = entry[2] if own and entry[1][1] == word else entry[1]
                            best = first if best is None else min(best, first)
                elif other == length + 1:
                    if entry := self.without.get(f"{kind}{word}"):
                        count += entry[0]
                        best = entry[1] if best is None else min(best, entry[1])
                elif other == length - 1:
                    half = other // 2
                    for i in range(half, length) if kind == "P" else range(half):
                        if i + 1 == length or word[i] != word[i + 1]:
                            less = f"{word[:i]}{word[i + 1:]}"
                            if (n := self.words[kind].get(less)) is not None:
                                count += 1
                                best = (-n, less) if best is None else min(best, (-n, less))
        return count, best


def _scan_units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by unit, held words first: each unit's words are scanned by its own automaton, each once."""
    unit, shard, last = None, Shard(), None
    for batch in batches:
        out = []
        for u, role, kind, word, n in zip(*(batch[c].tolist() for c in ("unit", "role", "kind", "word", "n"))):
            if u != unit:
                unit, shard, last = u, Shard(), None
            if role == _HELD:
                shard.add(kind, word, n)
                continue
            if word == last:
                continue  # it came for another of its halves
            if shard.halves is None:
                shard.build()
            last = word
            count, best = shard.scan(word)
            if count:
                out.append((word, count, best[0], best[1]))
        yield pd.DataFrame(out, columns=["word", "count", "minus", "form"])


def _half_keys(word: Column) -> tuple[Column, Column]:
    """(keys of the word's own halves, keys of all halves that may stand in it unedited): kind and half."""
    n = F.char_length(word)
    first = lambda length: F.concat(F.lit("P"), F.substring(word, F.lit(1), F.floor(length / 2).cast("int")))
    second = lambda length: F.concat(F.lit("S"), F.right(word, F.ceil(length / 2).cast("int")))
    near = [n - 1, n, n + 1]
    return F.array(first(n), second(n)), F.array_distinct(F.array(*[first(x) for x in near], *[second(x) for x in near]))


def near_words(counted: DataFrame, held_words: int = 4_000, hot: int = 20_000, broadcast_rows: int = 100_000) -> DataFrame:
    """(word, count, best): for words that have near ones their number, and the best as a struct (minus n, form).

    ``counted``: materialised (word, n), words different and of two code points at least. A shard holds about
    ``held_words`` words. A half that more than ``hot`` words have is cut into parts on both sides, and every
    part of its words meets every part of those that scan it in a unit of its own, so no task grows with a
    half. Near words are counted inside the shards; no pair is emitted.
    """
    own, all_keys = _half_keys(F.col("word"))
    held = counted.select("word", "n", F.explode(own).alias("key"))
    scanned = counted.select("word", F.lit(None).cast("long").alias("n"), F.explode(all_keys).alias("key"))
    cut = materialise(held.groupBy("key").count().where(F.col("count") > hot).select("key", F.ceil(F.col("count") / hot).cast("int").alias("parts")), "hot")
    known = cut.count()
    units = max(1, -(-2 * counted.count() // held_words))

    def dealt(rows: DataFrame, role: int) -> DataFrame:
        rows = rows.withColumn("kind", F.substring("key", 1, 1))
        shard = F.pmod(F.xxhash64("key"), F.lit(units)).cast("string")
        if known:
            rows = rows.join(F.broadcast(cut) if known <= broadcast_rows else cut, "key", "left")
            part = F.pmod(F.xxhash64("word"), F.col("parts"))
            # the other side's parts, each of which this row has to meet
            rows = rows.withColumn("met", F.explode_outer(F.when(F.col("parts").isNotNull(), F.sequence(F.lit(0), F.col("parts") - 1))))
            block = [part, F.col("met")] if role == _HELD else [F.col("met"), part]
            shard = F.when(F.col("parts").isNull(), shard).otherwise(F.concat_ws(" ", "key", *[x.cast("string") for x in block]))
        rows = rows.select(shard.alias("unit"), F.lit(role).alias("role"), "kind", "word", "n")
        return rows

    rows = dealt(held, _HELD).unionByName(dealt(scanned, _SCANNED))
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, units // 16 + 1)
    found = rows.repartition(tasks, "unit").sortWithinPartitions("unit", "role", "word").mapInPandas(_scan_units, "word string, count long, minus long, form string")
    return found.groupBy("word").agg(F.sum("count").alias("count"), F.min(F.struct("minus", "form")).alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that following forms leads to. A form is more frequent than its word, so there is no circle."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("far"))
        step = materialise(now.join(on, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "roots")
        moved = step.where("moved").limit(1).count()
        discard(now, collect=False)
        now = step
        if not moved:
            return now.select("word", "root")


def group_variants(df: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 7, least: int = 2, ratio: int = 10, edit: Callable[[int | None, str], str] | None = None, **limits: int) -> DataFrame:
    """One row per word: word, form, root (strings), n, n_near, form_n.

    Words are the stretches of Latin letters of all texts, A-Z lowered, of ``shortest`` code points and
    ``least`` occurrences. Near words differ by one inserted, deleted or replaced code point. ``form`` is the
    near word of largest n (ties: the smallest), if it has ``ratio`` times the word's n; ``root`` is where forms
    lead in the end. Null and empty texts have no word; ids are used by ``edit`` alone and may be null or
    repeat; repeated rows count each; extra columns are not read, whatever their names; an empty table gives no
    rows. Texts are read whole, one at a time. ``limits`` go to ``near_words``.
    """
    if shortest < 2 or ratio < 2:
        raise ValueError("words of one code point have no two halves, and forms must be more frequent than their words")
    counted = materialise(count_words(df, key, text, shortest, least, edit), "words")
    near = near_words(counted, **limits).select("word", F.lit(None).cast("long").alias("n"), "count", "best")
    own = counted.select("word", "n", F.lit(None).cast("long").alias("count"), F.lit(None).cast("struct<minus: long, form: string>").alias("best"))
    all_rows = own.unionByName(near).groupBy("word").agg(F.max("n").alias("n"), F.coalesce(F.max("count"), F.lit(0)).alias("n_near"), F.min("best").alias("best"))
    far = -F.col("best.minus") >= ratio * F.col("n")
    out = materialise(all_rows.select("word", "n", "n_near", F.when(far, F.col("best.form")).alias("form"), F.when(far, -F.col("best.minus")).alias("form_n")), "forms")
    roots = _roots(out.where("form is not null").select("word", "form"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
