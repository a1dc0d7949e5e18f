"""Maximal periodic runs of words, from the suffix tree of a batch of texts.

After Stoye and Gusfield: at a node of word depth d every leaf i of all its children but the largest is tried
with i + d and i - d; where both are leaves of the node and the words behind differ, a branching tandem repeat
(a square that cannot be shifted right) of period d begins. Each leaf is tried once for each time it lies in a
smaller child, so n log n times at most. A branching repeat is rotated left as long as the words agree, and
repeats that reach the same stretch are merged under their smallest period.

The tree is kept as intervals of the sorted suffixes. Suffixes are sorted by prefix doubling, and texts of a
batch share no word number, so no common prefix crosses from one text to another.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Pairs of a leaf and a node tried at once.
_PAIRS = 1 << 21


def _refine(rank: np.ndarray, other: np.ndarray, h: int) -> np.ndarray:
    """Ranks by (rank, the ``other`` rank ``h`` words on); a rank is the number of smaller suffixes."""
    n = len(rank)
    shared = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    if not len(shared):
        return rank
    then = shared + h
    key = rank[shared].astype(np.int64) * (n + 1) + np.where(then < n, other[np.minimum(then, n - 1)] + 1, 0)
    order = np.argsort(key, kind="stable")
    key, at = key[order], np.arange(len(order))
    old = key // (n + 1)
    first = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], at, 0))
    group = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], at, 0))
    out = rank.copy()
    out[shared[order]] = old + first - group
    return out


def _pairs(ids: np.ndarray) -> np.ndarray:
    """Ranks by two words."""
    n = len(ids)
    key = (ids.astype(np.int64) << 32) + np.r_[ids[1:] + 1, 0]
    order = np.argsort(key, kind="stable")
    key, at = key[order], np.arange(n)
    rank = np.empty(n, dtype=np.int32)
    rank[order] = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], at, 0))
    return rank


def repeated(ids: np.ndarray, least: int) -> np.ndarray:
    """Whether the ``least // 2`` words from each place on occur again: every run of ``least`` words begins so."""
    rank, width = _pairs(ids), 2
    two = rank
    while width + 2 <= least // 2:
        rank, width = _refine(rank, two, width), width + 2
    return np.bincount(rank, minlength=len(ids))[rank] > 1


def _smaller_before(x: np.ndarray) -> np.ndarray:
    """For each place the last one before it with a smaller value; the first place, where there is none."""
    at = np.maximum(np.arange(len(x)) - 1, 0)
    todo = np.flatnonzero((x[at] >= x) & (at > 0))
    while len(todo):
        at[todo] = at[at[todo]]
        todo = todo[(x[at[todo]] >= x[todo]) & (at[todo] > 0)]
    return at


def branching_repeats(ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, periods) of the branching tandem repeats u u whose two halves begin at ``places``."""
    none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    n, h, levels = len(ids), 2, []
    rank = _pairs(ids)
    while np.bincount(rank, minlength=n).max(initial=0) > 1:
        levels.append((h, rank))
        rank, h = _refine(rank, rank, h), 2 * h
    suffixes = places[np.argsort(rank[places])]
    m = len(suffixes)
    if m < 2:
        return none
    a, b = suffixes[:-1], suffixes[1:]
    common = np.zeros(m - 1, dtype=np.int64)
    for width, at in [*reversed(levels), (1, ids)]:
        x, y = a + common, b + common
        inside = np.maximum(x, y) < n
        common += width * (inside & (at[np.minimum(x, n - 1)] == at[np.minimum(y, n - 1)]))
    depth = np.r_[-1, common, -1]  # depth[k]: of the prefix that suffixes k-1 and k share
    left = _smaller_before(depth)
    right = m - _smaller_before(depth[::-1])[::-1]
    cuts = np.flatnonzero(depth > 0)
    if not len(cuts):
        return none
    # a node is the interval left .. right of all places with its depth in between; these cut it into its children
    nodes, node = np.unique(left[cuts] * (m + 1) + right[cuts], return_inverse=True)
    order = np.argsort(node, kind="stable")
    cuts, node = cuts[order], node[order]
    new = np.r_[True, node[1:] != node[:-1]]
    last = np.r_[new[1:], True]
    low, high, d = nodes // (m + 1), nodes % (m + 1), np.zeros(len(nodes), dtype=np.int64)
    d[node] = depth[cuts]
    begin = np.r_[np.where(new, low[node], np.r_[0, cuts[:-1]]), cuts[last]]
    end = np.r_[cuts, high[node[last]]]
    owner = np.r_[node, node[last]]
    order = np.lexsort((end - begin, owner))
    begin, end, owner = begin[order], end[order], owner[order]
    small = np.r_[owner[1:] == owner[:-1], False]  # all children but a node's largest
    begin, end, owner = begin[small], end[small], owner[small]
    where = np.full(n, -1, dtype=np.int64)
    where[suffixes] = np.arange(m)
    starts, periods = [], []
    ends = np.cumsum(end - begin)
    at = 0
    while at < len(ends):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PAIRS)))
        size = end[at:upto] - begin[at:upto]
        of = np.repeat(owner[at:upto], size)
        leaf = suffixes[np.arange(len(of)) + np.repeat(begin[at:upto] - (np.cumsum(size) - size), size)]
        for first in (leaf, leaf - d[of]):
            second = first + d[of]
            other = np.where(first == leaf, second, first)
            found = (other >= 0) & (other < n)
            found &= (where[np.clip(other, 0, n - 1)] >= low[of]) & (where[np.clip(other, 0, n - 1)] < high[of])
            i, q = first[found], d[of[found]]
            stop = i + 2 * q
            branching = (stop >= n) | (ids[np.minimum(stop, n - 1)] != ids[np.minimum(stop - q, n - 1)])
            starts.append(i[branching])
            periods.append(q[branching])
        at = upto
    both = np.unique(np.concatenate(starts) * (n + 1) + np.concatenate(periods))
    return both // (n + 1), both % (n + 1)


def _rotated(ids: np.ndarray, start: int, period: int) -> int:
    """Where the stretch of this period that ends with the square at ``start`` begins."""
    step = 16
    while start > 0:
        low = max(0, start - step)
        differ = np.flatnonzero(ids[low:start] != ids[low + period : start + period])
        if len(differ):
            return low + int(differ[-1]) + 1
        start, step = low, 2 * step
    return 0


def maximal_runs(ids: np.ndarray, least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of the maximal runs of ``least`` words and two periods at least.

    ``ids`` may be several texts one after the other, if no number occurs in two of them.
    """
    again = repeated(ids, least)
    # the halves of a run's last square lie at most this far behind a place that is repeated
    near, reach = again.copy(), least // 2 - 1
    for back in range(1, reach + 1):
        near[back:] |= again[:-back]
    starts, periods = branching_repeats(ids, np.flatnonzero(near))
    alive = np.ones(len(starts), dtype=bool)
    for back in range(1, least - 1):  # short squares must be rotated far enough to the left
        x = starts - back
        alive &= (2 * periods + back > least) | (x >= 0) & (ids[np.maximum(x, 0)] == ids[np.maximum(x + periods, 0)])
    starts, periods = starts[alive], periods[alive]
    out, stop, begin = [], -1, 0
    order = np.lexsort((periods, starts + 2 * periods))
    for i, q in zip(starts[order].tolist(), periods[order].tolist()):
        if i + 2 * q == stop and i >= begin:
            continue  # a multiple of the period of the run that ends here
        stop, begin = i + 2 * q, _rotated(ids, i, q)
        out.append((begin, stop - begin, q))
    return sorted(out)


def _numbered(texts: list[list[bytes]]) -> np.ndarray:
    """The words of all texts as numbers; a text's numbers are its own."""
    out, base = np.empty(sum(map(len, texts)), dtype=np.int64), 0
    at = 0
    for words in texts:
        known: dict[bytes, int] = {}
        out[at : at + len(words)] = [known.setdefault(w, base + len(known)) for w in words]
        at, base = at + len(words), base + len(known)
    return out.astype(np.int32) if base < 1 << 31 else out


def runs_of_texts(texts: list[list[bytes]], least: int = 12) -> list[list[tuple[int, int, int]]]:
    """The maximal runs of each text, by start and period; only texts that repeat ``least // 2`` words get a tree."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    long = [k for k, words in enumerate(texts) if len(words) >= least]
    if not long:
        return out
    ids = _numbered([texts[k] for k in long])
    ends = np.cumsum([len(texts[k]) for k in long])
    again = np.add.reduceat(repeated(ids, least), ends - [len(texts[k]) for k in long]) > 0
    chosen = [k for k, yes in zip(long, again.tolist()) if yes]
    if not chosen:
        return out
    ids = ids[np.repeat(again, [len(texts[k]) for k in long])]
    sizes = np.array([len(texts[k]) for k in chosen])
    begins = np.cumsum(sizes) - sizes
    found = maximal_runs(ids, least)
    of = np.searchsorted(begins, [x[0] for x in found], side="right") - 1
    for (start, length, period), t in zip(found, of.tolist()):
        out[chosen[t]].append((start - int(begins[t]), length, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by spaces, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    step = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    return b" ".join([w for w, covered in zip(words, np.cumsum(step[:-1]).tolist()) if not covered])


def find_runs(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = 12, prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per document: key, runs (array of start, length, period by start and period), collapsed (text).

    Words are stretches without ASCII white space, compared as they are. A run is a maximal stretch of
    ``least`` words or more that repeats its first ``period`` words, two times over at least; start is a word
    number from 0. ``collapsed`` holds the words outside runs and those of each run's first period, joined by
    one space. ``prepare`` (id, words) may change the words before. Null and empty texts have no run and an
    empty ``collapsed``; ids may be null or repeat, every row is taken by itself; extra columns are not read,
    whatever their names; an empty table gives no rows. One map over the rows, nothing is shuffled. Texts
    are taken in Arrow batches; a text is never cut, so a worker's memory follows the longest one (some 300
    bytes a word, if all of it repeats).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = [None if pd.isna(k) else int(k) for k in batch["k"]]
            texts = [t.encode().split() for t in batch["t"]]  # bytes split at ASCII white space alone
            if prepare is not None:
                texts = [prepare(k, words) for k, words in zip(keys, texts)]
            runs = runs_of_texts(texts, least)
            rows = [[{"start": s, "length": n, "period": p} for s, n, p in x] for x in runs]
            short = [collapsed(words, x).decode() for words, x in zip(texts, runs)]
            yield pd.DataFrame({"key": pd.array(keys, dtype="Int64"), "runs": rows, "collapsed": short})

    schema = "key long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    out = df.selectExpr(f"cast(`{key}` as long) as k", f"coalesce(`{text}`, '') as t").mapInPandas(run, schema)
    return out.withColumnRenamed("key", key)
