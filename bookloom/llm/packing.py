"""Packing of token sequences: whole windows are cut off, the rest is balanced by multiway differencing.

Largest differencing (Karmarkar and Karp) starts with one partial partition per piece, always merges the
two with the widest imbalance, largest part onto smallest, and so ends with windows of nearly equal
length. Where the fullest window exceeds the capacity the number of windows rises and the block is
partitioned again. Blocks are runs of rows within a task, so nothing is shuffled.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from bookloom.llm.bpe import token_chunks, worker_chunks
from bookloom.llm.common import trimmed


def differencing(lengths: list[int], k: int) -> tuple[np.ndarray, list[int]]:
    """(window of each length, sums of the ``k`` windows) by Karmarkar-Karp multiway differencing."""
    n = len(lengths)
    if k == 1:
        return np.zeros(n, dtype=np.int64), [sum(lengths)]
    sums: dict[int, np.ndarray] = {}
    heap: list[tuple[int, int]] = []
    merged: dict[int, tuple[int, int, np.ndarray, np.ndarray]] = {}
    for i, x in enumerate(lengths):
        one = np.zeros(k, dtype=np.int64)
        one[0] = x
        sums[i] = one
        heap.append((-x, i))
    heapq.heapify(heap)
    node = n
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        both = sums.pop(a) + sums.pop(b)[::-1]  # both in falling order: the opposing imbalances meet
        order = np.argsort(-both, kind="stable")
        both = both[order]
        sums[node] = both
        merged[node] = (a, b, order, None)
        heapq.heappush(heap, (-int(both[0] - both[-1]), node))
        node += 1
    root = heap[0][1]
    window = np.zeros(n, dtype=np.int64)
    stack = [(root, np.arange(k))]  # slot of the node -> window
    while stack:
        at, slots = stack.pop()
        if at < n:
            window[at] = slots[0]
            continue
        a, b, order, _ = merged[at]
        back = np.empty(k, dtype=np.int64)
        back[order] = slots  # slot before sorting -> window
        stack.append((a, back))
        stack.append((b, back[::-1]))
    return window, sums[root].tolist()


def balanced(lengths: list[int], capacity: int) -> tuple[np.ndarray, int]:
    """Windows of at most ``capacity`` for pieces that each fit; the count rises until all do."""
    k = max(1, -(-sum(lengths) // capacity))
    while True:
        window, sums = differencing(lengths, k)
        if max(sums) <= capacity:
            return window, k
        k += max(1, k // 100)


class Packer:
    """Packs the ids of one task's documents; a block is balanced once its rests fill ``windows`` windows."""

    def __init__(self, capacity: int, piece: int, windows: int, first_id: int):
        self.capacity, self.piece, self.limit, self.next_id = capacity, piece, windows * capacity, first_id
        self.rests: list[tuple] = []
        self.waiting = 0
        self.rows: list[tuple] = []

    def add(self, key, ids: bytes) -> None:
        total = len(ids) // 4
        whole = total - total % self.capacity
        for start in range(0, whole, self.capacity):
            self._row(key, start, self.capacity, ids, total, self.next_id, 0)
            self.next_id += 1
        for start in range(whole, total, self.piece):
            n = min(self.piece, total - start)
            self.rests.append((key, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), total))
            self.waiting += n
        if self.waiting >= self.limit:
            self.close()

    def _row(self, key, start, n, ids, total, sequence, offset) -> None:
        self.rows.append((key, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), total, sequence, offset))

    def close(self) -> None:
        if self.rests:
            window, k = balanced([x[2] for x in self.rests], self.capacity)
            filled = [0] * k
            used: dict[int, int] = {}
            for (key, start, n, crc, total), w in zip(self.rests, window.tolist()):
                sequence = used.setdefault(w, self.next_id + len(used))
                self.rows.append((key, start, n, crc, total, sequence, filled[w]))
                filled[w] += n
            self.next_id += len(used)
        self.rests, self.waiting = [], 0

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = 1024, end_id: int = 0, piece: int = 512, windows: int = 192, cache: int = 700_000, keep: bool = False) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids (``path``: a byte-level vocabulary; null text: empty) and ``end_id``. Its first
    multiples of ``capacity`` tokens are sequences of their own; the rest is cut into pieces of at most
    ``piece`` tokens, which are balanced in blocks of about ``windows`` windows of a task. Every id lies
    in exactly one piece. ``sequence_id`` starts at the task's number times 2^33, so no task needs another.
    With ``keep`` workers keep their token caches from task to task, which saves a fifth of the time and holds
    some 200 MB a worker for as long as it lives. Ids of rows may be null or repeat; extra columns are not
    read. An empty table gives no rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, chunks = worker_chunks(path, cache) if keep else token_chunks(path, cache)
        end = np.array([end_id], dtype="<u4").tobytes()
        packer = Packer(capacity, piece, windows, TaskContext.get().partitionId() << 33)
        for batch in batches:
            for doc, words in zip(batch["k"], batch["t"]):
                parts = chunks.split(words) if words else (b"", ())
                ids = encoder.whole(words) if parts is None else b"".join([parts[0] or b"", *parts[1]])
                packer.add(None if pd.isna(doc) else int(doc), ids + end)
                if len(packer.rows) > 20_000:
                    yield _frame(packer.take())
        packer.close()
        yield _frame(packer.take())

    def _frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=_COLUMNS)
        return out.astype({"doc_id": "Int64"} | {c: "int64" for c in _COLUMNS[1:]})

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    out = df.selectExpr(f"cast(`{key}` as long) as k", f"coalesce(`{text}`, '') as t").mapInPandas(trimmed(run), schema)
    return out.withColumnRenamed("doc_id", key) if key != "doc_id" else out
