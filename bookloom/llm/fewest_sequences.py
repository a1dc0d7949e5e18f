"""Packing into few sequences by the sum of squares.

Open sequences are told apart by their gap alone. A piece goes where the sum of the squared numbers of open
sequences of each gap becomes smallest, so that gaps of one size never pile up while others lack; a new
sequence is opened only where no open one has room. Pieces come longest first.

Texts are tokenized in one map; what is packed are narrow rows without texts, dealt out to tasks of a bounded
number of pieces, so a small table is packed as one and a large one loses at most some open sequences a task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from bookloom.llm.bpe import worker_chunks
from bookloom.llm.common import materialise


class SumOfSquares:
    """Open sequences by gap; ``place`` gives (sequence, offset) of a piece. Sequences count from 0."""

    def __init__(self, capacity: int):
        self.capacity, self.made = capacity, 0
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.count = np.zeros(capacity + 1, dtype=np.int64)

    def place(self, length: int) -> tuple[int, int]:
        # moving one sequence from gap g to gap g - length changes the sum by 2 (count[g - length] - count[g] + 1)
        change = 2 * (self.count[: self.capacity + 1 - length] - self.count[length:] + 1)
        change[0] = 1 - 2 * self.count[length]  # a full sequence is closed: it counts nowhere
        change[self.count[length:] == 0] = np.iinfo(np.int64).max
        gap = length + int(change.argmin())
        if self.open[gap]:
            sequence = self.open[gap].pop()
            self.count[gap] -= 1
        else:
            gap, sequence = self.capacity, self.made
            self.made += 1
        rest = gap - length
        if rest:
            self.open[rest].append(sequence)
            self.count[rest] += 1
        return sequence, self.capacity - gap


def pieces(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 0, cache: int = 700_000) -> DataFrame:
    """One row per piece of every document's ids and ``end_id``: doc_id, piece, start, length, ids_crc32.

    Only documents of more than ``capacity`` ids are cut; all pieces but the first have ``capacity`` ids.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, chunks = worker_chunks(path, cache)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            rows = []
            for doc, words in zip(batch["k"], batch["t"]):
                parts = chunks.split(words) if words else (b"", ())
                ids = (encoder.whole(words) if parts is None else b"".join([parts[0] or b"", *parts[1]])) + end
                total = len(ids) // 4
                cuts = [0, *range((total - 1) % capacity + 1, total + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((None if pd.isna(doc) else int(doc), k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype({"doc_id": "Int64"})

    return df.selectExpr(f"cast(`{key}` as long) as k", f"coalesce(`{text}`, '') as t").mapInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 0, task_pieces: int = 200_000) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids (``path``: a byte-level vocabulary; null text: empty) and ``end_id``, kept whole if
    it has at most ``capacity`` of them. A task packs about ``task_pieces`` pieces, and holds no more of them
    than its open sequences. ``sequence_id`` is the task's number times 2^33 and a number in it, ``offset`` the
    place in the sequence, gapless from 0. Pieces are written to the shared folder first and dealt out by
    turns, so neither hot ids nor repeated rows meet in one task, and a task that is run again packs alike.
    Ids may be null or repeat, every row is packed by itself; a text of any length is tokenized whole; extra
    columns are not read, whatever their names; an empty table gives no rows.
    """
    cut = materialise(pieces(df, path, key, text, capacity, end_id), "pieces")
    tasks = max(1, -(-cut.count() // task_pieces))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins, base = SumOfSquares(capacity), TaskContext.get().partitionId() << 33
        for batch in batches:
            placed = [bins.place(n) for n in batch["length"].tolist()]
            yield batch.assign(sequence_id=[base + s for s, _ in placed], offset=[at for _, at in placed]).astype({"doc_id": "Int64"})

    dealt = cut.repartition(tasks).sortWithinPartitions(F.desc("length"), "doc_id", "piece", "start", "ids_crc32")
    out = dealt.mapInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("doc_id", key)
