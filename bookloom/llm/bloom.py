"""A pair of Bloom filters over 64-bit hashes: once seen, and seen twice or more.

Each task keeps the blocks of its two filters and sends them once, as bitmaps or, where few bits are set, as
positions: what it sends is bounded by the filter's size however many hashes it saw. Blocks are merged in
steps of 64 tasks, so no merge holds more than 64 pairs of blocks. The filters have 2^bits bits whatever the
input's size: a fuller one only lets more single hashes pass. One hash function is used, so a hash that was
added twice always passes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from bookloom.llm.common import materialise, trimmed

BLOCK_BITS, STEP = 20, 64


class TwiceSeen:
    """The twice-seen filter: blocks of 2^20 bits; blocks without a bit are left out."""

    def __init__(self, blocks: dict[int, bytes], bits: int):
        self.blocks, self.bits, self.width = blocks, bits, min(bits, BLOCK_BITS)

    def table(self) -> np.ndarray:
        """All bits as one array of bytes."""
        out = np.zeros(1 << (self.bits - 3), dtype=np.uint8)
        for k, b in self.blocks.items():
            out[k << (self.width - 3) : (k + 1) << (self.width - 3)] = np.frombuffer(b, np.uint8)
        return out


def passes(table: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Which hashes may have been added twice; ``table``: of ``TwiceSeen.table``."""
    at = hashes >> np.uint64(64 - bits)
    return (table[(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1


def _bitmap(positions: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros(1 << width, dtype=bool)
    out[positions] = True
    return np.packbits(out)


def _written(bitmap: np.ndarray, width: int) -> bytes:
    """A block's bits as positions where that is shorter than the bitmap."""
    n = int(np.bitwise_count(bitmap).sum())
    return bitmap.tobytes() if 4 * n >= len(bitmap) else np.flatnonzero(np.unpackbits(bitmap)).astype("<u4").tobytes()


def _read(block: bytes, width: int) -> np.ndarray:
    return np.frombuffer(block, np.uint8) if len(block) == 1 << (width - 3) else _bitmap(np.frombuffer(block, "<u4"), width)


class Blocks:
    """Both filters of one task or of several: block number -> (once, twice) as bitmaps."""

    def __init__(self, width: int):
        self.width, self.held = width, {}

    def add(self, block: int, once: np.ndarray, twice: np.ndarray) -> None:
        """Bits of another part: what both have seen once is seen twice."""
        if block in self.held:
            a, b = self.held[block]
            once, twice = a | once, b | twice | (a & once)
        self.held[block] = once, twice

    def rows(self, part: int, at_once: int = 8) -> Iterator[pd.DataFrame]:
        """A row per block, taken out of memory as they are written."""
        keys = sorted(self.held)
        for at in range(0, len(keys), at_once):
            found = [(k, part, *(_written(x, self.width) for x in self.held.pop(k))) for k in keys[at : at + at_once]]
            yield pd.DataFrame(found, columns=["block", "part", "once", "twice"])


def build(df: DataFrame, hashes: Callable[[Iterator[pd.DataFrame]], Iterator[np.ndarray]], bits: int, flush: int = 1_000_000) -> TwiceSeen:
    """The filter of the hashes that ``hashes`` gives for the partitions of ``df``.

    A task holds about ``flush`` hashes at a time and 2^(``bits`` - 2) bytes of bitmaps at most. The driver
    receives 2^``bits`` bits at most.
    """
    width = min(bits, BLOCK_BITS)
    schema = "block long, part long, once binary, twice binary"

    def positions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, held, n = Blocks(width), [], 0

        def take() -> None:
            once, many = np.unique(np.concatenate(held) >> np.uint64(64 - bits), return_counts=True)
            number = (once >> np.uint64(width)).astype(np.int64)
            low = (once & np.uint64((1 << width) - 1)).astype(np.int64)
            starts = np.flatnonzero(np.diff(number, prepend=-1))
            for at, end in zip(starts, [*starts[1:], len(once)]):
                own = low[at:end]
                out.add(int(number[at]), _bitmap(own, width), _bitmap(own[many[at:end] > 1], width))

        for h in hashes(batches):
            held.append(h)
            n += len(h)
            if n >= flush:
                take()
                held, n = [], 0
        if n:
            take()
        yield from out.rows(TaskContext.get().partitionId())

    def merge(parts: pd.DataFrame) -> pd.DataFrame:
        out = Blocks(width)
        for block, a, b in zip(parts["block"], parts["once"], parts["twice"]):
            out.add(int(block), _read(a, width), _read(b, width))
        return next(out.rows(int(parts["part"].iloc[0]) // STEP))

    step = lambda parts: materialise(parts.groupBy("block", F.expr(f"part div {STEP}").alias("next")).applyInPandas(merge, schema), "filter")
    parts = step(df.mapInPandas(trimmed(positions), schema))
    while (parts.agg(F.max("part").alias("n")).first()["n"] or 0) > 0:
        parts = step(parts)
    found = parts.select("block", "twice").collect()
    return TwiceSeen({r["block"]: _read(bytes(r["twice"]), width).tobytes() for r in found if len(r["twice"])}, bits)
