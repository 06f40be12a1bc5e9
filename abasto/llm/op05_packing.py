"""Packing of token ids into windows by minimum bin slack.

Every document is encoded and ended. Whole windows are cut off its front; the rest joins a pool of remaining lengths.
While the pool has pieces, the longest one opens a window, and a subset-sum search over the multiset of lengths (a bitset
of reachable sums, one layer per length and power-of-two count) finds the pieces that come closest to the window's
capacity; walking the layers backwards gives how many of each length. A choice is used for as many windows as the counts
allow. Where even the closest choice leaves slack, the shortest piece longer than the slack is cut to fill it. What is
left at the end of a task, less than a window, is cut into windows of a power of two, which need no padding.

Each task packs the rows it reads, in pools of bounded size, so nothing is shuffled. ``sequence_id`` carries the task's
number in its upper bits.

Null text: only the end id. Null or repeated ``doc_id``: every row is packed on its own. Empty table: no rows. Other
columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abasto.llm.common import prepare
from abasto.llm.tokens import encoder

WINDOW = 2048
END = 1
POOL = 1 << 21  # ids in a pool

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)


def closest(capacity: int, lengths: Iterable[int], count: Callable[[int], int]) -> dict[int, int]:
    """How many pieces of which length sum closest to ``capacity`` from below. ``lengths`` descend; ``count`` says how many
    there are of each."""
    reach, layers, target, within = 1, [], 1 << capacity, (1 << (capacity + 1)) - 1
    for length in lengths:
        left, step = min(count(length), capacity // length), 1
        while left > 0:
            take = min(step, left)
            more = (reach | (reach << (length * take))) & within
            layers.append((length, take, reach))
            reach, left, step = more, left - take, step * 2
        if reach & target:
            break
    total, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(layers):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= length * take
    return used


class Pool:
    """Remaining pieces by length: (doc, start, ids as bytes, ids of the document)."""

    def __init__(self, window: int):
        self.window, self.total = window, 0
        self.by_length: dict[int, list[tuple]] = {}
        self.lengths: list[int] = []  # ascending

    def add(self, piece: tuple) -> None:
        length = len(piece[2]) // 4
        if length not in self.by_length:
            self.by_length[length] = []
            insort(self.lengths, length)
        self.by_length[length].append(piece)
        self.total += length

    def _take(self, length: int) -> tuple:
        pieces = self.by_length[length]
        piece = pieces.pop()
        if not pieces:
            del self.by_length[length]
            del self.lengths[bisect_left(self.lengths, length)]
        self.total -= length
        return piece

    def _left(self, length: int, opening: int) -> int:
        """Pieces of a length beside the one that opens the window."""
        return len(self.by_length[length]) - (length == opening)

    def windows(self, last: bool) -> Iterator[list[tuple]]:
        """Full windows; with ``last``, what is left too, in windows of a power of two."""
        while self.total >= self.window:
            longest = self.lengths[-1]
            room = self.window - longest
            fitting = range(bisect_right(self.lengths, room) - 1, -1, -1)
            used = closest(room, map(self.lengths.__getitem__, fitting), lambda n: self._left(n, longest)) if room else {}
            used[longest] = used.get(longest, 0) + 1
            slack = self.window - sum(length * count for length, count in used.items())
            times = min(len(self.by_length[length]) // count for length, count in used.items())
            for _ in range(1 if slack else times):
                chosen = [self._take(length) for length, count in used.items() for _ in range(count)]
                if slack:  # more than a window is left, none of the rest fits: each piece is longer than the slack
                    doc, start, ids, size = self._take(self.lengths[0])
                    chosen.append((doc, start, ids[: 4 * slack], size))
                    self.add((doc, start + slack, ids[4 * slack :], size))
                yield chosen
        while last and self.total:
            room, chosen = 1 << (self.total.bit_length() - 1), []
            while room:
                doc, start, ids, size = self._take(self.lengths[-1])
                chosen.append((doc, start, ids[: 4 * room], size))
                if len(ids) > 4 * room:
                    self.add((doc, start + room, ids[4 * room :], size))
                room -= len(chosen[-1][2]) // 4
            yield chosen


def pack_partition(path: str | None = None, end: int = END, window: int = WINDOW, pool_size: int = POOL):
    """A function for ``mapInArrow``: (doc_id, text) to piece rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, tail = encoder(path).encode, np.array([end], dtype="<u4").tobytes()
        number = TaskContext.get().partitionId() << 36
        pool, rows = Pool(window), []

        def place(pieces: list[tuple]) -> None:
            nonlocal number
            offset = 0
            for doc, start, ids, size in pieces:
                length = len(ids) // 4
                rows.append((doc, start, length, zlib.crc32(ids), size, number, offset))
                offset += length
            number += 1

        def flush() -> pa.RecordBatch:
            columns = [pa.array(values, pa.int64()) for values in zip(*rows, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(
                columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            )

        for batch in batches:
            texts = batch.column(1)
            for row, doc in enumerate(batch.column(0).to_pylist()):
                ids = encode(texts[row].as_py() or "").tobytes() + tail
                size = len(ids) // 4
                whole = size // window * window
                for start in range(0, whole, window):
                    place([(doc, start, ids[4 * start : 4 * (start + window)], size)])
                if whole < size:
                    pool.add((doc, whole, ids[4 * whole :], size))
                if pool.total >= pool_size:
                    for pieces in pool.windows(last=False):
                        place(pieces)
                if len(rows) >= 20_000:
                    yield flush()
        for pieces in pool.windows(last=True):
            place(pieces)
        if rows:
            yield flush()

    return run


def pack(docs: DataFrame, vocabulary: str | None = None, end: int = END, window: int = WINDOW) -> DataFrame:
    """One row per piece: its place in its document and in its sequence."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(pack_partition(vocabulary, end, window), SCHEMA)
