"""Filter interaction audit: what five filters remove, in every order, and what each of them alone is worth.

A table-driven transducer reads every text byte by byte in one pass. Its state says whether a word is open; its tables
give, for a state and a byte, what to count: a word that begins or ends, a capital, a code point, a symbol. The state
after a byte does not depend on the state before it, so all bytes of a slice go through the tables at once. Spans of
words are inserted into an open hash table whose entries are places: what meets in a slot is compared byte by byte
before it counts as the same word.

Filters, by the letter: A under 50 words; B 100 * different words < 65 * words; C 100 * capitals > 5 * code points;
D holds one of ``#$%&*|``; E has the text of a smaller ``doc_id``, anywhere in the table. A row that fails is removed by
the first filter of the order that it fails.

What the orders need of the rows is counted once: a text's letters depend on the text only, so rows are reduced to counts
by text digest (128 bits), part, letters and labels, the least id of each digest is the one that passes E, and the
counts of at most 32 sets of letters a part are spread over the 80 pairs of a filter and the set of filters before it.

Null text: as an empty one. Null source: the empty part. Null ``doc_id``: never fails E, makes no other row fail it, has no
label. Repeated ``doc_id``: every row counts, equal texts of one id do not fail E by each other. Repeated labels: a
document is good, or toxic, if one of its labels says so. Empty table: no part, so no row. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abasto.llm.common import mix, prepare, slices

FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5

# -- the transducer ------------------------------------------------------------------------------------------------

SPACE, CAPITAL, SYMBOL, INNER, OTHER = range(5)  # classes of bytes; INNER: a code point goes on
BETWEEN, WITHIN = range(2)  # states
BEGINS, ENDS, IS_CAPITAL, IS_POINT, IS_SYMBOL = 1, 2, 4, 8, 16  # outputs


def _class(byte: int) -> int:
    if byte == 0x20 or 0x09 <= byte <= 0x0D:
        return SPACE
    if 0x41 <= byte <= 0x5A:
        return CAPITAL
    if 0x80 <= byte <= 0xBF:
        return INNER
    return SYMBOL if chr(byte) in "#$%&*|" else OTHER


def _output(state: int, kind: int) -> int:
    found = {CAPITAL: IS_CAPITAL, SYMBOL: IS_SYMBOL}.get(kind, 0)
    if kind != INNER:
        found |= IS_POINT
    if state == BETWEEN and kind != SPACE:
        found |= BEGINS
    if state == WITHIN and kind == SPACE:
        found |= ENDS
    return found


NEXT = np.array([BETWEEN if _class(byte) == SPACE else WITHIN for byte in range(256)], dtype=np.uint16)
OUTPUT = np.array([[_output(state, _class(byte)) for byte in range(256)] for state in (BETWEEN, WITHIN)], dtype=np.uint8)


def transduce(data: np.ndarray) -> np.ndarray:
    """The outputs at every byte, from the state between words."""
    address = data.astype(np.uint16)
    address[1:] += NEXT[data[:-1]] << np.uint16(8)
    return OUTPUT.reshape(-1)[address]


# -- the hash table of spans ---------------------------------------------------------------------------------------

_CHUNKS = 8  # what is longer than so many times eight bytes is compared as Python bytes
_MASKS = np.array([(1 << (8 * count)) - 1 for count in range(9)], dtype=np.uint64)


class Spans:
    """Words of a slice as spans of its bytes. ``data`` ends in at least eight bytes that belong to no span."""

    def __init__(self, data: bytes, starts: np.ndarray, ends: np.ndarray):
        self.data, self.starts, self.lengths = data, starts, ends - starts
        self.at = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))  # the eight bytes from every place on

    def chunk(self, which: np.ndarray, number: int) -> np.ndarray:
        """Eight bytes of each span, cut at its end."""
        left = np.clip(self.lengths[which] - 8 * number, 0, 8)
        return self.at[self.starts[which] + np.minimum(8 * number, self.lengths[which])] & _MASKS[left]

    def hashes(self) -> np.ndarray:
        """Of the length, the first 64 and the last eight bytes."""
        every = np.arange(len(self.starts))
        found = mix(self.chunk(every, 0) + (self.lengths.astype(np.uint64) << np.uint64(56)))
        longer, number = every[self.lengths > 8], 1
        while len(longer) and number < _CHUNKS:
            found[longer] = mix(found[longer] ^ self.chunk(longer, number))
            number += 1
            longer = longer[self.lengths[longer] > 8 * number]
        if len(longer):
            last = self.at[self.starts[longer] + self.lengths[longer] - 8]
            found[longer] = mix(found[longer] ^ last)
        return found

    def same(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Whether two spans hold the same bytes."""
        equal = self.lengths[one] == self.lengths[other]
        left, number = np.flatnonzero(equal), 0
        while len(left) and number < _CHUNKS:
            good = self.chunk(one[left], number) == self.chunk(other[left], number)
            equal[left[~good]] = False
            number += 1
            left = left[good & (self.lengths[one[left]] > 8 * number)]
        for place in left.tolist():
            length = int(self.lengths[one[place]])
            a, b = int(self.starts[one[place]]), int(self.starts[other[place]])
            equal[place] = self.data[a : a + length] == self.data[b : b + length]
        return equal


def distinct_words(spans: Spans, owner: np.ndarray, texts: int) -> np.ndarray:
    """Different words of every text.

    All spans look for their slot together. Equal words of one text always stand before the same slot, so the one that
    gets a free slot is found by the others in the same round; who meets another word goes on to the next slot.
    """
    count = len(owner)
    size = 1 << max(4, (2 * count).bit_length())
    table = np.full(size, -1, dtype=np.int64)
    named = mix(spans.hashes() ^ mix(owner.astype(np.uint64)))
    slot = (named & np.uint64(size - 1)).astype(np.int64)
    new = np.zeros(count, dtype=bool)
    waiting = np.arange(count)
    while len(waiting):
        free = waiting[table[slot[waiting]] < 0]
        table[slot[free]] = free  # of several, one stays
        held = table[slot[waiting]]
        new[held[held == waiting]] = True
        met = (named[held] == named[waiting]) & (owner[held] == owner[waiting])
        rest = np.flatnonzero(met & (held != waiting))
        met[rest] = spans.same(held[rest], waiting[rest])
        waiting = waiting[~met]
        slot[waiting] = (slot[waiting] + 1) & (size - 1)
    return np.bincount(owner[new], minlength=texts)


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Words, different words, capitals, code points and symbols of every text."""
    data = b"\n".join(texts) + b"\n" + bytes(8)
    length = len(data) - 8
    outputs = transduce(np.frombuffer(data, dtype=np.uint8)[:length])
    ends = np.cumsum(np.fromiter((len(text) + 1 for text in texts), dtype=np.int64, count=len(texts)))
    starts = np.concatenate([[0], ends[:-1]])

    def counted(output: int) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(outputs & output), np.concatenate([[0], ends])))

    words = np.flatnonzero(outputs & BEGINS)
    owner = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(words, np.concatenate([[0], ends]))))
    spans = Spans(data, words, np.flatnonzero(outputs & ENDS))
    return {
        "words": np.bincount(owner, minlength=len(texts)),
        "distinct": distinct_words(spans, owner, len(texts)),
        "capitals": counted(IS_CAPITAL),
        "points": np.add.reduceat((outputs & IS_POINT) >> 3, starts, dtype=np.int64) - 1,  # less the line end between texts
        "symbols": counted(IS_SYMBOL),
    }


def fails(found: dict[str, np.ndarray]) -> np.ndarray:
    """The letters A to D that every text fails, as bits."""
    tests = [
        found["words"] < LEAST_WORDS,
        100 * found["distinct"] < DISTINCT_PERCENT * found["words"],
        100 * found["capitals"] > CAPITAL_PERCENT * found["points"],
        found["symbols"] > 0,
    ]
    return sum(test.astype(np.int32) << bit for bit, test in enumerate(tests))


def judge_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, part, text) to (doc_id, part, digest, mask)."""
    for batch, texts in slices(batches):
        digests = [hashlib.blake2b(text, digest_size=16).digest() for text in texts]
        columns = [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(fails(measure(texts)), pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "digest", "mask"])


# -- the audit -----------------------------------------------------------------------------------------------------


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: its part, its text's digest, and the letters A to D that it fails as bits."""
    prepare(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(judge_partition, "doc_id bigint, part string, digest binary, mask int")


def counts(judged: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask): documents, good and toxic ones among them, with E as the fifth letter."""
    known = (
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    )
    rows = judged.join(known, "doc_id", "left").fillna(0, ["good", "toxic"])
    same = ["digest", "part", "mask", "good", "toxic"]
    by_id = rows.groupBy(*same, "doc_id").agg(F.count("*").alias("n"))
    has_id = F.col("doc_id").isNotNull()
    by_text = by_id.groupBy(*same).agg(
        F.sum("n").alias("n"),
        F.min(F.when(has_id, F.struct("doc_id", "n"))).alias("least"),
        F.coalesce(F.sum(F.when(~has_id, F.col("n"))), F.lit(0)).alias("without_id"),
    )
    least = by_text.groupBy("digest").agg(F.min("least.doc_id").alias("first_id"))
    first = F.when(F.col("least.doc_id") == F.col("first_id"), F.col("least.n")).otherwise(0)
    split = by_text.join(least, "digest").withColumn("passing", first + F.col("without_id"))
    both = F.array(
        F.struct(F.col("mask").alias("mask"), F.col("passing").alias("n")),
        F.struct(F.col("mask").bitwiseOR(16).alias("mask"), (F.col("n") - F.col("passing")).alias("n")),
    )
    return (
        split.select("part", "good", "toxic", F.inline(both))
        .filter("n > 0")
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.col("good")).alias("n_good"),
            F.sum(F.col("n") * F.col("toxic")).alias("n_toxic"),
        )
    )


def _places() -> list[tuple[int, int, int, list[str]]]:
    """Every filter with every set of filters before it: both as bits, in how many orders, and in which."""
    found: dict[tuple[int, int], list[str]] = {}
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for letter in order:
            bit = 1 << FILTERS.index(letter)
            found.setdefault((bit, before), []).append(order)
            before |= bit
    return [(bit, before, len(orders), orders) for (bit, before), orders in found.items()]


def orders_of(counted: DataFrame) -> DataFrame:
    """One row per part, order and step."""
    places = F.array(
        *(
            F.struct(
                F.lit(bit).alias("bit"),
                F.lit(before).alias("before"),
                F.lit(bin(before).count("1") + 1).alias("step"),
                F.lit(ways).alias("ways"),
                F.array(*map(F.lit, orders)).alias("orders"),
            )
            for bit, before, ways, orders in _places()
        )
    )
    fails_it = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0

    def total(test, column: str = "n"):
        return F.sum(F.when(test, F.col(column)).otherwise(0)).cast("bigint")

    by_place = (
        counted.select("*", F.inline(places))
        .groupBy("part", "bit", "before")
        .agg(
            F.first("step").alias("step"),
            F.first("ways").alias("ways"),
            F.first("orders").alias("orders"),
            total(~fails_it & ~gone).alias("kept"),
            total(fails_it & ~gone).alias("removed"),
            total(fails_it & gone).alias("redundant"),
            total(F.col("mask") == F.col("bit")).alias("unique_fails"),
            total(fails_it & ~gone, "n_good").alias("good_lost"),
            total(fails_it & ~gone, "n_toxic").alias("toxic_lost"),
        )
    )
    one_filter = Window.partitionBy("part", "bit")  # sixteen rows
    return by_place.withColumn("shapley", F.sum(F.col("removed") * F.col("ways")).over(one_filter)).select(
        "part",
        F.explode("orders").alias("filter_order"),
        "step",
        "kept",
        "removed",
        "redundant",
        "unique_fails",
        "good_lost",
        "toxic_lost",
        "shapley",
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What every filter removes at every step of every order, by part."""
    return orders_of(counts(judge(docs), labels))
