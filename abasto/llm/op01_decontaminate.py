"""Benchmark decontamination by greedy string tiling.

Words are lower-cased runs between blanks and marks. Seeds are Karp-Rabin hashes of ``least`` words; a document and a
benchmark item that share a seed are a candidate pair. Runs of shared seeds on one diagonal are the maximal matches of
the pair; the longest one whose words are free on both sides becomes a tile, what others have left is looked at again,
until no match of ``least`` words is free. A document is contaminated by an item when tiles cover at least ``cover`` of
the item's words, in any order. An item shorter than ``least`` words has to occur as a whole.

Where seeds repeat so often that a pair shares more than ``MOST_PLACES`` places (long loops of few words), matches are found
by their length instead: Karp-Rabin hashes of all free runs of one length on both sides, from the longest length down.

While the benchmark has at most ``broadcast_words`` words (counted first), its hashes are broadcast and every document
is read once, without a shuffle. Beyond that, seeds are joined by a shuffle, pairs that share too few seeds to be covered
go, and texts follow for those left. Both ways give one row per document row and item row (tested).

Null or empty text: no words, neither found nor searched. Null ``doc_id`` or ``item_id``: reported with null. Repeated
rows, of documents or items: each is reported for itself. Empty tables: no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abasto.llm.common import as_long, gram_hashes, place_in_text, prepare, slices, word_hashes

LEAST, COVER = 5, 0.6
MOST_PLACES = 1 << 20  # places that a document and an item share, listed at once
BROADCAST_WORDS = 1 << 20  # 8 bytes a word, and as much for the seeds: 16 MB at most

_MARKS = bytes(set(range(128)) - set(b"0123456789abcdefghijklmnopqrstuvwxyz"))
_PLAIN = bytes.maketrans(_MARKS, b" " * len(_MARKS))

SCHEMA = (
    "doc_id bigint, item_id bigint, item_words bigint, covered bigint, coverage double, longest bigint, "
    "tiles array<array<bigint>>"
)


def plain(texts: list[bytes]) -> list[bytes]:
    return [text.lower().translate(_PLAIN) for text in texts]


def tile(item: np.ndarray, at_item: np.ndarray, at_doc: np.ndarray, least: int) -> list[list[int]]:
    """Tiles (place in the item, place in the document, words) from the places where seeds are shared."""
    order = np.lexsort((at_item, at_doc - at_item))
    i, j = at_item[order], at_doc[order]
    new = np.concatenate([[True], (np.diff(i) != 1) | (np.diff(j) != 1)])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.concatenate([starts, [len(i)]])) + least - 1
    heap = [(-size, a, b) for size, a, b in zip(sizes.tolist(), i[starts].tolist(), j[starts].tolist(), strict=True)]
    heapq.heapify(heap)
    low = int(j.min())
    item_used = np.zeros(len(item), dtype=bool)
    doc_used = np.zeros(int(j.max()) - low + least + 1, dtype=bool)
    tiles = []
    while heap:
        size, a, b = heapq.heappop(heap)
        size = -size
        b -= low
        used = item_used[a : a + size] | doc_used[b : b + size]
        if not used.any():
            item_used[a : a + size] = doc_used[b : b + size] = True
            tiles.append([a, b + low, size])
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[1], used.astype(np.int8), [1]])))
        for start, end in edges.reshape(-1, 2).tolist():
            if end - start >= least:
                heapq.heappush(heap, (start - end, a + start, b + low + start))
    return tiles


def tile_by_length(item: np.ndarray, doc: np.ndarray, least: int) -> list[list[int]]:
    """The tiles of greedy string tiling, in memory that grows with the words and not with the places they share."""
    sides = [item, doc]
    used = [np.zeros(len(side), dtype=bool) for side in sides]

    def free_runs(size: int) -> list[tuple[np.ndarray, np.ndarray]]:
        found = []
        for side, taken in zip(sides, used, strict=True):
            if len(side) < size:
                return []
            sums = np.concatenate([[0], np.cumsum(taken)])
            starts = np.flatnonzero(sums[size:] == sums[:-size])
            found.append((starts, gram_hashes(side, size)[starts]))
        return found

    def common(size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
        runs = free_runs(size)
        return runs if runs and len(np.intersect1d(runs[0][1], runs[1][1])) else None

    tiles, most = [], min(len(item), len(doc))
    while most >= least and common(least):
        low, high = least, most  # the longest common free run is at least ``low``
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if common(middle) else (low, middle - 1)
        most = low
        (starts, hashes), (places, names) = common(most)
        order = np.argsort(hashes, kind="stable")
        hashes, starts = hashes[order], starts[order]
        first = np.searchsorted(hashes, names)
        last = np.searchsorted(hashes, names, side="right")
        at_of = {}  # the next place of each run in the item
        for b, begin, end in zip(places.tolist(), first.tolist(), last.tolist(), strict=True):
            if begin == end or used[1][b : b + most].any():
                continue
            at = at_of.get(begin, begin)
            while at < end and used[0][starts[at] : starts[at] + most].any():
                at += 1
            at_of[begin] = at
            if at < end:
                a = int(starts[at])
                used[0][a : a + most] = used[1][b : b + most] = True
                tiles.append([a, b, most])
        most -= 1
    return tiles


class Benchmark:
    """Word hashes of items, and their seeds in hash order with a small filter in front."""

    def __init__(self, items: list[tuple[int | None, bytes]], least: int):
        self.least = least
        words, bounds = word_hashes(plain([text for _, text in items]))
        sizes = np.diff(bounds)
        self.ids = [item for (item, _), size in zip(items, sizes, strict=True) if size]
        self.words = [words[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True) if b > a]
        seeds, owner, place = [], [], []
        for number, own in enumerate(self.words):
            size = min(least, len(own))
            hashes = gram_hashes(own, size) + np.uint64(size)  # short items have seeds of their own length
            seeds.append(hashes)
            owner.append(np.full(len(hashes), number))
            place.append(np.arange(len(hashes)))
        none = np.zeros(0, dtype=np.int64)
        seeds = np.concatenate([none.astype(np.uint64), *seeds])
        order = np.argsort(seeds, kind="stable")
        self.seeds = seeds[order]
        self.owner = np.concatenate([none, *owner])[order]
        self.place = np.concatenate([none, *place])[order]
        self.sizes = sorted({min(least, len(own)) for own in self.words})
        self.filter = np.zeros(1 << 22, dtype=bool)
        self.filter[(self.seeds >> np.uint64(42)).astype(np.int64)] = True

    def shared(self, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of words where a seed begins inside a text, and the seed's first entry."""
        places, entries = [], []
        _, left = place_in_text(bounds)
        for size in self.sizes:
            hashes = gram_hashes(words, size) + np.uint64(size)
            maybe = np.flatnonzero(self.filter[(hashes >> np.uint64(42)).astype(np.int64)] & (left[: len(hashes)] >= size))
            at = np.searchsorted(self.seeds, hashes[maybe])
            right = self.seeds[np.minimum(at, len(self.seeds) - 1)] == hashes[maybe]
            places.append(maybe[right])
            entries.append(at[right])
        none = np.zeros(0, dtype=np.int64)
        return np.concatenate([none, *places]), np.concatenate([none, *entries])

    def leaks(self, words: np.ndarray, places: np.ndarray, entries: np.ndarray, cover: float) -> list[tuple]:
        """(item, its words, covered, longest tile, tiles) of the items that one document covers."""
        places = places[np.argsort(entries, kind="stable")]
        seeds, times = np.unique(entries, return_counts=True)
        first = np.cumsum(times) - times  # where a seed's places in the document begin
        counts = np.searchsorted(self.seeds, self.seeds[seeds], side="right") - seeds
        spread = np.repeat(seeds - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        seed, owner, place = np.repeat(np.arange(len(seeds)), counts), self.owner[spread], self.place[spread]
        order = np.argsort(owner, kind="stable")
        cuts = np.flatnonzero(np.diff(owner[order])) + 1
        found = []
        for chosen in np.split(order, cuts):
            number = int(owner[chosen[0]])
            item = self.words[number]
            least = min(self.least, len(item))
            touched = np.unique(place[chosen])
            reach = np.minimum(np.diff(touched, append=touched[-1] + least), least).sum()
            if reach < cover * len(item):
                continue
            own = times[seed[chosen]]
            if own.sum() > MOST_PLACES:
                tiles = tile_by_length(item, words, least)
            else:
                ends = np.cumsum(own)
                at_doc = places[np.repeat(first[seed[chosen]] - ends + own, own) + np.arange(ends[-1])]
                tiles = tile(item, np.repeat(place[chosen], own), at_doc, least)
            covered = sum(size for _, _, size in tiles)
            if covered >= cover * len(item):
                found.append((self.ids[number], len(item), covered, max(size for _, _, size in tiles), tiles))
        return found


def _report(rows: list[tuple]) -> pa.RecordBatch:
    docs, items, sizes, covered, longest, tiles = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(docs, pa.int64()),
            pa.array(items, pa.int64()),
            pa.array(sizes, pa.int64()),
            pa.array(covered, pa.int64()),
            pa.array([c / s for c, s in zip(covered, sizes, strict=True)], pa.float64()),
            pa.array(longest, pa.int64()),
            pa.array(tiles, pa.list_(pa.list_(pa.int64()))),
        ],
        ["doc_id", "item_id", "item_words", "covered", "coverage", "longest", "tiles"],
    )


def search_all(items, least: int, cover: float):
    """(doc_id, text) to report rows; ``items`` is a broadcast list of (item_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        benchmark = Benchmark(items.value, least)
        if not benchmark.ids:
            return
        for part, texts in slices(batches):
            words, bounds = word_hashes(plain(texts))
            places, entries = benchmark.shared(words, bounds)
            owner = np.searchsorted(bounds, places, side="right") - 1
            rows = []
            for row in np.unique(owner).tolist():
                own = owner == row
                doc = part.column(0)[row].as_py()
                start = bounds[row]
                for leak in benchmark.leaks(words[start : bounds[row + 1]], places[own] - start, entries[own], cover):
                    rows.append((doc, *leak))
            if rows:
                yield _report(rows)

    return run


def seed_rows(least: int, short: list[int]):
    """(name, text) to (seed, name, places, words): each seed once a text, in how many places, of how many words; seeds of
    the given shorter lengths too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            words, bounds = word_hashes(plain(texts))
            none = np.zeros(0, dtype=np.int64)
            seeds, owners, places = [none.astype(np.uint64)], [none], [none]
            for row, (start, end) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                for size in {least, *short}:
                    if end - start >= size:
                        found, times = np.unique(gram_hashes(words[start:end], size) + np.uint64(size), return_counts=True)
                        seeds.append(found)
                        places.append(times)
                        owners.append(np.full(len(found), row))
            owner = np.concatenate(owners)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(as_long(np.concatenate(seeds))),
                    part.column(0).take(pa.array(owner)),
                    pa.array(np.concatenate(places)),
                    pa.array(np.diff(bounds)[owner]),
                ],
                ["seed", "name", "places", "words"],
            )

    return run


def length_rows(least: int):
    """Texts to the numbers of words below ``least`` that occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches):
            sizes = np.unique(np.diff(word_hashes(plain(texts))[1]))
            sizes = sizes[(sizes > 0) & (sizes < least)].astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(sizes)], ["length"])

    return run


def pair_rows(least: int, cover: float):
    """(doc_id, text, item_id, item text) to report rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            for row, text in enumerate(texts):
                benchmark = Benchmark([(part.column(2)[row].as_py(), part.column(3)[row].as_py().encode())], least)
                words, bounds = word_hashes(plain([text]))
                places, entries = benchmark.shared(words, bounds)
                if len(places):
                    doc = part.column(0)[row].as_py()
                    rows = [(doc, *leak) for leak in benchmark.leaks(words, places, entries, cover)]
                    if rows:
                        yield _report(rows)

    return run


def _texts(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.col(name).cast("bigint").alias("id"), F.col("text").cast("string").alias("text"))


def report(
    docs: DataFrame,
    benchmark: DataFrame,
    least: int = LEAST,
    cover: float = COVER,
    broadcast_words: int = BROADCAST_WORDS,
) -> DataFrame:
    """One row per contaminated document and item that it covers."""
    spark = prepare(docs.sparkSession)
    texts, items = _texts(docs, "doc_id"), _texts(benchmark, "item_id").filter("text IS NOT NULL")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    if size <= broadcast_words:  # no more words than characters
        shared = spark.sparkContext.broadcast([(row.id, row.text.encode()) for row in items.collect()])
        return texts.mapInArrow(search_all(shared, least, cover), SCHEMA)
    # A row's name: 128 bits of its id and its text. Rows with one name are equal, and each comes back in the joins.
    name = F.struct(F.xxhash64("id", "text").alias("high"), F.xxhash64(F.lit(1), "text", "id").alias("low")).alias("name")
    texts, items = (rows.filter("text IS NOT NULL").select(name, "id", "text") for rows in (texts, items))
    seeds = "seed bigint, name struct<high: bigint, low: bigint>, places bigint, words bigint"
    lengths = items.select("text", F.lit(0)).mapInArrow(length_rows(least), "length int").distinct().collect()
    short = [row.length for row in lengths]  # at most ``least`` values
    ours = texts.select("name", "text").mapInArrow(seed_rows(least, short), seeds).select("seed", F.col("name").alias("doc"))
    theirs = items.dropDuplicates(["name"]).select("name", "text").mapInArrow(seed_rows(least, short), seeds)
    shared = ours.distinct().join(theirs.withColumnRenamed("name", "item"), "seed").groupBy("doc", "item")
    # A shared seed covers at most so many words as it has, in each of its places in the item.
    enough = F.sum("places") * least >= F.lit(cover) * F.max("words")
    pairs = shared.agg(enough.alias("enough")).filter("enough").select("doc", "item")
    pairs = pairs.join(texts.toDF("doc", "doc_id", "text"), "doc")
    pairs = pairs.join(items.toDF("item", "item_id", "item_text"), "item")
    return pairs.select("doc_id", "text", "item_id", "item_text").mapInArrow(pair_rows(least, cover), SCHEMA)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no item contaminates, with all their columns. Rows without an id are kept."""
    leaked = report(docs, benchmark).select(F.col("doc_id").alias("leaked")).filter("leaked IS NOT NULL").distinct()
    return docs.join(leaked, docs["doc_id"] == leaked["leaked"], "left_anti")
