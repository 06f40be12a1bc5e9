"""Removal of repeated passages by seed and extend.

Seeds: winnowing picks, of the ``gram``-word hashes inside every window of ``span`` words, the smallest. Two equal
windows pick the same seed at the same place, so equal windows always meet. Documents are joined on seeds that occur
more than once. Every such seed is extended both ways to the windows of ``span`` words that picked it; equal windows are
joined on the hash of all their words (with the seed's), the earliest one is kept, and overlapping repeats flow
together to maximal ones. Only ids, places and hashes are shuffled for this, and whole texts once.

A window is removed where its words also start earlier: in a smaller ``doc_id``, or before it in its document.
Windows are judged on the input. Hashes have 64 bits and windows are compared under the seed's hash too.

Null text: no words. Null ``doc_id``: kept whole and compared with nothing. Rows that repeat a ``doc_id`` with the same text
count as one document; with different texts they are documents in the order of the texts' hashes. Each row is returned.
Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abasto.llm.common import as_long, gram_hashes, place_in_text, prepare, slices, stage, word_hashes

SPAN, GRAM = 20, 6


def _seeds(texts: list[bytes], span: int, gram: int):
    """Word hashes, where texts begin, gram hashes, and the first words and seeds of all windows inside a text."""
    words, bounds = word_hashes(texts)
    grams = gram_hashes(words, gram)
    if len(words) < span:
        none = np.zeros(0, dtype=np.int64)
        return words, bounds, grams, none, none
    _, left = place_in_text(bounds)
    picks = np.lib.stride_tricks.sliding_window_view(grams, span - gram + 1).argmin(axis=1)
    windows = np.flatnonzero(left[: len(picks)] >= span)
    return words, bounds, grams, windows, windows + picks[windows]


def seed_rows(span: int, gram: int):
    """(doc_id, text) to one row per seed and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            _, bounds, grams, _, seeds = _seeds(texts, span, gram)
            seeds = np.unique(seeds)
            owner = np.searchsorted(bounds, seeds, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(as_long(grams[seeds])),
                    part.column(0).take(pa.array(owner)),
                    pa.array((seeds - bounds[owner]).astype(np.int32)),
                ],
                ["seed", "doc_id", "place"],
            )

    return run


def _flagged(places: list, bounds: np.ndarray, windows: np.ndarray, seeds: np.ndarray, count: int):
    """Of all windows, those whose seed is among the places given per text."""
    wanted = np.zeros(count + 1, dtype=bool)
    for row, found in enumerate(places):
        if found is not None:
            at = bounds[row] + np.asarray(found, dtype=np.int64)
            wanted[at[at < bounds[row + 1]]] = True
    keep = wanted[seeds]
    return windows[keep], seeds[keep]


def window_rows(span: int, gram: int):
    """(doc_id, text, places of repeated seeds, nth) to one row per window that picked such a seed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            places = part.column(2).to_pylist()
            if not any(places):
                continue
            words, bounds, grams, windows, seeds = _seeds(texts, span, gram)
            windows, seeds = _flagged(places, bounds, windows, seeds, len(words))
            owner = np.searchsorted(bounds, windows, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(as_long(gram_hashes(words, span)[windows])) if len(windows) else pa.array([], pa.int64()),
                    pa.array((grams[seeds] >> np.uint64(40)).astype(np.int32)),
                    part.column(0).take(pa.array(owner)),
                    part.column(3).take(pa.array(owner)),
                    pa.array((windows - bounds[owner]).astype(np.int32)),
                ],
                ["window", "seed", "doc_id", "nth", "place"],
            )

    return run


def result_rows(span: int, gram: int):
    """(doc_id, text, places of repeated seeds, nth, places of first windows) to the kept words and the removed spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            places, firsts = part.column(2).to_pylist(), part.column(4).to_pylist()
            split = [text.split() for text in texts]
            removed, spans, kept = [0] * len(texts), [[] for _ in texts], [b" ".join(words) for words in split]
            if any(places):
                words, bounds, _, windows, seeds = _seeds(texts, span, gram)
                windows, _ = _flagged(places, bounds, windows, seeds, len(words))
                first = np.zeros(len(words) + 1, dtype=bool)
                for row, found in enumerate(firsts):
                    if found is not None:
                        at = bounds[row] + np.asarray(found, dtype=np.int64)
                        first[at[at < bounds[row + 1]]] = True
                windows = windows[~first[windows]]
                depth = np.zeros(len(words) + 1, dtype=np.int64)
                depth[windows] += 1
                np.add.at(depth, windows + span, -1)
                gone = np.cumsum(depth)[:-1] > 0
                for row in np.unique(np.searchsorted(bounds, windows, side="right") - 1):
                    own = gone[bounds[row] : bounds[row + 1]]
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]]))).reshape(-1, 2)
                    removed[row], spans[row] = int(own.sum()), edges.tolist()
                    kept[row] = b" ".join(word for word, drop in zip(split[row], own.tolist(), strict=True) if not drop)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(words) for words in split], pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "spans", "kept"],
            )

    return run


def dedup(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, spans (word places from, to), kept (the words left, joined by one blank)."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    seeds = texts.filter("doc_id IS NOT NULL").mapInArrow(seed_rows(span, gram), "seed bigint, doc_id bigint, place int")
    # Grouped with its hash, so that the join exchanges both sides by the seed alone and can split a frequent one.
    repeated = seeds.groupBy("seed", F.hash("seed").alias("half")).agg(F.count("*").alias("n")).filter("n > 1")
    repeated = repeated.select("seed")
    hits = seeds.join(repeated, "seed", "left_semi").groupBy("doc_id").agg(F.collect_set("place").alias("places"))
    several = texts.select("doc_id").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id", F.lit(True).alias("several"))
    hits = stage(hits.join(several, "doc_id", "left"))  # few rows from the largest shuffle: written once, read twice
    # Which row of its id a row is: the hash of its text, where there are several rows; nothing to send otherwise.
    nth = F.when(F.col("several"), F.xxhash64("text")).otherwise(0).alias("nth")
    found = texts.join(hits.hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", "places", nth)
    windows = found.mapInArrow(window_rows(span, gram), "window bigint, seed int, doc_id bigint, nth bigint, place int")
    earliest = windows.groupBy("window", "seed").agg(F.min(F.struct("doc_id", "nth", "place")).alias("at"))
    # Both joins are by the id alone: the texts are exchanged once.
    firsts = earliest.groupBy(F.col("at.doc_id").alias("doc_id")).agg(F.collect_list(F.struct("at.nth", "at.place")).alias("firsts"))
    schema = "doc_id bigint, n_words bigint, n_removed bigint, spans array<array<bigint>>, kept string"
    own = F.transform(F.filter("firsts", lambda first: first["nth"] == F.col("nth")), lambda first: first["place"])
    rows = found.join(firsts.hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", "places", "nth", own.alias("firsts"))
    return rows.mapInArrow(result_rows(span, gram), schema)
