"""Cross-tokenizer alignment: which tokens of one vocabulary lie over which of another, and how usual that is.

Every text is encoded twice: with a blank before it by a byte-level vocabulary (A), and by a sentencepiece model, which puts
the blank itself (B). Both cut the same bytes. Batch by batch, ``pandas.merge_asof`` keyed by document finds, for every
token's start, the token of the other side that covers it; the union of both directions is all overlaps. Where tokens of
both sides end at one place, a group ends.

How many documents hold an id pair linked is a count over the whole corpus. It comes together without shuffling links:
a slice of texts lists its different pairs once, with the documents that hold each; these lists are summed by pair, and
what a slice needs of the sums (the count of its own pairs, and whether it is the highest of the A id) goes back to
the slice, whose links were written as places in its list.

No text, an empty one, and one whose A or B tokens do not give back the blank and the text (characters that a
vocabulary changes) have no tokens: zeros. Null or repeated ``doc_id``: every row is a document of its own. Empty table: no
rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abasto.llm.common import prepare, slices, stage
from abasto.llm.tokens import encoder, piece_encoder

SLICE = 4 << 20  # bytes of text aligned at once; a longer text is a slice of its own
SHIFT = 32  # an id pair is one number: the A id above the B id
WORDS = 5_000  # different words encoded at once

# No word at all, one that begins with a blank or a control of any kind, and one that holds the sign for a blank.
UNSAFE = (
    r"^(?:$|[\x{0}-\x{20}\x{7f}-\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{206f}\x{3000}\x{feff}])"
    r"|\x{2581}"
)

# One row per slice. ``pairs`` are its different id pairs and ``holders`` the documents that hold each; ``link_pairs`` are
# places in ``pairs``, ``link_counts`` links of that pair in the document, ``link_ends`` where each document's ones end.
SLICES = (
    "slice bigint, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
    "n_links array<bigint>, groups_sha256 array<string>, pairs array<bigint>, holders array<bigint>, "
    "link_ends array<bigint>, link_pairs array<int>, link_counts array<int>"
)
RESULT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
)


class Coder:
    """One side's encoder: the bytes of its entries, and how an id is written before ``,`` and before what ends its list."""

    def __init__(self, path: str | None, pieces: bool):
        self.encoder, self.pieces = piece_encoder(path) if pieces else encoder(path), pieces
        self.entries = self.encoder.entries()
        self.lengths = np.fromiter(map(len, self.entries), dtype=np.int64, count=len(self.entries))
        self.opens = np.array([entry.startswith(b" ") for entry in self.entries])
        self.written = [f"{number},".encode() for number in range(len(self.entries))]
        self.written += [f"{number}{';' if pieces else '|'}".encode() for number in range(len(self.entries))]
        # Whether a word behind a single blank has the same ids wherever it stands.
        self.by_word = self.encoder.cuttable if pieces else self.encoder.fast is not None

    def whole(self, text: str) -> np.ndarray:
        """Ids of a blank and a text; none where they do not give both back."""
        ids = np.array(self.encoder.encode([text])[0] if self.pieces else self.encoder.encode_plain(" " + text), dtype=np.int64)
        return ids if b"".join(map(self.entries.__getitem__, ids.tolist())) == b" " + text.encode() else ids[:0]

    def words(self, words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]] | None:
        """Ids of all words, encoded together as one text, and how many each has; none where a word cannot be told from the next."""
        if not self.by_word:
            return None
        found, sizes = [], []
        for start in range(0, len(words), WORDS):
            some = words[start : start + WORDS]
            ids = self.whole(" ".join(some))
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) != len(some):
                return None
            found.append(ids)
            sizes.append(np.diff(starts, append=len(ids)))
        return found, sizes


@lru_cache(maxsize=4)
def _coder(path: str | None, pieces: bool) -> Coder:
    return Coder(path, pieces)


def encode_slice(texts: list[str], coders: list[Coder]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every side, the ids of all texts one after the other, and how many each text has.

    Texts are cut at single blanks and every different word is encoded once. A text with a word that may depend on what
    stands before its blank is encoded as a whole.
    """
    parts = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    coded, bounds = parts.flatten().dictionary_encode(), parts.offsets.to_numpy()
    word_of = coded.indices.to_numpy()
    unsafe = pc.match_substring_regex(coded.dictionary, UNSAFE).to_numpy(zero_copy_only=False)
    words = coded.dictionary.filter(pa.array(~unsafe)).to_pylist()
    by_word = [coder.words(words) for coder in coders]
    together = None not in by_word
    alone = np.add.reduceat(unsafe[word_of].astype(np.int64), bounds[:-1]) > 0 if together else np.ones(len(texts), bool)
    ids = [[coder.whole(texts[place]) if texts[place] else np.zeros(0, np.int64) for place in np.flatnonzero(alone)] for coder in coders]
    both = [len(one) > 0 and len(other) > 0 for one, other in zip(*ids, strict=True)]
    # What each word becomes: its own entry, or the empty first one; a text on its own stands in its first word's place.
    entry_of = np.where(unsafe, 0, np.cumsum(~unsafe))[word_of] if together else np.zeros(len(word_of), np.int64)
    entry_of[np.repeat(alone, np.diff(bounds))] = 0
    entry_of[bounds[:-1][alone]] = 1 + (len(words) if together else 0) + np.arange(alone.sum())
    sides = []
    for known, wholes in zip(by_word, ids, strict=True):
        wholes = [found if ok else found[:0] for found, ok in zip(wholes, both, strict=True)]
        pools, word_sizes = known if together else ([], [])
        pool = np.concatenate([np.zeros(0, np.int64), *pools, *wholes])
        sizes = np.concatenate([[0], *word_sizes, np.array(list(map(len, wholes)), dtype=np.int64)]).astype(np.int64)
        firsts = np.cumsum(sizes) - sizes
        counts = sizes[entry_of]
        ends = np.cumsum(counts)
        places = np.repeat(firsts[entry_of] - (ends - counts), counts) + np.arange(len(pool) and ends[-1])
        sides.append((pool[places], np.diff(np.concatenate([[0], ends])[bounds])))
    return sides


class Side:
    """Tokens of a slice on one side: ids, documents, and byte places counted through the slice."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, lengths: np.ndarray):
        self.ids, self.counts = ids, counts
        self.docs = np.repeat(np.arange(len(counts)), counts)
        self.ends = np.cumsum(lengths[ids])
        self.starts = self.ends - lengths[ids]

    def frame(self, name: str) -> pd.DataFrame:
        return pd.DataFrame({"doc": self.docs, "start": self.starts, name: np.arange(len(self.ids))})


def overlaps(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of an A and a B token that share a byte, as places in their sides."""
    left, right = a.frame("a"), b.frame("b")
    over_a = pd.merge_asof(left, right, on="start", by="doc")  # the B token over each A token's start
    over_b = pd.merge_asof(right, left, on="start", by="doc")  # and the other way round
    # Where both start at one place, both directions find the same pair.
    over_b = over_b[a.starts[over_b["a"].to_numpy()] < over_b["start"].to_numpy()]
    both = pd.concat([over_a[["a", "b"]], over_b[["a", "b"]]])
    return both["a"].to_numpy(), both["b"].to_numpy()


def group_texts(a: Side, b: Side, a_written: list[bytes], b_written: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Groups of every document: how many, and as ``a1,a2|b1;a3|b2,b3``."""
    a_last, b_last = np.isin(a.ends, b.ends, assume_unique=True), np.isin(b.ends, a.ends, assume_unique=True)
    # A group's A tokens come first, then its B tokens: each stands behind the other side's tokens of earlier groups.
    a_ends, b_ends = np.flatnonzero(a_last) + 1, np.flatnonzero(b_last) + 1
    b_before = np.concatenate([[0], b_ends])[np.cumsum(a_last) - a_last]
    a_before = np.concatenate([a_ends, [0]])[np.cumsum(b_last) - b_last]
    written = [*a_written, *b_written]
    code = np.empty(len(a.ids) + len(b.ids), dtype=np.int64)
    code[np.arange(len(a.ids)) + b_before] = a.ids + np.where(a_last, len(a_written) // 2, 0)
    code[np.arange(len(b.ids)) + a_before] = b.ids + np.where(b_last, len(b_written) // 2, 0) + len(a_written)
    words, ends = list(map(written.__getitem__, code.tolist())), np.cumsum(a.counts + b.counts).tolist()
    texts, start = [], 0
    for end in ends:
        texts.append(b"".join(words[start:end])[:-1])
        start = end
    return np.bincount(a.docs[a_last], minlength=len(a.counts)), texts


def align_slice(texts: list[bytes], a_path: str | None, b_path: str | None) -> dict[str, object]:
    """The columns of a slice."""
    coders = [_coder(a_path, False), _coder(b_path, True)]
    encoded = encode_slice([text.decode("utf-8", "ignore") for text in texts], coders)
    a, b = (Side(ids, counts, coder.lengths) for (ids, counts), coder in zip(encoded, coders, strict=True))
    a_over, b_over = overlaps(a, b)
    n_groups, groups = group_texts(a, b, coders[0].written, coders[1].written)
    docs = a.docs[a_over]
    linked = pd.DataFrame({"doc": docs, "pair": (a.ids[a_over] << SHIFT) | b.ids[b_over]})
    links = linked.groupby(["doc", "pair"], sort=True).size()
    owner = links.index.get_level_values("doc").to_numpy()
    pairs, place = np.unique(links.index.get_level_values("pair").to_numpy(), return_inverse=True)
    return {
        "n_a": a.counts,
        "n_b": b.counts,
        "n_groups": n_groups,
        "n_links": np.bincount(docs, minlength=len(texts)),
        "groups_sha256": [hashlib.sha256(text).hexdigest() if text else "" for text in groups],
        "pairs": pairs.astype(np.int64),
        "holders": np.bincount(place, minlength=len(pairs)),
        "link_ends": np.searchsorted(owner, np.arange(len(texts)), side="right"),
        "link_pairs": place.astype(np.int32),
        "link_counts": links.to_numpy().astype(np.int32),
    }


def align_partition(a_path: str | None = None, b_path: str | None = None, size: int = SLICE):
    """A function for ``mapInArrow``: (doc_id, text) to slice rows."""
    wide = {"link_pairs", "link_counts"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        for batch, texts in slices(batches, size=size):
            found = align_slice(texts, a_path, b_path)
            columns = {"slice": pa.array([number], pa.int64()), "doc_ids": pa.array([batch.column(0).to_pylist()], pa.list_(pa.int64()))}
            for name, values in found.items():
                kind = pa.string() if name == "groups_sha256" else pa.int32() if name in wide else pa.int64()
                columns[name] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))
            yield pa.RecordBatch.from_pydict(columns)
            number += 1

    return run


def finish_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slice rows with ``known``, twice the count of each of their pairs plus one where it is the highest, to documents."""
    for batch in batches:
        for row in range(batch.num_rows):
            cell = {name: batch.column(place)[row].values for place, name in enumerate(batch.schema.names) if name != "slice"}
            known = np.zeros(0, np.int64) if cell["known"] is None else cell["known"].to_numpy()
            value, times = known[cell["link_pairs"].to_numpy()], cell["link_counts"].to_numpy().astype(np.int64)
            ends = np.concatenate([[0], cell["link_ends"].to_numpy()])

            def summed(values: np.ndarray, ends: np.ndarray = ends) -> np.ndarray:
                return np.diff(np.concatenate([[0], np.cumsum(values)])[ends])

            columns = [cell[name] for name in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")]
            columns += [pa.array(summed(times * (value & 1))), pa.array(summed(times * (value >> 1))), cell["groups_sha256"]]
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
            )


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): the documents that hold an id pair linked, and whether no pair of its A id has more."""
    held = aligned.select(F.inline(F.arrays_zip("pairs", "holders"))).groupBy(F.col("pairs").alias("pair"))
    counted = held.agg(F.sum("holders").alias("n"))
    a_id = Window.partitionBy(F.shiftright("pair", SHIFT))  # at most as many rows as B has ids
    return counted.withColumn("best", F.col("n") == F.max("n").over(a_id))


def slices_of(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, size: int = SLICE) -> DataFrame:
    """The aligned slices, written once: ids, places and links are not worked out again for a lost task."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(texts.mapInArrow(align_partition(a_path, b_path, size), SLICES))


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, size: int = SLICE) -> DataFrame:
    """One row per document: tokens, groups, links, and how usual the links are in the corpus."""
    aligned = slices_of(docs, a_path, b_path, size)
    wanted = aligned.select("slice", F.posexplode("pairs").alias("place", "pair"))
    value = F.col("n") * 2 + F.col("best").cast("bigint")
    answers = wanted.join(pair_counts(aligned), "pair").select("slice", F.struct("place", value.alias("value")).alias("answer"))
    known = answers.groupBy("slice").agg(F.sort_array(F.collect_list("answer"))["value"].alias("known"))
    links = ["doc_ids", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "link_ends", "link_pairs", "link_counts"]
    rows = aligned.select("slice", *links).join(known, "slice", "left")
    return rows.mapInArrow(finish_partition, RESULT)
