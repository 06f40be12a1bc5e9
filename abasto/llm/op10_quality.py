"""Quality classifier: a factorisation machine over hashed words and facts on a text's structure.

Features of a text: its different words in lower case, hashed to ``WORDS`` places and weighted to unit length, and for
each of a list of facts (sizes, shares of kinds of bytes, repeated words and lines) the range it falls in. The score is

    sigmoid(bias + sum w_j x_j + 1/2 sum_f ((sum v_jf x_j)**2 - sum (v_jf x_j)**2)),

all pairwise products of features in time linear in their number. It is fitted in one task on a bounded sample of
labelled rows that are not held out; the model has a fixed size and is broadcast. Labels, ``lang``, ``source`` and
``doc_id`` are no features.

Null text: empty; it has facts but no words, so it gets a score too. Null ``doc_id``: scored, held_out is null.
Repeated rows: each is scored. Labels: null ones are left out, one row a ``doc_id`` (the lower label). No usable label: every
score is 0.5. Empty table: no rows. Other columns are not read by ``score``; ``accept`` keeps them.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abasto.llm.common import prepare, slices, word_hashes

SAMPLE = 6_000  # labelled rows a model is fitted on, at most
WORDS, RANGES, RANK = 1 << 16, 16, 8
EPOCHS, STEPS, BATCH, RATE, DECAY, SEED = 6, 300, 128, 0.05, 1e-5, 7  # passes, and steps at least

_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_LETTERS = bytes(c for c in range(256) if chr(c).isalpha() and c < 128)
_FACTS = 14
SIZE = WORDS + _FACTS * RANGES


def _share(part: float, whole: float) -> int:
    return min(RANGES - 1, int(RANGES * (part / whole) ** 0.5)) if whole else 0


def facts(text: bytes, words: int, different: int) -> list[int]:
    """The range of each fact."""
    size, lines = len(text), text.split(b"\n")
    without = lambda kind: size - len(text.translate(None, kind))
    upper, digits, punctuation, letters = without(_UPPER), without(_DIGITS), without(_PUNCTUATION), without(_LETTERS)
    marks = [text.count(mark) for mark in (b"|", b"!", b"#", b"*", b".")]
    return [
        min(RANGES - 1, size.bit_length()),
        min(RANGES - 1, words.bit_length()),
        min(RANGES - 1, int(size / words)) if words else 0,
        _share(upper, size),
        _share(digits, size),
        _share(punctuation, size),
        _share(letters, size),
        _share(different, words),
        _share(len(lines), words),
        _share(len(set(lines)), len(lines)),
        *(_share(count, words) for count in marks[:3]),
        _share(marks[3] + marks[4], words),
    ]


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and values of all features, text after text, and where each text's begin (one entry more)."""
    lowered = [text.lower() for text in texts]
    hashes, bounds = word_hashes(lowered)
    counts = np.diff(bounds)
    owner = np.repeat(np.arange(len(texts)), counts)
    once = np.unique((owner << 32) | (hashes & np.uint64(WORDS - 1)).astype(np.int64))
    owner, place = once >> 32, once & 0xFFFFFFFF
    different = np.bincount(owner, minlength=len(texts))
    known = np.array([facts(t, int(w), int(d)) for t, w, d in zip(texts, counts, different, strict=True)]).reshape(-1, _FACTS)
    known = known + WORDS + np.arange(_FACTS) * RANGES
    places = np.concatenate([place, known.ravel()])
    values = np.concatenate([1 / np.sqrt(different[owner]), np.full(known.size, 1 / np.sqrt(_FACTS))])
    order = np.argsort(np.concatenate([owner, np.repeat(np.arange(len(texts)), _FACTS)]), kind="stable")
    return places[order], values[order], np.concatenate([[0], np.cumsum(different + _FACTS)])


class Machine:
    """Bias, weights and factors (one row a feature: the weight, then the factors)."""

    def __init__(self, bias: float, table: np.ndarray):
        self.bias, self.table = bias, table

    def raw(self, places: np.ndarray, values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The scores before the sigmoid, and the sums of factors that the gradient needs."""
        scaled = self.table[places] * values[:, None]
        sums = np.add.reduceat(scaled, bounds[:-1], axis=0)
        squares = np.add.reduceat(np.square(scaled[:, 1:]).sum(axis=1), bounds[:-1])
        return self.bias + sums[:, 0] + (np.square(sums[:, 1:]).sum(axis=1) - squares) / 2, sums[:, 1:]

    def score(self, texts: list[bytes]) -> np.ndarray:
        return sigmoid(self.raw(*features(texts))[0]) if texts else np.zeros(0)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, bias=self.bias, table=self.table)
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes | None) -> Machine:
        if data is None:
            return Machine(0.0, np.zeros((SIZE, RANK + 1)))
        stored = np.load(io.BytesIO(data))
        return Machine(float(stored["bias"]), stored["table"])


def sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -40, 40)))


def _features_in_parts(texts: list[bytes], size: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same as ``features``, some texts at a time, for less memory."""
    parts, start, total = [], 0, 0
    for row, text in enumerate(texts):
        total += len(text)
        if total > size or row == len(texts) - 1:
            parts.append(features(texts[start : row + 1]))
            start, total = row + 1, 0
    counts = np.concatenate([np.diff(bounds) for _, _, bounds in parts])
    places, values = (np.concatenate([part[i] for part in parts]) for i in (0, 1))
    return places, values, np.concatenate([[0], np.cumsum(counts)])


def fit(texts: list[bytes], labels: np.ndarray) -> Machine:
    """Adaptive gradient steps on the logistic loss over shuffled batches. The order of the rows fixes the result."""
    rng = np.random.default_rng(SEED)
    table = rng.normal(0, 0.01, (SIZE, RANK + 1))
    table[:, 0] = 0
    share = min(max(labels.mean(), 0.01), 0.99)
    machine = Machine(float(np.log(share / (1 - share))), table)
    places, values, bounds = _features_in_parts(texts)
    seen, bias_seen = np.full(table.shape, 1e-6), 1e-6
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(texts)))):
        order = rng.permutation(len(texts))
        for chosen in np.split(order, range(BATCH, len(order), BATCH)):
            sizes = bounds[chosen + 1] - bounds[chosen]
            ends = np.cumsum(sizes)
            at = np.repeat(bounds[chosen] - ends + sizes, sizes) + np.arange(ends[-1])
            place, value = places[at], values[at]
            raw, sums = machine.raw(place, value, np.concatenate([[0], ends]))
            error = (sigmoid(raw) - labels[chosen]) / len(chosen)
            each = np.repeat(error, sizes) * value
            step = np.empty((len(place), RANK + 1))
            step[:, 0] = each
            step[:, 1:] = each[:, None] * (np.repeat(sums, sizes, axis=0) - table[place, 1:] * value[:, None])
            order_of = np.argsort(place, kind="stable")
            first = np.flatnonzero(np.diff(place[order_of], prepend=-1))
            used = place[order_of][first]
            gradient = np.add.reduceat(step[order_of], first, axis=0) + DECAY * table[used]
            seen[used] += np.square(gradient)
            table[used] -= RATE * gradient / np.sqrt(seen[used])
            bias_seen += error.sum() ** 2
            machine.bias -= RATE * error.sum() / bias_seen**0.5
    machine.table = table.astype(np.float32)
    return machine


def fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sample (doc_id, text, label) to one row with the model."""
    rows = []
    for batch in batches:
        data = batch.to_pydict()
        rows += [(d, (t or "").encode(), q) for d, t, q in zip(data["doc_id"], data["text"], data["label"], strict=True)]
    if rows:
        rows.sort()
        machine = fit([text for _, text, _ in rows], np.array([label for _, _, label in rows], dtype=np.float64))
        yield pa.RecordBatch.from_arrays([pa.array([machine.to_bytes()], pa.binary())], ["model"])


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> bytes | None:
    """A model from at most ``sample`` labelled rows whose remainder is not 1, drawn by a hash of their id."""
    prepare(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.filter((remainder(F.col("doc_id")) != 1) & F.col("label").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    drawn = texts.join(F.broadcast(known), "doc_id").groupBy("doc_id")
    # Of several rows of one id, the same one every time.
    drawn = drawn.agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("least"), F.first("label").alias("label"))
    drawn = drawn.select("doc_id", "least.text", "label")
    models = drawn.coalesce(1).mapInArrow(fit_rows, "model binary").collect()
    return bytes(models[0].model) if models else None


def score_rows(model):
    """(text, row) to (row, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine.from_bytes(model.value)
        for part, texts in slices(batches):
            yield pa.RecordBatch.from_arrays([part.column(1), pa.array(machine.score(texts))], ["row", "score"])

    return run


def _scored(docs: DataFrame, row: Column, model: bytes | None) -> DataFrame:
    spark = prepare(docs.sparkSession)
    packed = docs.select(F.col("text").cast("string").alias("text"), row.alias("row"))
    schema = packed.select("row", F.lit(0.0).alias("score")).schema
    return packed.mapInArrow(score_rows(spark.sparkContext.broadcast(model)), schema)


def score(docs: DataFrame, model: bytes | None) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    doc = F.col("row.doc_id")
    return _scored(docs, F.struct(F.col("doc_id").cast("bigint").alias("doc_id")), model).select(
        doc.alias("doc_id"),
        (remainder(doc) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def accept(docs: DataFrame, model: bytes | None) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    return _scored(docs, F.struct("*"), model).filter("score >= 0.5").select("row.*")
