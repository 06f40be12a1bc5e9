"""What the corpus operators share: reading, staged tables, slices of a batch, word hashes.

Python functions run on batches inside ``mapInArrow``. Spark partitions and shuffles the rows; nothing is gathered on
the driver or in one task.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from abasto.session import shared_folder

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where it is not installed, and give freed memory back to the system."""
    environment = spark.sparkContext.environment
    environment.setdefault("MALLOC_TRIM_THRESHOLD_", str(1 << 20))
    environment.setdefault("MALLOC_MMAP_THRESHOLD_", str(1 << 20))
    paths = [path for path in environment.get("PYTHONPATH", "").split(":") if path]
    if ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([*paths, ROOT])
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


# -- staged tables -------------------------------------------------------------------------------------------------


def staging_folder(spark: SparkSession) -> str:
    """A new folder that all executors share, under ``spark.checkpoint.dir``; on one machine the warehouse will do."""
    return f"{shared_folder(spark)}/abasto-staging/{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a result once and go on from the written rows: lineage ends here, and lost executors cost no rework."""
    spark = df.sparkSession
    path = path or staging_folder(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the folders of a staged table that nothing will read again."""
    spark = df.sparkSession
    for folder in {os.path.dirname(file) for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if "/abasto-staging/" in folder:
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# -- batches -------------------------------------------------------------------------------------------------------


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut batches so that the texts of a slice have about ``size`` bytes; a longer text is a slice of its own.

    Gives the slice and its texts as UTF-8, a null text as an empty one.
    """
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
        ends = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            count = max(1, int(np.searchsorted(ends, before + size, side="right")) - start)
            texts = values.slice(start, count).to_pylist()
            yield batch.slice(start, count), [b"" if value is None else value for value in texts]
            start += count


# -- hashes --------------------------------------------------------------------------------------------------------

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit values (the splitmix finisher)."""
    values = values + _GOLDEN
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_BASE = 0x2545F4914F6CDD1D  # odd, so it has an inverse modulo 2**64
_BYTE = mix(np.arange(256, dtype=np.uint64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[str, np.ndarray] = {}


def _powers(base: int, length: int, name: str) -> np.ndarray:
    """1, base, base**2 ... modulo 2**64, kept for the next call."""
    have = _POWERS.get(name)
    if have is None or len(have) < length:
        have = np.full(1 << max(12, (length - 1).bit_length()), np.uint64(base % (1 << 64)))
        have[0] = 1
        have = np.multiply.accumulate(have)
        _POWERS[name] = have
    return have[:length]


def word_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts joined by line ends, the start and end of every word in them, and where each text's words begin.

    Words are runs of bytes other than blank and \\x09-\\x0D. The last array has one entry more than there are texts.
    """
    joined = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    inside = np.zeros(len(joined) + 1, dtype=np.int8)
    inside[1:] = ~_SPACE[joined]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    lengths = np.fromiter((len(text) + 1 for text in texts), dtype=np.int64, count=len(texts))
    bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))
    return joined, starts, ends, bounds


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, text after text, and where each text's words begin (one entry more than texts)."""
    joined, starts, ends, bounds = word_spans(texts)
    powers = _powers(_BASE, len(joined), "up")
    sums = np.zeros(len(joined) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[joined] * powers, out=sums[1:])
    inverse = _powers(pow(_BASE, -1, 1 << 64), len(joined), "down")
    return mix((sums[ends] - sums[starts]) * inverse[starts]), bounds


_STEP = 0xD1342543DE82EF95


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive word hashes (across texts too: the caller drops those), by doubling."""
    if len(words) < size:
        return np.zeros(0, dtype=np.uint64)
    done, result, power = 0, None, words
    length = 1
    while True:
        if size & length:
            if result is None:
                result, done = power, length
            else:
                shift = np.uint64(pow(_STEP, done, 1 << 64))
                count = len(words) - done - length + 1
                result = result[:count] + power[done : done + count] * shift
                done += length
        if 2 * length > size:
            return mix(result[: len(words) - size + 1])
        count = len(power) - length
        power = power[:count] + power[length:] * np.uint64(pow(_STEP, length, 1 << 64))
        length *= 2


def place_in_text(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every word: the text it is in, and the words left in that text from it on."""
    counts = np.diff(bounds)
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, bounds[1:][owner] - np.arange(bounds[-1])


def as_long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
