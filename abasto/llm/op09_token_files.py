"""Token ids as files of range-coded segments (static range asymmetric numeral system), and back.

``write`` sorts the documents by ``doc_id`` in range partitions, encodes every whole text and codes the ids in segments
of whole documents. A segment row has its place (``part``, ``segment``), its documents and their lengths, and the
coded bytes (see ``rans``); Spark writes the rows, so a lost executor's half-written files never count. ``read`` decodes
segments in parallel.

Null text: only the end id. Null ``doc_id``: first in the order. Repeated ``doc_id``: every row is kept, in the order of the
texts' hashes, so a rerun gives the same places, and different texts of one id (or of none) are spread over tasks. Empty table: no segment, no row. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from abasto.llm import rans
from abasto.llm.common import prepare, staging_folder
from abasto.llm.tokens import encoder

END = 2
SEGMENT = 1 << 20  # ids after which a segment is closed; a longer document makes a longer segment

SEGMENTS = "part int, segment int, n_tokens bigint, doc_ids array<bigint>, lengths array<int>, data binary"


def encode_partition(path: str | None = None, end: int = END, size: int = SEGMENT):
    """A function for ``mapInArrow``: (doc_id, text) in order to segment rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(path).encode, TaskContext.get().partitionId()
        tail = np.array([end], dtype="<u4").tobytes()
        ids, docs, lengths, total, number = [], [], [], 0, 0

        def segment() -> pa.RecordBatch:
            data = rans.encode(np.frombuffer(b"".join(ids), dtype="<u4"))
            columns = [
                pa.array([part], pa.int32()),
                pa.array([number], pa.int32()),
                pa.array([total], pa.int64()),
                pa.array([docs], pa.list_(pa.int64())),
                pa.array([lengths], pa.list_(pa.int32())),
                pa.array([data], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["part", "segment", "n_tokens", "doc_ids", "lengths", "data"])

        for batch in batches:
            texts = batch.column(1)
            for row, doc in enumerate(batch.column(0).to_pylist()):
                coded = encode(texts[row].as_py() or "").tobytes() + tail
                ids.append(coded)
                docs.append(doc)
                lengths.append(len(coded) // 4)
                total += len(coded) // 4
                if total >= size:
                    yield segment()
                    ids, docs, lengths, total, number = [], [], [], 0, number + 1
        if docs:
            yield segment()

    return run


def decode_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segment rows to one row per document."""
    for batch in batches:
        rows = batch.to_pydict() if batch.num_rows else {"part": []}
        for row in range(len(rows["part"])):
            ids = rans.Segment(rows["data"][row]).decode()
            data = memoryview(ids.astype("<u4").tobytes())
            lengths = np.array(rows["lengths"][row], dtype=np.int64)
            ends = np.cumsum(lengths)
            if len(ids) != ends[-1]:
                raise rans.Damaged("lengths")
            sums = [zlib.crc32(data[4 * (e - n) : 4 * e]) for n, e in zip(lengths.tolist(), ends.tolist(), strict=True)]
            count = len(lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(count, rows["part"][row], np.int32)),
                    pa.array(np.full(count, rows["segment"][row], np.int32)),
                    pa.array(rows["doc_ids"][row], pa.int64()),
                    pa.array(ends - lengths),
                    pa.array(lengths),
                    pa.array(sums, pa.int64()),
                ],
                ["part", "segment", "doc_id", "before", "n_tokens", "ids_crc32"],
            )


def write(docs: DataFrame, folder: str, vocabulary: str | None = None, end: int = END) -> None:
    """Encode documents and write the segments, ascending by ``doc_id`` over parts and segments."""
    prepare(docs.sparkSession)
    ordered = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = ordered.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    ordered.mapInArrow(encode_partition(vocabulary, end), SEGMENTS).write.option("compression", "none").parquet(folder)


def starts(segments: DataFrame) -> DataFrame:
    """How many ids stand before each segment: over the parts, then inside each part."""
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    parts = parts.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    sizes = segments.select("part", "segment", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("inside"))
    return sizes.join(parts, "part").select("part", "segment", (F.col("part_start") + F.col("inside")).alias("start"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32."""
    segments = prepare(spark).read.schema(SEGMENTS).parquet(folder)
    schema = "part int, segment int, doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint"
    decoded = segments.mapInArrow(decode_partition, schema)
    placed = decoded.join(starts(segments.select("part", "segment", "n_tokens")), ["part", "segment"])
    return placed.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the files to a shared folder and give what they hold."""
    folder = folder or staging_folder(docs.sparkSession)
    write(docs, folder)
    return read(docs.sparkSession, folder)
