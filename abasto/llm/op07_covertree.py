"""Near-duplicate vectors by dual traversal of cover trees: all pairs of a label with a cosine of at least 0.93.

On unit vectors the bound is a distance, so the triangle inequality holds. Equal vectors of a label are one class. The
top of the tree is a net of pivots with halving radii over a bounded sample of the classes; every class belongs to the
node of its nearest pivot, and a node's covering radius is the largest distance it really has, per label. Node pairs whose
pivots are further apart than both radii and the bound together are left out; what remains goes to tasks as pairs of
blocks of at most about ``BLOCK`` rows, so a hot label is spread over many tasks. A task builds the lower levels of both
blocks' trees, again with halving radii, walks them together, prunes node pairs in the same way, and compares leaves. It
gives a row's number of links and one edge to the smallest vector of its component, never the pairs themselves.

The pivots only decide where pruning works: every class is placed and every node pair that may hold a link is
walked, so the result is exact. Vectors of different lengths have no cosine and are not compared.

Null label, null, zero or non-finite vectors: no links, their own component. Null ``vec_id``: not compared, its component
is null. Repeated ``vec_id``: every row is a vector of its own, with the links and the component of its vector. Empty table: no rows. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abasto.llm.common import prepare, stage
from abasto.llm.components import components

COSINE = 0.93
BLOCK = 1024
SAMPLE, MOST_PIVOTS, PER_PIVOT = 4096, 256, 4096  # vectors the pivots are chosen from; pivots; classes for one pivot
LEAF = 32
_SLACK = 1e-9


def vector_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, embedding) to (vec_id, label, length, name, vector); the last three null where nothing links."""
    for batch in batches:
        names, vectors, lengths = [], [], []
        for vec, label, value in zip(*(batch.column(i) for i in range(3)), strict=True):
            values = value.as_py() if vec.is_valid and label.is_valid else None
            vector = None
            if values and None not in values:
                array = np.array(values, dtype="<f8") + 0.0
                scale = np.abs(array).max()
                if np.isfinite(scale) and scale > 0:
                    vector = array
            names.append(None if vector is None else hashlib.blake2b(vector.tobytes(), digest_size=16).digest())
            vectors.append(None if vector is None else vector.tobytes())
            lengths.append(None if vector is None else len(vector))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(lengths, pa.int32()),
                pa.array(names, pa.binary()),
                pa.array(vectors, pa.binary()),
            ],
            ["vec_id", "label", "length", "name", "vector"],
        )


def unit(raw: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, safe for very large and very small components."""
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.sqrt(np.square(raw).sum(axis=1, keepdims=True))


def net(points: np.ndarray, most: int) -> np.ndarray:
    """Points of the finest level, of radii that halve from level to level, that has at most ``most`` points."""
    chosen, radius = np.zeros(1, dtype=np.int64), 2.0
    while radius > 1e-3:
        radius /= 2
        level, near = list(chosen), np.full(len(points), np.inf)
        for place in chosen:
            near = np.minimum(near, np.linalg.norm(points - points[place], axis=1))
        while len(level) <= most and (near > radius).any():
            level.append(int(near.argmax()))
            near = np.minimum(near, np.linalg.norm(points - points[level[-1]], axis=1))
        if len(level) > most:
            return np.array(level[:most])  # nested: the coarser level and the farthest points of the next one
        chosen = np.array(level)
    return chosen


def place_rows(pivots):
    """(label, length, vec_id, copies, vector) with the number of and the distance to the nearest pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers = pivots.value
        for batch in batches:
            lengths = batch.column(1).to_numpy(zero_copy_only=False)
            node, far = np.zeros(batch.num_rows, dtype=np.int32), np.full(batch.num_rows, 2.0)
            rows = np.flatnonzero(lengths == centers.shape[1])
            if len(rows):
                raw = np.stack([np.frombuffer(batch.column(4)[int(row)].as_py(), "<f8") for row in rows])
                distance = np.sqrt(np.maximum(0, 2 - 2 * (unit(raw) @ centers.T)))
                node[rows] = distance.argmin(axis=1)
                far[rows] = distance.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(node), pa.array(far)], [*batch.schema.names, "node", "far"])

    return run


# -- the lower tree --------------------------------------------------------------------------------------------------


class Node:
    __slots__ = ("members", "center", "radius", "children")

    def __init__(self, points: np.ndarray, members: np.ndarray, level: float):
        self.members, self.center = members, points[members[0]]
        gaps = np.linalg.norm(points[members] - self.center, axis=1)
        self.radius = float(gaps.max())
        self.children: list[Node] = []
        if len(members) <= LEAF:
            return
        radius = min(level, self.radius)
        while radius > 1e-6 and not self.children:
            radius /= 2
            groups, left = [], members
            while len(left):
                inside = np.linalg.norm(points[left] - points[left[0]], axis=1) <= radius
                groups.append(left[inside])
                left = left[~inside]
                if 4 * len(groups) > len(members) - len(left) + 16:  # the level covers next to nothing: a leaf
                    return
            if len(groups) > 1:
                self.children = [Node(points, group, radius) for group in groups]


def linked(points_a: np.ndarray, points_b: np.ndarray | None, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of linked rows of two blocks, or of one block and itself (each pair once), by leaves."""
    bound = float(np.sqrt(2 - 2 * cosine)) + _SLACK
    root_a = Node(points_a, np.arange(len(points_a)), 2.0)
    root_b = root_a if points_b is None else Node(points_b, np.arange(len(points_b)), 2.0)
    other = points_a if points_b is None else points_b
    stack = [(root_a, root_b)]
    while stack:
        one, two = stack.pop()
        if one is not two and np.linalg.norm(one.center - two.center) - one.radius - two.radius > bound:
            continue
        if one is two and one.children:
            stack += [(x, y) for i, x in enumerate(one.children) for y in one.children[i:]]
        elif one.children and (not two.children or one.radius >= two.radius):
            stack += [(child, two) for child in one.children]
        elif two.children:
            stack += [(one, child) for child in two.children]
        else:
            x, y = points_a[one.members], other[two.members]
            cosines = x @ y.T
            hit = cosines >= cosine
            for i, j in np.argwhere(np.abs(cosines - cosine) < 1e-12):  # too close for a rounded product: sum again
                hit[i, j] = float(np.dot(x[i], y[j]) / (np.linalg.norm(x[i]) * np.linalg.norm(y[j]))) >= cosine
            if one is two:
                hit = np.triu(hit, 1)
            i, j = np.nonzero(hit)
            if len(i):
                yield one.members[i], two.members[j]


def smallest(count: int, a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each of ``count`` rows the smallest id of its component under links a-b."""
    best = ids.copy()
    while True:
        low = np.minimum(best[a], best[b])
        before = best.copy()
        np.minimum.at(best, a, low)
        np.minimum.at(best, b, low)
        if (best == before).all():
            return best


def block_rows(cosine: float):
    """Rows sorted by (pair, side): pair, side, vec_id, copies, vector; to (vec_id, links, root) of linked rows."""

    def compare(rows: list[tuple]) -> pa.RecordBatch:
        sides = np.array([row[0] for row in rows])
        ids = np.array([row[1] for row in rows], dtype=np.int64)
        copies = np.array([row[2] for row in rows], dtype=np.int64)
        points = unit(np.stack([np.frombuffer(row[3], "<f8") for row in rows]))
        split = int((sides == 0).sum())
        links, found = np.zeros(len(rows), dtype=np.int64), [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        if sides[0] == 2:  # a block with itself
            split = 0
            pairs = linked(points, None, cosine)
        else:
            pairs = linked(points[:split], points[split:], cosine) if 0 < split < len(rows) else iter(())
        for a, b in pairs:
            found.append((a, b + split))
            np.add.at(links, a, copies[b + split])
            np.add.at(links, b + split, copies[a])
        a, b = (np.concatenate(side) for side in zip(*found, strict=True))
        roots, keep = smallest(len(rows), a, b, ids), links > 0
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[keep]), pa.array(links[keep]), pa.array(roots[keep])], ["vec_id", "links", "root"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, held = None, []
        for batch in batches:
            columns = batch.to_pydict()
            for row in zip(*(columns[name] for name in ("pair", "side", "vec_id", "copies", "vector")), strict=True):
                if held and row[0] != pair:
                    yield compare(held)
                    held = []
                pair = row[0]
                held.append(row[1:])
        if held:
            yield compare(held)

    return run


# -- the join --------------------------------------------------------------------------------------------------------


def pivots_of(classes: DataFrame) -> np.ndarray:
    """Pivots from a bounded sample of vectors of one length."""
    count = classes.count()
    sample = classes.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("length", "vector").collect()
    if not sample:
        return np.zeros((1, 1))
    lengths = [row.length for row in sample]
    usual = max(set(lengths), key=lengths.count)
    points = unit(np.stack([np.frombuffer(row.vector, "<f8") for row in sample if row.length == usual]))
    return points[net(points, min(MOST_PIVOTS, max(4, count // PER_PIVOT)))]


def _links(classes: DataFrame, cosine: float) -> DataFrame:
    """(vec_id, links, root) rows, several for a class, that add up to its links and connect its component."""
    spark = classes.sparkSession
    centers = pivots_of(classes)
    fields = "label int, length int, vec_id bigint, copies bigint, vector binary, node int, far double"
    placed = stage(classes.mapInArrow(place_rows(spark.sparkContext.broadcast(centers)), fields))
    key = ["label", "length", "node"]
    nodes = placed.groupBy(key).agg(F.max("far").alias("radius"), F.ceil(F.count("*") / BLOCK).alias("blocks"))
    nodes = stage(nodes)  # at most as many a label as there are pivots
    apart = np.sqrt(np.maximum(0, 2 - 2 * np.clip(centers @ centers.T, -1, 1)))
    gaps = spark.createDataFrame(
        [(i, j, float(apart[i, j])) for i in range(len(centers)) for j in range(i, len(centers))], "node int, node2 int, gap double"
    )
    two = nodes.toDF("label", "length", "node2", "radius2", "blocks2")
    pairs = nodes.join(two, ["label", "length"]).filter("node <= node2").join(F.broadcast(gaps), ["node", "node2"])
    bound = float(np.sqrt(2 - 2 * cosine)) + 1e-6
    pairs = pairs.filter((F.col("node") == F.col("node2")) | (F.col("gap") - F.col("radius") - F.col("radius2") <= bound))
    zero = F.lit(0).cast("bigint")
    pairs = pairs.withColumn("a", F.explode(F.sequence(zero, F.col("blocks") - 1)))
    pairs = pairs.withColumn("b", F.explode(F.sequence(zero, F.col("blocks2") - 1)))
    pairs = pairs.filter("node < node2 OR a <= b")
    pairs = pairs.withColumn("pair", F.struct("label", "length", "node", "node2", "a", "b"))
    same = (F.col("node") == F.col("node2")) & (F.col("a") == F.col("b"))
    sides = pairs.select(
        "label", "length", "pair",
        F.explode(
            F.when(same, F.array(F.struct(F.col("node"), F.col("a").alias("block"), F.lit(2).alias("side")))).otherwise(
                F.array(
                    F.struct(F.col("node"), F.col("a").alias("block"), F.lit(0).alias("side")),
                    F.struct(F.col("node2").alias("node"), F.col("b").alias("block"), F.lit(1).alias("side")),
                )
            )
        ).alias("at"),
    )
    sides = sides.select("label", "length", "pair", "at.node", "at.block", "at.side")
    rows = placed.join(nodes.select(*key, "blocks"), key)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
    rows = rows.join(sides, [*key, "block"]).select(
        F.concat_ws("/", *(f"pair.{name}" for name in ("label", "length", "node", "node2", "a", "b"))).alias("pair"),
        "side", "vec_id", "copies", "vector",
    )
    rows = rows.repartition("pair").sortWithinPartitions("pair", "side", "vec_id")
    return stage(rows.mapInArrow(block_rows(cosine), "vec_id bigint, links bigint, root bigint"))


def join(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every vector."""
    prepare(vectors.sparkSession)
    given = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("int").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    schema = "vec_id bigint, label int, length int, name binary, vector binary"
    rows = stage(given.mapInArrow(vector_rows, schema))
    # A class, all equal vectors of a label, is known by a hash, as a ``vec_id`` may be given to different vectors.
    classes = rows.filter("name IS NOT NULL").groupBy("label", "name").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.first("length").alias("length"), F.first("vector").alias("vector")
    )
    classes = stage(classes.select(F.xxhash64("label", "name").alias("class"), "label", "name", "first", "copies", "length", "vector"))
    links = _links(classes.select("label", "length", F.col("class").alias("vec_id"), "copies", "vector"), cosine)
    roots = components(links.select(F.col("vec_id").alias("a"), F.col("root").alias("b"))).toDF("class", "root")
    counts = links.groupBy("vec_id").agg(F.sum("links").alias("links")).withColumnRenamed("vec_id", "class")
    placed = classes.select("class", "label", "name", "first", "copies").join(roots, "class", "left")
    placed = placed.withColumn("root", F.coalesce("root", "class"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.join(least, "root").join(counts, "class", "left")
    named = named.select("label", "name", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    found = rows.select("vec_id", "label", "name").join(named, ["label", "name"], "left")
    component = F.coalesce("component_id", "vec_id")
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
