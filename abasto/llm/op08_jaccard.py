"""Join of documents whose word-shingle sets have a Jaccard similarity of at least 0.8, by parity sketches.

Two sets of sizes ``s <= t`` that are similar enough differ in at most ``d = (s + t) // 9`` members, and ``t`` is at
most ``s * 5 // 4``. Shingles are dealt by their hash to the parts of a size band; the XOR of the hashes of a part's
members is its parity sketch, which changes only where the sets differ. So at most ``d`` parts differ. A document gives
the sketches of its first ``d_max + 1`` parts that are not empty, ``d_max`` being ``d`` with the largest set it may be
similar to: of the one of two similar documents whose parts end first, at least one of these parts is the same in
both. A document joins in its own band and in the band of the largest set it may be similar to. One with too few
filled parts gives all of its parts, the empty ones too.

Documents that share a key are candidates. Each set also has a parity bit sketch of four to eight bits a shingle: the
Hamming distance of two is at most their difference, so a larger one rules a pair out. What is left is verified on the
whole sets. In a group of one key, all are first compared with the smallest member; linked ones form components. Then
every set is compared with the one nearest by Hamming distance in another component, and in the end all that are still
in different components are, in blocks. So a large group of near copies costs a few pairs for each member, and no link
between two components is lost. Equal sets are one class from the start.

Shingles are 64-bit hashes of five words, classes 64-bit hashes of sets. Null or empty text: an empty set that is linked
with nothing. Null ``doc_id``: linked with nothing, its component is null. Repeated ``doc_id``: each row has its own
set; all are returned. Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abasto.llm.common import as_long, gram_hashes, mix, prepare, slices, stage, word_hashes
from abasto.llm.components import components

SIZE = 5
BLOCK = 2048  # members of a group that are compared at once
SMALL = 16  # groups up to this size are compared many at a time
_BAND = 1.5  # each band's largest set is so many times the one before
_LEAST_BITS, _MOST_BITS = 64, 1 << 16


# -- sets and keys ---------------------------------------------------------------------------------------------------


def shingle_sets(texts: list[bytes], size: int = SIZE) -> list[np.ndarray]:
    """The sorted different shingle hashes of every text; fewer words than ``size`` make one shingle."""
    words, bounds = word_hashes([text.lower() for text in texts])
    grams = gram_hashes(words, size)
    sets = []
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if end - start >= size:
            sets.append(np.unique(grams[start : end - size + 1]))
        elif end > start:
            sets.append(mix(gram_hashes(words[start:end], end - start) + np.uint64(end - start)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def most_different(size: int) -> int:
    """The largest difference of a set of this size from one that is similar and not smaller."""
    return (size + size * 5 // 4) // 9


def band_of(size: int) -> tuple[int, int]:
    """Number and largest set of the band of a size."""
    number, most = 0, 4
    while most < size:
        number, most = number + 1, int(most * _BAND)
    return number, most


def part_keys(members: np.ndarray) -> np.ndarray:
    """The join keys of a sorted set."""
    size, keys = len(members), []
    if not size:
        return members
    enough = most_different(size) + 1
    for band, most in dict.fromkeys((band_of(size), band_of(size * 5 // 4))):
        parts = (most_different(most) + 1) * 23 // 20 + 2
        part = ((members >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        first = np.flatnonzero(np.diff(part, prepend=np.uint64(parts)))
        sketch, filled = np.bitwise_xor.reduceat(mix(members), first), part[first]
        if len(filled) < enough:
            whole = np.zeros(parts, dtype=np.uint64)
            whole[filled] = sketch
            sketch, filled = whole, np.arange(parts, dtype=np.uint64)
        else:
            sketch, filled = sketch[:enough], filled[:enough]
        keys.append(mix(sketch ^ mix(filled + np.uint64(band << 32))))
    return np.concatenate(keys)


def bit_sketch(members: np.ndarray) -> np.ndarray:
    """Parities of the members that fall on each bit, as bytes; a power of two of at least four bits a member."""
    bits = min(_MOST_BITS, max(_LEAST_BITS, 1 << (4 * len(members) - 1).bit_length())) if len(members) else _LEAST_BITS
    counts = np.bincount((mix(members ^ np.uint64(0x5DEECE66D)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8))


def fold(sketch: np.ndarray, width: int) -> np.ndarray:
    """A sketch of fewer bytes: halves on top of each other."""
    while sketch.shape[-1] > width:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def names_of(sets: list[np.ndarray]) -> np.ndarray:
    """The class of each set."""
    return as_long(mix(np.array([int(mix(members).sum(dtype=np.uint64)) for members in sets], dtype=np.uint64)))


def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, digest) to (doc_id, digest, n_shingles, sid, sketch)."""
    for part, texts in slices(batches):
        sets = shingle_sets(texts)
        yield pa.RecordBatch.from_arrays(
            [
                part.column(0),
                part.column(2),
                pa.array([len(members) for members in sets], pa.int64()),
                pa.array(names_of(sets)),
                pa.array([bit_sketch(members).tobytes() for members in sets], pa.binary()),
            ],
            ["doc_id", "digest", "n_shingles", "sid", "sketch"],
        )


def key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (key, sid), each pair once a slice."""
    for _, texts in slices(batches):
        sets = shingle_sets(texts)
        once = {name: members for name, members in zip(names_of(sets).tolist(), sets, strict=True) if len(members)}
        keys = [part_keys(members) for members in once.values()]
        counts = [len(own) for own in keys]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(as_long(np.concatenate([*keys, np.zeros(0, dtype=np.uint64)]))),
                pa.array(np.repeat(np.array(list(once), dtype=np.int64), counts)),
            ],
            ["key", "sid"],
        )


def shared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, sid) to (key, leader, sid) of the keys that more than one set has; no row for the leader.

    A group may go on in the next batch: the last key, its first set and its last set are carried over.
    """
    key = leader = last = None
    for batch in batches:
        keys, sids = (column.to_numpy(zero_copy_only=False) for column in batch.columns)
        if not len(keys):
            continue
        begins = np.concatenate([[True], keys[1:] != keys[:-1]])
        begins[0] = keys[0] != key
        starts = np.flatnonzero(begins)
        group = np.cumsum(begins)
        leaders = np.concatenate([[leader if leader is not None else 0], sids[starts]]).astype(np.int64)[group]
        again = np.concatenate([[not begins[0] and sids[0] == last], (sids[1:] == sids[:-1]) & ~begins[1:]])
        keep = ~begins & ~again
        key, leader, last = keys[-1], leaders[-1], sids[-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[keep]), pa.array(leaders[keep]), pa.array(sids[keep])], ["key", "leader", "sid"]
        )


# -- candidates ------------------------------------------------------------------------------------------------------


def near_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, size and sketch of both) to the pairs (a, b) that sizes and Hamming distance leave possible."""
    for batch in batches:
        a, b, sizes_a, sizes_b = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        keep = 5 * np.minimum(sizes_a, sizes_b) >= 4 * np.maximum(sizes_a, sizes_b)
        for row in np.flatnonzero(keep):
            one, two = (np.frombuffer(batch.column(i)[int(row)].as_py(), np.uint8) for i in (4, 5))
            width = min(len(one), len(two))
            distance = int(np.bitwise_count(fold(one, width) ^ fold(two, width)).sum())
            keep[row] = 9 * distance <= sizes_a[row] + sizes_b[row]
        yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])


def distances(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Hamming distances of two lists of sketches of one width, by chunks of the left one: first row, then the table."""
    left, right = left.view(np.uint64), right.view(np.uint64)
    chunk = max(1, (1 << 19) // right.size)
    for first in range(0, len(left), chunk):
        yield first, np.bitwise_count(left[first : first + chunk, None] ^ right[None]).sum(axis=2, dtype=np.int64)


def block_pairs(rows: dict, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Possible pairs between two lists of rows of a group that are not yet in one component, and their distances."""
    sizes, roots, widths, sketches = rows["size"], rows["root"], rows["width"], rows["sketch"]
    found = [(np.zeros(0, dtype=np.int64),) * 3]
    for wide in np.unique(widths[left]).tolist():
        ours = left[widths[left] == wide]
        for other in (wide // 2, wide, wide * 2):  # similar sets have sketches of one or of neighbouring widths
            theirs, width = right[widths[right] == other], min(wide, other)
            if not len(theirs) or not len(ours):
                continue
            one = np.stack([fold(np.frombuffer(sketches[row], np.uint8), width) for row in ours.tolist()])
            two = np.stack([fold(np.frombuffer(sketches[row], np.uint8), width) for row in theirs.tolist()])
            for first, distance in distances(one, two):
                own = ours[first : first + len(distance)]
                x, y = sizes[own][:, None], sizes[theirs][None]
                possible = (9 * distance <= x + y) & (5 * np.minimum(x, y) >= 4 * np.maximum(x, y))
                possible &= roots[own][:, None] != roots[theirs][None]
                i, j = np.nonzero(possible)
                found.append((own[i], theirs[j], distance[i, j]))
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def pair_distances(sketches: pa.Array, i: np.ndarray, j: np.ndarray, chunk: int = 1 << 20) -> np.ndarray:
    """Hamming distances of the sketches at places i and j, folded to the narrower one."""
    ends = np.frombuffer(sketches.buffers()[1], np.int32)[sketches.offset : sketches.offset + len(sketches) + 1]
    data = np.frombuffer(sketches.buffers()[2] or b"", np.uint8)
    starts, widths = ends[:-1].astype(np.int64), np.diff(ends).astype(np.int64)
    distance = np.zeros(len(i), dtype=np.int64)
    kinds = widths[i] * (1 << 32) + widths[j]
    for kind in np.unique(kinds).tolist():
        own = np.flatnonzero(kinds == kind)
        one, two = kind >> 32, kind & 0xFFFFFFFF
        step = max(1, chunk // max(one, two))
        for part in (own[at : at + step] for at in range(0, len(own), step)):
            left = fold(data[starts[i[part]][:, None] + np.arange(one)], min(one, two))
            right = fold(data[starts[j[part]][:, None] + np.arange(two)], min(one, two))
            distance[part] = np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64)
    return distance


def nearest(a: np.ndarray, b: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """Of the pairs of each ``a``, the place of the one with the smallest distance."""
    order = np.lexsort((b, distance, a))
    return order[np.flatnonzero(np.diff(a[order], prepend=-1))]


def rest_rows(only_nearest: bool):
    """Rows sorted by (key, one, two), the cells of a group's block pairs, to possible pairs (a, b, distance).

    Columns: key, one, two, block, sid, root, size, sketch. A cell has the rows of block ``one`` and of block ``two``.
    """

    def pairs(cell: pa.Table) -> pa.RecordBatch:
        rows = {name: cell[name].to_numpy() for name in ("block", "sid", "root", "size")}
        rows["sketch"] = cell["sketch"].to_pylist()
        rows["width"] = np.array([len(sketch) for sketch in rows["sketch"]])
        one, two = cell["one"][0].as_py(), cell["two"][0].as_py()
        a, b, distance = block_pairs(rows, np.flatnonzero(rows["block"] == one), np.flatnonzero(rows["block"] == two))
        if only_nearest:
            if one != two:
                a, b, distance = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([distance, distance])
            chosen = nearest(a, b, distance)
            a, b, distance = rows["sid"][a[chosen]], rows["sid"][b[chosen]], distance[chosen]
        else:
            a, b = rows["sid"][a], rows["sid"][b]
            a, b = np.minimum(a, b), np.maximum(a, b)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(distance)], ["a", "b", "distance"])

    def small(batch: pa.RecordBatch, cell: np.ndarray, wanted: np.ndarray) -> pa.RecordBatch:
        """The pairs of all wanted small cells of a batch at once."""
        sid, root, size = (batch.column(i).to_numpy(zero_copy_only=False) for i in (4, 5, 6))
        found = [(np.zeros(0, dtype=np.int64),) * 2]
        for step in range(1, SMALL):
            i = np.flatnonzero((cell[step:] == cell[:-step]) & wanted[:-step])
            if not len(i):
                break
            j = i + step
            low, high = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
            keep = (root[i] != root[j]) & (5 * low >= 4 * high)
            found.append((i[keep], j[keep]))
        i, j = (np.concatenate(side) for side in zip(*found, strict=True))
        distance = pair_distances(batch.column(7).cast(pa.binary()), i, j)
        keep = 9 * distance <= size[i] + size[j]
        i, j, distance = i[keep], j[keep], distance[keep]
        if only_nearest:
            i, j, distance = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([distance, distance])
            chosen = nearest(i, j, distance)
            a, b, distance = sid[i[chosen]], sid[j[chosen]], distance[chosen]
        else:
            a, b = np.minimum(sid[i], sid[j]), np.maximum(sid[i], sid[j])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(distance)], ["a", "b", "distance"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            new = np.any([np.diff(column) != 0 for column in names], axis=0)
            cuts = np.concatenate([[0], np.flatnonzero(new) + 1, [batch.num_rows]])
            counts = np.diff(cuts)
            few = (counts <= SMALL) & (names[1][cuts[:-1]] == names[2][cuts[:-1]])
            few[0] = few[-1] = False  # these may go on in another batch
            number = np.repeat(np.arange(len(counts)), counts)
            if few.any():
                yield small(batch, number, few[number])
            for start, end in zip(cuts[:-1][~few].tolist(), cuts[1:][~few].tolist(), strict=True):
                cell = tuple(column[start] for column in names)
                if held and cell != last:
                    yield pairs(pa.Table.from_batches(held))
                    held = []
                last = cell
                held.append(batch.slice(start, end - start))
        if held:
            yield pairs(pa.Table.from_batches(held))

    return run


def verified_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, both sets) to the pairs that are similar."""
    for batch in batches:
        keep = []
        for row in range(batch.num_rows):
            one, two = (np.frombuffer(batch.column(i)[row].as_py(), np.uint64) for i in (2, 3))
            both = len(np.intersect1d(one, two, assume_unique=True))
            keep.append(100 * both >= 80 * (len(one) + len(two) - both))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])


def whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sid, text) to (sid, members); a text of another class under the same ``doc_id`` is left out."""
    for part, texts in slices(batches):
        sets = shingle_sets(texts)
        right = pa.array(names_of(sets) == part.column(0).to_numpy(zero_copy_only=False))
        members = pa.array([members.tobytes() for members in sets], pa.binary())
        yield pa.RecordBatch.from_arrays([part.column(0).filter(right), members.filter(right)], ["sid", "members"])


# -- the join --------------------------------------------------------------------------------------------------------


def _verify(pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """The similar ones of candidate pairs: whole sets are built for their classes only."""
    pairs = stage(pairs)
    needed = pairs.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid"))).distinct()
    needed = classes.join(needed, "sid", "left_semi").select("sid", "doc_id", "n_shingles")
    own = texts.join(needed, "doc_id").select("sid", "text").mapInArrow(whole_sets, "sid bigint, members binary")
    own = stage(own.dropDuplicates(["sid"]))
    one, two = own.toDF("a", "set_a"), own.toDF("b", "set_b")
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "set_a", "set_b")
    return stage(both.mapInArrow(verified_rows, "a bigint, b bigint"))


def _linked_classes(texts: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes (sid, doc_id, n_shingles, sketch) and links (a, b) that connect all that are similar."""
    filled = sets.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stage(
        filled.groupBy("sid").agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"), F.max("sketch").alias("sketch"))
    )
    keys = texts.filter("doc_id IS NOT NULL").mapInArrow(key_rows, "key bigint, sid bigint")
    keys = keys.repartition("key").sortWithinPartitions("key", "sid")
    shared = stage(keys.mapInArrow(shared_rows, "key bigint, leader bigint, sid bigint"))

    small = classes.select("sid", "n_shingles", "sketch")
    one, two = small.toDF("a", "size_a", "sketch_a"), small.toDF("b", "size_b", "sketch_b")
    starred = shared.select(F.col("leader").alias("a"), F.col("sid").alias("b")).distinct()
    starred = starred.join(one, "a").join(two, "b").select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b")
    links = _verify(starred.mapInArrow(near_rows, "a bigint, b bigint"), classes, texts)

    everyone = shared.select("key", "sid").union(shared.select("key", F.col("leader").alias("sid")).distinct())
    nearest_of = _open_cells(everyone, small, links).mapInArrow(rest_rows(True), "a bigint, b bigint, distance bigint")
    nearest_of = nearest_of.groupBy("a").agg(F.min(F.struct("distance", "b")).alias("at"))
    nearest_of = nearest_of.select(F.least("a", "at.b").alias("a"), F.greatest("a", "at.b").alias("b")).distinct()
    links = links.union(_verify(nearest_of, classes, texts))
    rest = _open_cells(everyone, small, links).mapInArrow(rest_rows(False), "a bigint, b bigint, distance bigint")
    return classes, links.union(_verify(rest.select("a", "b").distinct(), classes, texts))


def _open_cells(everyone: DataFrame, small: DataFrame, links: DataFrame) -> DataFrame:
    """The members of key groups that are in more than one component so far, in cells of two blocks."""
    placed = everyone.join(components(links).toDF("sid", "root"), "sid", "left")
    placed = placed.select("key", "sid", F.coalesce("root", "sid").alias("root"))
    open_keys = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"))
    open_keys = open_keys.filter("low < high").select("key", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    cells = placed.join(open_keys, "key")
    cells = cells.withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")))
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    cells = cells.select(
        "key", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "sid", "root"
    )
    cells = cells.join(small, "sid").withColumnRenamed("n_shingles", "size")
    cells = cells.select("key", "one", "two", "block", "sid", "root", "size", "sketch")
    return cells.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")


def digest_of(text: Column) -> Column:
    """What tells rows of one ``doc_id`` apart."""
    return F.xxhash64(text.cast("string"))


def groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, digest (of its text), n_shingles, component_id, and root, a hash that names its group.

    ``component_id`` alone does not name a group where different texts share a ``doc_id``. ``root`` is null without a set.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = texts.select("doc_id", "text", digest_of(F.col("text")).alias("digest"))
    sets = stage(marked.mapInArrow(set_rows, "doc_id bigint, digest bigint, n_shingles bigint, sid bigint, sketch binary"))
    classes, links = _linked_classes(texts, sets)
    roots = components(links).toDF("sid", "root")
    placed = classes.select("sid", "doc_id").join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = placed.join(least, "root").select("sid", "component_id", "root")
    has_set = F.expr("n_shingles > 0 AND doc_id IS NOT NULL")
    found = sets.select("doc_id", "digest", "n_shingles", F.when(has_set, F.col("sid")).alias("sid")).join(named, "sid", "left")
    return found.select("doc_id", "digest", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "root")


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest ``doc_id`` reachable by links."""
    return groups(docs).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """Of every group the row with the smallest ``doc_id``, with its columns; documents without an id are all kept.

    Where rows share that id, the one with the smallest hash of its text stays, and of rows with the same text the one with
    the smallest hash of all columns: a rerun keeps the same rows. Texts without words are groups of equal texts of one id.
    """
    found = groups(docs).filter("doc_id IS NOT NULL")
    group = F.when(F.col("root").isNull(), F.struct("doc_id", "digest")).alias("alone")
    kept = found.groupBy("root", group).agg(F.min(F.struct("doc_id", "digest")).alias("least"))
    kept = kept.select(F.col("least.doc_id").alias("_kept_id"), F.col("least.digest").alias("_kept_digest")).distinct()
    packed = docs.filter("doc_id IS NOT NULL").select(F.struct("*").alias("row"))
    packed = packed.select(
        F.col("row.doc_id").cast("bigint").alias("_kept_id"), digest_of(F.col("row.text")).alias("_kept_digest"), "row"
    )
    own = packed.join(kept, ["_kept_id", "_kept_digest"], "left_semi").groupBy("_kept_id", "_kept_digest")
    own = own.agg(F.min(F.struct(F.xxhash64("row").alias("order"), "row")).alias("least")).select("least.row.*")
    return own.unionByName(docs.filter("doc_id IS NULL"))
