"""The coder of ``op09_token_files``: one segment of token ids to bytes and back.

A segment has one static frequency table (sums to 2**16). Its ids are dealt to blocks, a block to ``lanes`` interleaved
coders: id number ``(block * steps + step) * lanes + lane``. Every lane is a 32-bit state that moves 16 bits at a time.
A block can be decoded without the others, and from any of its checkpoints: the states of its lanes and the place in
its stream, kept every ``every`` steps. Streams and header carry CRC-32 sums.

Layout, little-endian: magic, header fields, sum of the header part; then the table (compressed), sums and lengths of
the streams, checkpoints, streams.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"ABR1"
BITS = 16
LANES, STEPS, EVERY = 128, 512, 128
_HEADER = struct.Struct("<4s7I")


class Damaged(ValueError):
    """The bytes are not what was written."""


def table_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids that occur, ascending, and frequencies of at least 1 that sum to 2**16."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    if len(symbols) > 1 << BITS:
        raise ValueError("more different ids than the table has room for")
    counts = counts[symbols]
    room = (1 << BITS) - len(symbols)
    shares = counts * room / counts.sum()
    freqs = np.floor(shares).astype(np.int64)
    left = room - int(freqs.sum())
    freqs[np.argsort(-(shares - freqs), kind="stable")[:left]] += 1
    return symbols, freqs + 1


def encode(ids: np.ndarray, lanes: int = LANES, steps: int = STEPS, every: int = EVERY) -> bytes:
    """The bytes of a segment; ``ids`` has at least one id."""
    count = len(ids)
    steps = min(steps, -(-count // lanes))
    blocks = -(-count // (lanes * steps))
    symbols, freqs = table_of(ids)
    place = np.zeros(int(symbols[-1]) + 1, dtype=np.int32)
    place[symbols] = np.arange(len(symbols), dtype=np.int32)
    full = np.full(blocks * steps * lanes, int(freqs.argmax()), dtype=np.int32)  # the last block is filled up
    full[:count] = place[ids]
    grid = np.ascontiguousarray(full.reshape(blocks, steps, lanes).transpose(1, 0, 2))
    freq, start = freqs.astype(np.float64), (np.cumsum(freqs) - freqs).astype(np.int64)

    state = np.full((blocks, lanes), 1 << BITS, dtype=np.int64)
    words = np.zeros((steps, blocks, lanes), dtype=np.uint16)
    moved = np.zeros((steps, blocks, lanes), dtype=bool)
    marks = range(0, steps, every)
    states = np.zeros((blocks, len(marks), lanes), dtype="<u4")
    for step in range(steps - 1, -1, -1):
        symbol = grid[step]
        f = freq[symbol]
        out = state >= f * (1 << BITS)
        moved[step] = out
        words[step] = state & 0xFFFF
        state >>= out * BITS
        whole = np.floor(state / f)  # exact: states are below 2**32, frequencies at most 2**16
        state = state + (whole * ((1 << BITS) - f)).astype(np.int64) + start[symbol]
        if step % every == 0:
            states[:, step // every] = state
    words, moved = words.transpose(1, 0, 2), moved.transpose(1, 0, 2)
    per_step = moved.sum(axis=2)
    ahead = np.cumsum(per_step, axis=1) - per_step
    offsets = ahead[:, ::every].astype("<u4")
    streams = [words[block][moved[block]].astype("<u2").tobytes() for block in range(blocks)]
    index = np.array([[len(stream), zlib.crc32(stream)] for stream in streams], dtype="<u4").tobytes()
    table = zlib.compress(np.diff(symbols, prepend=0).astype("<u4").tobytes() + (freqs - 1).astype("<u2").tobytes())
    rest = index + offsets.tobytes() + states.tobytes() + table
    head = _HEADER.pack(MAGIC, count, lanes, steps, every, len(symbols), len(table), zlib.crc32(rest))
    return b"".join([head, struct.pack("<I", zlib.crc32(head)), rest, *streams])


class Segment:
    """A segment's bytes, checked and opened."""

    def __init__(self, data: bytes):
        size = _HEADER.size
        if len(data) < size + 4 or struct.unpack_from("<I", data, size)[0] != zlib.crc32(data[:size]):
            raise Damaged("header")
        magic, self.count, self.lanes, self.steps, self.every, kinds, packed, check = _HEADER.unpack_from(data)
        if magic != MAGIC:
            raise Damaged("not a segment")
        self.blocks = -(-self.count // (self.lanes * self.steps))
        marks = len(range(0, self.steps, self.every))
        at = size + 4
        sizes = [self.blocks * 8, self.blocks * marks * 4, self.blocks * marks * self.lanes * 4, packed]
        if zlib.crc32(data[at : at + sum(sizes)]) != check:
            raise Damaged("index")
        index = np.frombuffer(data, "<u4", self.blocks * 2, at).reshape(self.blocks, 2)
        self.offsets = np.frombuffer(data, "<u4", self.blocks * marks, at + sizes[0]).reshape(self.blocks, marks)
        states = np.frombuffer(data, "<u4", self.blocks * marks * self.lanes, at + sizes[0] + sizes[1])
        self.states = states.reshape(self.blocks, marks, self.lanes)
        table = zlib.decompress(data[at + sum(sizes[:3]) : at + sum(sizes)])
        self.symbols = np.cumsum(np.frombuffer(table, "<u4", kinds), dtype=np.uint32)
        self.freqs = np.frombuffer(table, "<u2", kinds, kinds * 4).astype(np.int64) + 1
        self.starts = np.cumsum(self.freqs) - self.freqs
        self.of_slot = np.repeat(np.arange(kinds, dtype=np.int32), self.freqs)
        ends = np.cumsum(index[:, 0].astype(np.int64)) + at + sum(sizes)
        self.streams = []
        for (length, check), end in zip(index, ends, strict=True):
            stream = data[int(end) - int(length) : int(end)]
            if len(stream) != length or zlib.crc32(stream) != check:
                raise Damaged("stream")
            self.streams.append(np.frombuffer(stream, "<u2"))

    def decode(self, blocks: list[int] | None = None, mark: int = 0, steps: int | None = None) -> np.ndarray:
        """The ids of some blocks, all by default, from a checkpoint on; without the filling of the last block."""
        chosen = list(range(self.blocks)) if blocks is None else blocks
        first = mark * self.every
        steps = self.steps - first if steps is None else min(steps, self.steps - first)
        pieces = [self.streams[block] for block in chosen]
        stream = np.concatenate([*pieces, np.zeros(1, "<u2")]).astype(np.int64)
        base = np.cumsum([0, *map(len, pieces)][:-1])
        at = base + self.offsets[chosen, mark].astype(np.int64)
        state = self.states[chosen, mark].astype(np.int64)
        freq = self.freqs[self.of_slot]  # of the symbol that holds a slot, and the slot's place in it
        inside = np.arange(1 << BITS) - self.starts[self.of_slot]
        slots = np.zeros((steps, len(chosen), self.lanes), dtype=np.uint16)
        for step in range(steps):
            slot = state & 0xFFFF
            slots[step] = slot
            state = freq[slot] * (state >> BITS) + inside[slot]
            more = state < (1 << BITS)
            rank = np.cumsum(more, axis=1)
            word = stream[(at[:, None] + rank - 1) * more]
            state = np.where(more, (state << BITS) | word, state)
            at = at + rank[:, -1]
        out = self.of_slot[slots.transpose(1, 0, 2)]
        ids = self.symbols[out.reshape(-1)]
        if self.blocks - 1 in chosen and blocks is None and mark == 0:
            return ids[: self.count]
        return ids
