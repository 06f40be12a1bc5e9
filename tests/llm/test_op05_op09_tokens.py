import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from abasto.llm import op05_packing as packing
from abasto.llm import op09_token_files as files
from abasto.llm import rans, tokens
from tests.llm.corpus import corpus, frame


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
    found.encode_special_tokens = True
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_library_s(library):
    encoder = tokens.Encoder(public_tokenizers.path(tokens.VOCABULARY))
    assert encoder.fast is not None
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "B", "é", "1", "'s", "'", "!", "　", "\xa0", "\x1c", "\x85", "​", "中", "ab",
             " a", "\r\n", "́", "᠎", "﻿", " ", ".", ",", "!*", "x.", " 9", "<|endoftext|>", "😀"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert encoder.encode_plain(text).tolist() == library(text), repr(text)
    for _, text in corpus(5):
        assert encoder.encode_plain(text or "").tolist() == library(text)
    for start in range(0, 0x110000, 64):  # every code point, alone, twice and inside a word
        points = [point for point in range(start, start + 64) if not 0xD800 <= point < 0xE000]
        text = "".join(f"a{chr(point)} {chr(point)}{chr(point)}1" for point in points)
        assert encoder.encode_plain(text).tolist() == library(text), hex(start)


def test_other_vocabularies_go_to_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, own = tokens.Encoder(path), Tokenizer.from_file(path)
    assert encoder.fast is None
    for text in ("Hello  World!", "", "été <|endoftext|> x"):
        assert encoder.encode(text).tolist() == own.encode(text, add_special_tokens=False).ids


def test_added_tokens_are_the_library_s(spark, tmp_path):
    default = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
    encoder = tokens.encoder()
    rng = random.Random(7)
    parts = [" ", "  ", "\n", "a", "'s", "!", " a", "<|endoftext|>", "<|endoftext|>", "<|endof", "text|>", "<", "é"]
    for _ in range(5_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 10)))
        wanted = default.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text).tolist() == wanted, repr(text)
    docs = frame(spark, [(1, "a<|endoftext|>b"), (2, "c")])
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in files.round_trip(docs, str(tmp_path / "f")).collect()}
    assert found == {1: (0, 4, crc([64, 50256, 65, files.END])), 2: (4, 2, crc([66, files.END]))}
    assert {r.doc_tokens for r in packing.pack(docs.filter("doc_id = 1")).collect()} == {4}


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_files(spark, library, monkeypatch, tmp_path):
    rows = [*corpus(3), (77_777, "long " * 40_000), (77_778, None)]
    files.write(frame(spark, rows), str(tmp_path / "f"))
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in files.read(spark, str(tmp_path / "f")).collect()}
    start, wanted = 0, {}
    for doc, text in sorted(rows):
        ids = [*library(text), files.END]
        wanted[doc] = (start, len(ids), crc(ids))
        start += len(ids)
    assert got == wanted


def test_many_segments(spark, library):
    rows = corpus(4)
    docs = frame(spark, rows).select("doc_id", "text").repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id")
    segments = docs.mapInArrow(files.encode_partition(size=300), files.SEGMENTS)
    assert segments.count() > 8
    starts = {(r.part, r.segment): r.start for r in files.starts(segments.select("part", "segment", "n_tokens")).collect()}
    total = 0
    for row in sorted(segments.select("part", "segment", "n_tokens").collect()):
        assert starts[row.part, row.segment] == total
        total += row.n_tokens
    assert total == sum(len(library(text)) + 1 for _, text in rows)


def test_files_of_odd_rows(spark, library, tmp_path):
    rows = [(None, "a"), (4, "b"), (4, "b"), (2, "")]
    found = files.round_trip(frame(spark, rows), str(tmp_path / "f")).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in found) == [(0, 2), (2, 1), (4, 2), (4, 2)]
    assert sorted(r.start for r in found) == [0, 2, 3, 5]
    assert files.round_trip(frame(spark, []).limit(0), str(tmp_path / "g")).collect() == []


@pytest.mark.parametrize("count", [1, 2, 127, 129, 5000, 200_000])
def test_coder(count):
    ids = (np.random.default_rng(count).zipf(1.2, count) % 50_257).astype(np.uint32)
    data = rans.encode(ids)
    segment = rans.Segment(data)
    assert (segment.decode() == ids).all()
    marks = len(range(0, segment.steps, segment.every))
    for block, mark in {(0, 0), (segment.blocks - 1, marks - 1), (segment.blocks // 2, marks // 2)}:
        start = (block * segment.steps + mark * segment.every) * segment.lanes
        wanted = ids[start : (block + 1) * segment.steps * segment.lanes]
        assert (segment.decode([block], mark)[: len(wanted)] == wanted).all()
    rng = random.Random(count)
    for _ in range(20):
        broken = bytearray(data)
        broken[rng.randrange(len(broken))] ^= 1 << rng.randrange(8)
        with pytest.raises((rans.Damaged, ValueError)):
            rans.Segment(bytes(broken)).decode()


def test_coder_of_one_symbol_and_of_all():
    for ids in (np.full(3000, 9, np.uint32), np.arange(50_257, dtype=np.uint32)):
        assert (rans.Segment(rans.encode(ids)).decode() == ids).all()
    assert len(rans.encode(np.full(1 << 20, 9, np.uint32))) < 40_000


def best_by_search(capacity, counts):
    sums = {0}
    for length, count in counts.items():
        sums = {s + k * length for s in sums for k in range(count + 1) if s + k * length <= capacity}
    return max(sums)


def test_closest_is_the_best_sum():
    rng = random.Random(2)
    for _ in range(500):
        counts = {rng.randint(1, 60): rng.randint(0, 4) for _ in range(rng.randint(1, 8))}
        capacity = rng.randint(1, 120)
        used = packing.closest(capacity, sorted((n for n in counts if n <= capacity), reverse=True), counts.__getitem__)
        assert all(0 < used[length] <= counts[length] for length in used)
        assert sum(length * count for length, count in used.items()) == best_by_search(capacity, counts)


def test_packing(spark, library):
    rows = [*corpus(6), (77_777, "long text " * 9_000), (77_778, None)]
    found = packing.pack(frame(spark, rows)).collect()
    ids = {doc: [*library(text), packing.END] for doc, text in rows}
    pieces, sequences = {}, {}
    for r in found:
        assert r.doc_tokens == len(ids[r.doc_id]) and r.length > 0
        assert r.ids_crc32 == crc(ids[r.doc_id][r.start : r.start + r.length])
        pieces.setdefault(r.doc_id, []).append((r.start, r.start + r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.offset + r.length))
    assert set(pieces) == set(ids)
    for doc, spans in pieces.items():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] == len(ids[doc])
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    for spans in sequences.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
        size = spans[-1][1]
        assert size <= packing.WINDOW and size & (size - 1) == 0  # full or a power of two: no padding at all


def test_packing_of_odd_rows(spark):
    rows = [(None, "a"), (4, "b"), (4, "b"), (2, "")]
    assert sorted((r.doc_id or 0, r.doc_tokens) for r in packing.pack(frame(spark, rows)).collect() if r.start == 0) == [
        (0, 2), (2, 1), (4, 2), (4, 2),
    ]
    assert packing.pack(frame(spark, []).limit(0)).collect() == []
