import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from abasto.llm import op11_alignment as alignment
from abasto.llm import tokens
from tests.llm.corpus import corpus, frame

ODD = [
    (900_001, None), (900_002, ""), (900_003, " "), (900_004, "  two  blanks "), (900_005, "a\tb\n\nc\r\n"), (900_006, "▁"),
    (900_007, "a▁b"), (900_008, "<0x41> <s> <unk> </s>"), (900_009, "<|endoftext|>"), (900_010, "é中😀‍\x00\x7f"),
    (900_011, "ﬁ ½ Å"), (900_012, "x" * 300), (900_013, "!?" * 200), (None, "no id"), (900_014, "twice"), (900_014, "twice"),
    (900_014, "other"),
]


def brute(rows):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = {letter: byte for byte, letter in tokens.byte_letters().items()}

    def spans(ids, of):
        found, place = [], 0
        for number in ids:
            size = len(of(number))
            found.append((place, place + size, number))
            place += size
        return found

    def a_bytes(number):
        return bytes(letters[letter] for letter in library.id_to_token(number))

    def b_bytes(number):
        piece = model.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(number) else piece.replace("▁", " ").encode()

    documents = []
    for doc, text in rows:
        a = library.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        wanted = (" " + text).encode() if text else b""
        if b"".join(map(a_bytes, a)) != wanted or b"".join(map(b_bytes, b)) != wanted:
            a, b = [], []
        a_spans, b_spans = spans(a, a_bytes), spans(b, b_bytes)
        links = [(x[2], y[2]) for x in a_spans for y in b_spans if x[0] < y[1] and y[0] < x[1]]
        cuts = sorted({x[1] for x in a_spans} & {y[1] for y in b_spans})
        groups, low = [], 0
        for cut in cuts:
            inside = [",".join(str(n) for s, e, n in side if low <= s and e <= cut) for side in (a_spans, b_spans)]
            groups.append("|".join(inside))
            low = cut
        documents.append((doc, len(a), len(b), groups, links))
    counts = Counter(pair for *_, links in documents for pair in set(links))
    best = {}
    for (a, _), count in counts.items():
        best[a] = max(best.get(a, 0), count)
    return [
        (doc, n_a, n_b, len(groups), len(links), sum(counts[pair] == best[pair[0]] for pair in links),
         sum(counts[pair] for pair in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for doc, n_a, n_b, groups, links in documents
    ]


def order(rows):
    return sorted(rows, key=lambda row: (row[0] or 0, *row[1:]))


def test_alignment_is_that_of_all_pairs_of_tokens(spark):
    rows = [*corpus(11, 30), *ODD]
    found = alignment.align(frame(spark, rows), size=2_000)  # many slices
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    wanted = brute(rows)
    assert order(map(tuple, found.collect())) == order(wanted)
    assert sum(row[1] > 0 for row in wanted) > len(wanted) - 8  # few of the odd texts have no tokens


def test_slices_do_not_matter(spark):
    rows = [*corpus(12, 20), *ODD]
    one, many = (order(map(tuple, alignment.align(frame(spark, rows), size=size).collect())) for size in (1 << 20, 1))
    assert one == many


def test_no_rows(spark):
    assert alignment.align(frame(spark, []).limit(0)).collect() == []
    only_null = alignment.align(frame(spark, [(1, None), (2, "")])).collect()
    assert [tuple(row) for row in sorted(only_null)] == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_long_texts_are_cut_where_no_piece_reaches(monkeypatch):
    encoder = tokens.PieceEncoder(public_tokenizers.path("piece_bpe_32k.model"))
    assert encoder.cuttable
    text = "  \n ".join(text or "" for _, text in corpus(13, 40))
    whole = encoder.encode([text])
    monkeypatch.setattr(tokens.PieceEncoder, "LONG", 50)
    assert encoder.encode([text]) == whole and len(encoder._parts(text)) > 20


def test_words_are_encoded_as_in_their_texts():
    coders = [alignment.Coder(None, False), alignment.Coder(None, True)]
    rng = random.Random(5)
    parts = [" ", " ", " ", "  ", "\n", "\t", "a", "B", "é", "1", "'s", "'", "!", "　", "\xa0", "\x1c", "​", "中", "x.", "▁", "<s>", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(20_000)]
    for start in range(0, len(texts), 50):
        some = texts[start : start + 50]
        encoded = alignment.encode_slice(some, coders)
        for coder, other, (ids, counts) in zip(coders, coders[::-1], encoded, strict=True):
            for text, found in zip(some, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
                whole = coder.whole(text) if text and len(other.whole(text)) else []
                assert found.tolist() == list(whole), repr(text)


def side(ids, lengths):
    counts = np.array(list(map(len, ids)))
    return alignment.Side(np.concatenate(ids).astype(np.int64), counts, lengths)


def test_every_overlap_is_found_once():
    rng = np.random.default_rng(3)
    for _ in range(200):
        lengths = np.arange(10)
        cut = [rng.integers(1, 9, rng.integers(0, 12)) for _ in range(3)]
        a = side(cut, lengths)
        b_ids = []
        for ids in cut:
            left, found = int(ids.sum()), []
            while left:
                found.append(int(rng.integers(1, min(left, 9) + 1)))
                left -= found[-1]
            b_ids.append(np.array(found, dtype=np.int64))
        b = side(b_ids, lengths)
        got = list(zip(*map(np.ndarray.tolist, alignment.overlaps(a, b)), strict=True))
        wanted = [
            (i, j)
            for i in range(len(a.ids))
            for j in range(len(b.ids))
            if a.docs[i] == b.docs[j] and a.starts[i] < b.ends[j] and b.starts[j] < a.ends[i]
        ]
        assert sorted(got) == wanted
