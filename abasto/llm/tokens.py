"""Token ids of public vocabularies.

``Encoder`` reads a vocabulary file of the tokenizers library. Where the file is a plain byte-level BPE (ids in the order
of the merges, the usual splitting rule, no normalizer), tiktoken does the merging, which takes a fifth of the library's
time; any other file is left to the library. Ids are those of the library either way (tests compare them, on every code
point among others).

``PieceEncoder`` reads a sentencepiece model.
"""

from __future__ import annotations

import json
import re
import threading

import numpy as np
import public_tokenizers
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"

# Fixed value: the splitting rule of byte-level vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = "▁"  # stands for a blank in sentencepiece vocabularies


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary: itself if it prints, else one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {byte: chr(byte) for byte in prints}
    for byte in range(256):
        letters.setdefault(byte, chr(256 + len(letters) - len(prints)))
    return letters


def _ranks(path: str, added: set[str]) -> dict[bytes, int] | None:
    """The bytes of every entry, if the file is a byte-level BPE whose ids go up with the merges."""
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    model, cut = found["model"], found["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not any(
        model.get(name) for name in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    )
    usual = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    if not plain or not usual or found["normalizer"]:
        return None
    vocabulary = {text: number for text, number in model["vocab"].items() if text not in added}
    merged = [vocabulary.get("".join(merge if isinstance(merge, list) else merge.split(" ")), -1) for merge in model["merges"]]
    bytes_of = {letter: byte for byte, letter in byte_letters().items()}
    known = set(vocabulary) <= {*bytes_of} | {text for text in vocabulary if len(text) > 1}
    rising = all(a < b for a, b in zip(merged, merged[1:], strict=False))
    if not known or not rising or len(vocabulary) != len(merged) + 256 or min(merged, default=256) < 256:
        return None
    return {bytes(bytes_of[letter] for letter in text): number for text, number in vocabulary.items()}


class Encoder:
    """Ids of whole texts. ``encode`` recognises the vocabulary's added tokens, as the library does by default;
    ``encode_plain`` takes their strings as ordinary text."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        added = self.library.get_added_tokens_decoder()
        odd = any(token.single_word or token.lstrip or token.rstrip or token.normalized for token in added.values())
        ranks = None if odd else _ranks(path, {token.content for token in added.values()})
        self.fast = None
        if ranks is not None:
            special = {token.content: number for number, token in added.items()}
            self.fast = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
        else:
            self.plain_library = Tokenizer.from_file(path)
            self.plain_library.encode_special_tokens = True

    def encode(self, text: str) -> np.ndarray:
        if self.fast is not None:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def encode_plain(self, text: str) -> np.ndarray:
        if self.fast is not None:
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.plain_library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def entries(self) -> list[bytes]:
        """The bytes of every id of a byte-level vocabulary."""
        bytes_of = {letter: byte for byte, letter in byte_letters().items()}
        found = [b""] * self.library.get_vocab_size()
        added = {token.content for token in self.library.get_added_tokens_decoder().values()}
        for text, number in self.library.get_vocab().items():
            found[number] = text.encode() if text in added else bytes(bytes_of[letter] for letter in text)
        return found


class PieceEncoder:
    """Ids of whole texts by a sentencepiece model, which puts a blank before each."""

    LONG = 1 << 20  # characters from which a text is cut before it is encoded, to bound the model's working memory
    _BETWEEN = re.compile(f"(?<=[^\\s{SPACE}]) (?=[^\\s{SPACE}])")

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(number) for number in range(self.model.get_piece_size())]
        # No piece joins a blank to what stands before it: a text can be cut before single blanks, and each part gets its
        # blank back from the model.
        self.cuttable = not any(SPACE in piece.lstrip(SPACE) for piece in pieces)

    def _parts(self, text: str) -> list[str]:
        parts, start = [], 0
        while self.cuttable and len(text) - start > self.LONG:
            blank = self._BETWEEN.search(text, start + self.LONG // 2)
            if blank is None:
                break
            parts.append(text[start : blank.start()])
            start = blank.end()
        return [*parts, text[start:]]

    def encode(self, texts: list[str]) -> list[list[int]]:
        if not any(len(text) > self.LONG for text in texts):
            return self.model.encode(texts, num_threads=1)
        found = []
        for text in texts:
            found.append([number for part in self._parts(text) for number in self.model.encode(part)])
        return found

    def entries(self) -> list[bytes]:
        """The bytes of every id: a piece with blanks for their sign, a byte for a piece that names one."""
        found = []
        for number in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(number)
            found.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(number) else piece.replace(SPACE, " ").encode())
        return found


_KEPT: dict[tuple, object] = {}
_LOCK = threading.Lock()


def _kept(kind: type, path: str):
    with _LOCK:
        if (kind, path) not in _KEPT:
            _KEPT[kind, path] = kind(path)
        return _KEPT[kind, path]


def encoder(path: str | None = None) -> Encoder:
    """The worker's encoder for a vocabulary file, by default the public one, read once."""
    return _kept(Encoder, path or public_tokenizers.path(VOCABULARY))


def piece_encoder(path: str | None = None) -> PieceEncoder:
    return _kept(PieceEncoder, path or public_tokenizers.path(PIECES))
