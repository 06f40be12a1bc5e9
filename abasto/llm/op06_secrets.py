"""Secret scan: three patterns, and sliding-window entropy over candidate strings.

Kinds, in order: ``assign``, ``access``, ``hex`` (see the fixed patterns), ``entropy``. The last one looks at candidate
strings of at least ``WINDOW`` characters. In every run of one character class a window slides with incremental counts;
where its Shannon entropy reaches the class's bound, its characters are part of a span, and spans that touch are one.
Strings on the allow-list (identifiers in UUID form, host and path of links, runs of few or consecutive characters, words
that mark samples) and spans inside a span of the patterns are left out.

Places are code points, ends exclusive. Null text: empty. Any ``doc_id`` is handed on, repeated rows too. Empty table: no
rows. Other columns are not read by ``scan``; ``redact`` keeps them.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abasto.llm.common import prepare

# The patterns and the least lengths of what they find.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # the longest run from its start: as good as the shorter pattern and a check
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST = 12
_HINTS = ("passw", "secret", "token", "api")

KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
# Each class: its characters, and the entropy in bits that a window of ordinary text does not reach.
CLASSES = (
    (re.compile(r"[0-9a-fA-F]{20,}"), 2.9),
    (re.compile(r"[A-Za-z0-9]{20,}"), 3.6),
    (re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 3.8),
)
ALLOWED = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
# Words of samples: one that stands on its own clears itself only, one inside other characters the value around it.
SAMPLES = "example|sample|placeholder|dummy|changeme|your"
SAMPLE = re.compile(SAMPLES, re.IGNORECASE)
OWN = re.compile(f"(?<![A-Za-z0-9+])(?:[a-z]*(?:{SAMPLES})[a-z]*)(?![A-Za-z0-9+])", re.IGNORECASE)
# A link behind its scheme: to the first character that no link holds as such, and therein user, host with path.
LINK = re.compile(r"""://[^\s"'`<>(){}\[\]|\\^,;]*""")
_PLACE = re.compile(r"://([^/?#&@]*(?:@[^/?#&@]*)*@)?[^?#&]*")
_PART = [0.0, *(count * math.log2(count) for count in range(1, WINDOW + 1))]


def window_spans(text: str, bound: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Touching windows whose entropy reaches the bound, as spans. Counts change by one character in and one out."""
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    for place, char in enumerate(text):
        count = counts.get(char, 0)
        counts[char] = count + 1
        total += _PART[count + 1] - _PART[count]
        if place >= window - 1:
            if math.log2(window) - total / window >= bound:
                start = place - window + 1
                if spans and start <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], place + 1)
                else:
                    spans.append((start, place + 1))
            old = text[place - window + 1]
            count = counts[old]
            counts[old] = count - 1
            total += _PART[count - 1] - _PART[count]
    return spans


def link_places(text: str) -> Iterator[tuple[int, int]]:
    """Host and path of every link, in order. User names, passwords, queries and fragments may hold secrets."""
    if "://" in text:
        for link in LINK.finditer(text):
            place = _PLACE.match(text, link.start(), link.end())
            yield (place.start() if place[1] is None else place.end(1)), place.end()


def values_of(candidate: str) -> Iterator[tuple[int, str]]:
    """What of a candidate has to be tested, with its place: without the words of samples, and the values that hold one."""
    if not SAMPLE.search(candidate):
        yield 0, candidate
        return
    bare = OWN.sub(lambda word: "." * len(word[0]), candidate)
    for value in re.finditer(r"[^=.]+", bare):
        if len(value[0]) >= WINDOW and not SAMPLE.search(value[0]):
            yield value.start(), value[0]


def allowed(candidate: str) -> bool:
    """Whether a value is no secret for sure, whatever stands around it."""
    steps = sum(abs(ord(b) - ord(a)) <= 1 for a, b in zip(candidate, candidate[1:], strict=False))
    return (
        len(set(candidate)) < 8
        or 2 * steps > len(candidate)
        or not (re.search("[0-9]", candidate) and re.search("[A-Za-z]", candidate))
    )


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three patterns."""
    found = []
    if "=" in text or ":" in text:
        low = text.lower()
        if any(hint in low for hint in _HINTS):
            found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def entropy_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what only the entropy shows."""
    spans: list[tuple[int, int]] = []
    places = link_places(text)
    place = next(places, None)
    for candidate in CANDIDATE.finditer(text):
        start = candidate.start()
        while place and place[1] <= start:
            place = next(places, None)
        if candidate[0].isalpha() or (place and place[0] <= start and candidate.end() <= place[1]):
            continue
        if ALLOWED.fullmatch(candidate[0]):
            continue
        for shift, value in values_of(candidate[0]):
            for kind, bound in CLASSES if not allowed(value) else ():
                for run in kind.finditer(value):
                    at = start + shift + run.start()
                    spans += [(at + a, at + b) for a, b in window_spans(run[0], bound)]
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return [(a, 3, b) for a, b in merged if not any(start <= a and b <= end for start, _, end in base)]


def scan_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to counts and spans."""
    for batch in batches:
        counts: tuple[list[int], ...] = ([], [], [], [])
        sums, spans = [], []
        for value in batch.column(1):
            text = value.as_py() or ""
            base = base_spans(text)
            every = sorted(base + entropy_spans(text, base))
            for kind, column in enumerate(counts):
                column.append(sum(span[1] == kind for span in every))
            shown = ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in base)
            sums.append(hashlib.sha256(shown.encode()).hexdigest())
            spans.append(",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in every))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(column, pa.int64()) for column in counts), pa.array(sums), pa.array(spans)],
            ["doc_id", "n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans"],
        )


def redact_rows(mark: str):
    """(text, row) to (text without secrets, row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for value in batch.column(0):
                text = value.as_py()
                base = base_spans(text or "")
                last, pieces = 0, []
                for start, _, end in sorted(base + entropy_spans(text or "", base)):
                    if start >= last:
                        pieces += [text[last:start], mark]
                    last = max(last, end)
                texts.append(text if not last else "".join([*pieces, text[last:]]))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column(1)], ["clean", "row"])

    return run


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, counts by kind, the sum of the patterns' spans, all spans."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_entropy bigint, base_sha256 string, spans string"
    return texts.mapInArrow(scan_rows, schema)


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The documents with every span in ``text`` replaced by a mark; ``n_chars`` follows where there is such a column."""
    prepare(docs.sparkSession)
    packed = docs.select(F.col("text").cast("string").alias("clean"), F.struct("*").alias("row"))
    done = packed.mapInArrow(redact_rows(mark), packed.schema)
    changed = {"text": F.col("clean"), "n_chars": F.when(F.col("clean").isNull(), F.col("row.n_chars") if "n_chars" in docs.columns else None).otherwise(F.length("clean").cast("bigint"))}
    return done.select(*(changed.get(name, F.col(f"row.`{name}`")).alias(name) for name in docs.columns))
