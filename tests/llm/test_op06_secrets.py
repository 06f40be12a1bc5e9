import hashlib
import math
import random
import re
from collections import Counter

from abasto.llm import op06_secrets as op
from tests.llm.corpus import frame

PATTERNS = [
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
]


def base(text):
    found = []
    for order, (kind, pattern, group, least) in enumerate(PATTERNS):
        found += [(m.start(), order, m.end(), kind) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found))


def texts(seed):
    rng = random.Random(seed)
    parts = ["token", "Secret", "API_KEY", "apikey", "passwd", '"', "'", " ", "  ", ":", "=", "\n", "AKIA", "akia", "é", "K", "ſ",
             "deadbeef", "0123456789abcdef", "A1B2C3D4E5F6G7", "word", ".", "-", "x" * 13, "token=secret: "]
    for _ in range(1500):
        yield "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))


def test_base_spans_against_the_patterns(spark):
    rows = list(enumerate(texts(1)))
    found = {r.doc_id: r for r in op.scan(frame(spark, rows)).collect()}
    assert len(found) == len(rows)
    for doc, text in rows:
        wanted = base(text)
        kinds = Counter(span.split(":")[0] for span in wanted.split(",") if span)
        row = found[doc]
        assert row.base_sha256 == hashlib.sha256(wanted.encode()).hexdigest(), text
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(kinds[kind] for kind, *_ in PATTERNS)
        assert [s for s in row.spans.split(",") if s and not s.startswith("entropy")] == [s for s in wanted.split(",") if s]


def test_window_entropy_against_counting():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("abcdef0123456789"[: rng.randint(2, 16)]) for _ in range(rng.randint(1, 70)))
        wanted = []
        for start in range(len(text) - op.WINDOW + 1):
            counts = Counter(text[start : start + op.WINDOW])
            bits = -sum(n / op.WINDOW * math.log2(n / op.WINDOW) for n in counts.values())
            if bits >= 3.0 + 1e-9:
                if wanted and start <= wanted[-1][1]:
                    wanted[-1] = (wanted[-1][0], start + op.WINDOW)
                else:
                    wanted.append((start, start + op.WINDOW))
        assert op.window_spans(text, 3.0 + 1e-9) == wanted


def spans(text):
    own = op.base_spans(text)
    return [text[a:b] for a, _, b in op.entropy_spans(text, own)]


def test_what_entropy_adds_and_what_is_allowed():
    secret = "sK9xQ2mP7vL4tR8wZ1nB6cY3"
    assert spans(f"use {secret} now") == [secret]
    for text in (
        "queelleaiierelletionelle onthtionwhonattionnd", "550e8400-e29b-41d4-a716-446655440000",
        f"https://host/{secret}", "example" + secret, "a1" * 20, "abcdefghijklmnopqrstuvwxyz0123456789",
        f"token={secret}",
    ):
        assert spans(text) == []


def test_words_of_samples_clear_themselves_only():
    secret = "sK9xQ2mP7vL4tR8wZ1nB6cY3"
    for text in (f"example_key={secret}", f"path/sample/{secret}", f"{secret}/placeholder", f"your-{secret}", f"a=sample=dummy={secret}"):
        found = spans(text)
        assert len(found) == 1 and secret in found[0], text
    for text in (f"{secret}EXAMPLEKEY", f"key={secret[:12]}changeme{secret[12:]}", "path/sample/example_key=changeme-placeholder/dummy1"):
        assert spans(text) == [], text


def test_links_end_where_no_link_goes_on():
    secret, path = "sK9xQ2mP7vL4tR8wZ1nB6cY3", "pQ7zT3vX9mK2rL8wB5nD1cF6"
    for text in (
        f'{{"url":"https://a.b","key":"{secret}"}}', f"https://a.b,{secret}", f"jdbc:x://host;key:{secret}", f"(http://a.b){secret}",
        f"https://a.b/c?k={secret}", f"https://a.b/{path}?{secret}", f"https://a.b/{path}#{secret}", f"https://a.b&{secret}",
        f"https://{secret}@a.b/{path}", f"https://user:{secret}@a.b/{path}", f"https://u:{secret}@x@a.b/{path}",
    ):
        found = spans(text)
        assert len(found) == 1 and secret in found[0], text
    for text in (f"https://a.b/{path}", f"https://a.b/{'c.' * 400}/{path}", f"see=https://a.b/@c/{path}.html", f"//x https://{path}/"):
        assert spans(text) == [], text


def test_redact_and_odd_rows(spark):
    rows = [(None, "token=abcdefabcdef12"), (4, "a deadbeefdeadbeef12 b"), (4, "clean"), (5, None), (6, "")]
    df = frame(spark, rows).drop("n_chars").selectExpr("*", "CAST(length(text) AS bigint) AS n_chars", "1 AS clean", "2 AS row")
    found = op.redact(df)
    assert found.columns == df.columns
    got = sorted(((r.doc_id or 0, r.text, r.n_chars) for r in found.collect()), key=str)
    assert got == sorted(
        [(0, "[secret]", 8), (4, "a [secret] b", 12), (4, "clean", 5), (5, None, None), (6, "", 0)], key=str
    )
    assert len(op.scan(df).collect()) == 5
    assert op.scan(df.limit(0)).collect() == [] and op.redact(df.limit(0)).collect() == []


def test_long_text():
    text = "word " * 200_000 + "AKIA" + "Z9" * 20
    assert op.base_spans(text) == [(1_000_000, 1, 1_000_044)]
