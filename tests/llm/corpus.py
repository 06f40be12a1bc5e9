"""Small corpora with copies, near copies, shared passages and odd rows."""

from __future__ import annotations

import random

WORDS = [a + b for a in ("an", "the", "or", "in", "ti", "é", "wh", "ea") for b in ("", "re", "st", "on", "ha", "ë")]


def prose(rng: random.Random, count: int) -> list[str]:
    return [rng.choice(WORDS) + rng.choice(WORDS) + rng.choice(["", ",", "."]) for _ in range(count)]


def corpus(seed: int = 0, size: int = 60) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    passages = [prose(rng, count) for count in (12, 20, 25, 55)]
    texts: list[str | None] = []
    for _ in range(size):
        kind = rng.random()
        if kind < 0.2 and texts:
            texts.append(rng.choice(texts))
        elif kind < 0.5 and texts:
            words = (rng.choice(texts) or "x y z").split(" ")
            for _ in range(rng.randint(1, 4)):
                at = rng.randrange(len(words))
                words[at : at + rng.randint(0, 1)] = prose(rng, 1)
            texts.append(" ".join(words))
        else:
            words = prose(rng, rng.choice([1, 3, 5, 8, 30, 80, 200]))
            for passage in rng.sample(passages, rng.randint(0, 2)):
                at = rng.randrange(len(words) + 1)
                words[at:at] = passage
            texts.append(rng.choice([" ", "  ", "\n", "\t"]).join(words))
    hot = prose(rng, 70)
    texts += [" ".join(hot)] * 12
    for _ in range(25):
        words = list(hot)
        words[rng.randrange(len(words))] = rng.choice(WORDS)
        texts.append(" ".join(words))
    loop = prose(rng, 4) * 30
    texts += [" ".join(loop), " ".join(loop[1:]), None, "", " \n ", "a", "A", "one two", "ONE  two", "x y z\x0bw"]
    ids = rng.sample(range(10 * len(texts)), len(texts))
    rows = list(zip(ids, texts, strict=True))
    rng.shuffle(rows)
    return rows


ODD = "lang string, source string, n_chars bigint, seed bigint, sid bigint, key bigint, place int, data binary"


def frame(spark, rows, extra: bool = True):
    """Rows as a table, by default with more columns whose names the operators use themselves."""
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    if extra:
        for part in ODD.split(", "):
            name, kind = part.split(" ")
            docs = docs.selectExpr("*", f"CAST(NULL AS {kind}) AS {name}")
    return docs
