"""Small inputs with everything that is awkward."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(words))


def alike(n: int = 1024) -> tuple[str, str]:
    """Two different words that every polynomial hash modulo 2^64 takes for one another."""
    word = "".join("ab"[i.bit_count() & 1] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


def rows(seed: int = 1, n: int = 120) -> list[tuple]:
    """Texts with shared passages, exact and near copies, periods, empty and very long ones; sources with a hot one and none."""
    rng = random.Random(seed)
    passage, line = prose(rng, 60), "one very common line that ends many a text, of some length, that is longer than a hundred bytes"
    texts: list[str | None] = [None, "", " \n\t ", "a", "ä ö ü", "é" * 300, "ab " * 500, "x" * 5000, prose(rng, 30_000)]
    rest, (one, other) = prose(rng, 19), alike()
    texts += [f"{one} {rest}", f"{other} {rest}", f"{one}\n{other}\n{prose(rng, 25)}"]
    while len(texts) < n:
        kind = rng.random()
        old = rng.choice([t for t in texts if t and 20 < len(t) < 9000])
        if kind < 0.15:
            texts.append(old)
        elif kind < 0.35:
            words = old.split()
            if len(words) > 30:
                words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
        elif kind < 0.55:
            texts.append(f"{prose(rng, rng.randrange(50))} {passage}\n{prose(rng, 30)}\n{line}")
        else:
            texts.append("\n".join([prose(rng, rng.randrange(1, 200)), line, prose(rng, 8), line][:rng.randrange(1, 5)]))
    out = []
    for i, text in enumerate(texts):
        source = None if i % 11 == 0 else "hot" if i % 2 else f"s{i % 5}"
        out.append((i * 3, text, ("en", "fr", None)[i % 3], source, None if text is None else len(text)))
    return out


def docs(spark, seed: int = 1, n: int = 120):
    return spark.createDataFrame(rows(seed, n), SCHEMA).repartition(5)


def texts_of(some: list[tuple]) -> dict:
    return {r[0]: r[1] for r in some}


def awkward(spark):
    """Null and repeated ids, repeated rows, and columns named as those the operators add."""
    data = [(None, "a b c d e f g", None, None, None), (None, None, "en", "s", 1), (1, None, None, None, None), (1, "", "en", "s", 0),
            (2, "one two three four five six", "en", "s", 3), (2, "one two three four five six", "en", "s", 3),
            (2, "other words in the same document id", "en", None, 3), (3, "one two three four five six", None, "s", 3)]
    frame = spark.createDataFrame(data, SCHEMA)
    extra = ("key", "id", "size", "spans", "score", "kept", "root", "bucket", "n_words", "hash", "predicted", "at")
    return frame.selectExpr("*", *[f"'clash' AS {c}" for c in extra])
