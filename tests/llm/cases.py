"""Documents that every operator must take: nulls, empty and long texts, ties,
repeated rows, and extra columns whose names clash with internal ones."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "size long, score double, key string, found string, kind string, copy int, n long"
)


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    out = []
    for _ in range(words):
        out.append("w" + "".join(rng.choice("abcdefgh") for _ in range(2)) + str(rng.randrange(vocabulary) % 7 or "") + rng.choice(["", "", "", ","]))
    return " ".join(out)


def rows(extra: list[str] = (), seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    texts = [None, "", " ", "one", "two words", "\n\t", "héllo wörld ünï 💡 code", "x" * 3000, prose(rng, 40), prose(rng, 900), prose(rng, 12000)]
    texts += list(extra)
    found = [(i, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    found += [found[8], found[8], (None, texts[8], None, None, None), (None, None, None, None, None), (9, "another text under id nine", "en", "s1", 5)]
    return [f + (7, 0.5, "k", "f", "kind", 2, 1) for f in found]


def frame(spark, extra: list[str] = (), seed: int = 3):
    return spark.createDataFrame(rows(extra, seed), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
