"""Small fixtures: awkward rows, and documents made from a word list by rule."""

from __future__ import annotations

import random

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "ru", "sta", "ver", "zu") for b in ("", "ra", "lin", "do", "mes", "tu")]


def prose(rnd: random.Random, n: int) -> str:
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "", ".", ",", "\n"]).replace("\n", "") for _ in range(n))


def rows(n: int, seed: int = 1) -> list[tuple]:
    """Documents with copies, near copies and a hot source."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        kind = rnd.random()
        if out and kind < 0.15:
            text = rnd.choice(out)[1]
        elif out and kind < 0.35:
            words = rnd.choice(out)[1].split(" ")
            words[rnd.randrange(len(words))] = rnd.choice(WORDS)
            text = " ".join(words)
        else:
            text = prose(rnd, rnd.choice([1, 3, 8, 40, 150, 400]))
        out.append((i, text, "en", "hot" if rnd.random() < 0.4 else f"s{rnd.randrange(5)}", len(text)))
    return out


AWKWARD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", "a", 4), (4, "one", "en", "b", 3),
    (4, "one", "en", "b", 3), (5, "word " * 3000, "en", "b", 15000), (None, "no key", None, "b", 6),
    (None, "no key", None, "b", 6), (6, "naïve 日本 🎉 <|endoftext|>", "xx", None, 20), (7, "one", "en", "c", 3),
    (4, "two", "en", "b", 3), (9, "x" * 5000, "en", "c", 5000),
]
#: names that the operators use inside
CLASHING = ["fp", "n", "size", "slot", "ids", "n_tokens", "score", "t", "h", "src", "root", "bucket", "text_hash",
            "text_sha256", "cell", "shard", "row_key", "__d", "y", "k"]


def awkward(spark):
    """The awkward rows with extra columns whose names clash."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(AWKWARD, DOC_SCHEMA)
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING})


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
