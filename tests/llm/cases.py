"""Small tables with the awkward cases every operator must take."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators use inside
    "id long, n int, spans string, ids string, node long, spot long, score string, piece string, `end` int"
)


def prose(seed: int, words: int, lexicon: int = 400) -> str:
    r = random.Random(seed)
    names = ["".join(random.Random(f"{k}").choices("etaoinshrdlucmf", k=2 + k % 7)) for k in range(lexicon)]
    return " ".join(r.choice(names) for _ in range(words))


def edited(text: str, at: int) -> str:
    words = text.split(" ")
    words[at] = "edited"
    return " ".join(words)


LONG = prose(1, 400)
TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "Two words",
    LONG,
    LONG,
    edited(LONG, 7),
    edited(LONG, 200),
    prose(2, 60) + "\n" + LONG[100:700] + "\n" + prose(3, 40),
    "x" * 3000,
    "ab " * 900,
    prose(4, 6000),
    "Éa ßü 日本語    'quoted' don't",
    'password = "hunter2secret"',
    prose(5, 30),
]


def frame(spark, texts=TEXTS, ids=None):
    rows = [
        (k if ids is None else ids[k], t, "ab"[k % 2] if t else None, None, len(t) if t is not None else None, k, k, "s", None, k, k, "x", None, k)
        for k, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def awkward(spark):
    """Null and repeated ids, repeated rows."""
    ids = [*range(len(TEXTS)), None, None, 5, 5, 3]
    return frame(spark, [*TEXTS, LONG, None, LONG, "other text", "one"], ids)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}
