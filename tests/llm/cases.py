"""Small corpora with what the operators must bear: nulls, empty and long texts, ties, repeated rows."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Further columns with names the operators use inside.
CLASHING = "doc long, key string, shard string, label string, text2 string, spans string, counts int, words string"


def words(rng: random.Random, n: int, size: int = 4000) -> str:
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def corpus(seed: int = 0, n: int = 60) -> list[tuple]:
    """(doc_id, text): plain texts, exact and near copies, shared passages, and the odd rows."""
    rng = random.Random(seed)
    passage = words(rng, 70)
    base = words(rng, 120)
    texts = []
    for i in range(n):
        kind = i % 6
        text = words(rng, rng.randrange(3, 200))
        if kind == 1 and texts:
            text = rng.choice(texts)
        elif kind == 2:
            cut = base.split(" ")
            for _ in range(rng.randrange(0, 8)):
                cut[rng.randrange(len(cut))] = f"x{rng.randrange(1000)}"
            text = " ".join(cut)
        elif kind == 3:
            text += " " + passage + " " + words(rng, 20)
        elif kind == 4:
            text = "\n".join([text, passage[: rng.randrange(20, 300)], "é ñ 日本 " * rng.randrange(5)])
        texts.append(text)
    rows = [(3 * i + 1, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + [
        (1000, None), (1001, ""), (1002, "   \n\t "), (1003, "one"), (1004, "one two three four"),
        (1005, "ab" * 3000), (1006, words(rng, 6000, 50)), (1007, passage), (1007, passage),
        (None, passage), (1008, "word " * 400), (1009, "ONE two THREE four"),
    ]


def documents(spark, rows: list[tuple], clashing: bool = False):
    full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
    if not clashing:
        return spark.createDataFrame(full, SCHEMA)
    return spark.createDataFrame([(*r, 7, "k", "s", "l", "t", "p", 3, "w") for r in full], f"{SCHEMA}, {CLASHING}")
