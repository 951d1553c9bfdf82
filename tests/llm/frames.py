"""Small awkward inputs shared by the llm tests."""

from __future__ import annotations

import random

LONG = 30_000


def prose(seed: int, n: int, vocabulary: int = 4000) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(spark, extra: bool = True):
    """Nulls in every column, empty and very long texts, exact and near
    copies, shared passages, repeated rows, and columns with clashing names."""
    passage = prose(1, 70)
    near = prose(2, 200).split()
    near2 = list(near)
    near2[100] = "changed"
    rows = [
        (0, prose(10, 120) + " " + passage, "en", "a"),
        (1, passage + " " + prose(11, 60), "en", "a"),
        (2, prose(12, 30) + "\n" + passage.upper(), "de", "a"),
        (3, " ".join(near), "en", "b"),
        (4, " ".join(near2), "en", "b"),
        (5, " ".join(near), "en", "b"),
        (6, "", "en", "b"),
        (7, None, "en", "b"),
        (8, " \t\n ", None, None),
        (9, "one two", "fr", "c"),
        (10, "One TWO", None, "c"),
        (11, prose(13, LONG) + " " + passage, "en", None),
        (None, passage, "en", "a"),
        (12, prose(14, 49), "en", "c"),
        (13, prose(14, 50), "en", "c"),
        (14, prose(14, 50) + " tail", "en", "c"),
        (14, prose(14, 50) + " tail", "en", "c"),
        (15, "é É ñandú x ça,va! <|endoftext|> it's", "es", "c"),
        (16, " ".join(["same"] * 300), "en", "c"),
        (17, " ".join(["same"] * 120), "en", "c"),
    ]
    schema = "doc_id long, text string, lang string, source string"
    if not extra:
        return spark.createDataFrame(rows, schema)
    rows = [(*r, len(r[1] or ""), "x", i, [i]) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, schema + ", n_chars int, hits string, n_words int, score array<int>")


def many(spark, n: int = 300, partitions: int = 4):
    """Copies, near copies and passages in bulk, over several partitions."""
    rng = random.Random(5)
    base = prose(50, 120).split()
    shared = prose(51, 60)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = f"v{rng.randrange(10**6)}"
            rows.append((i, " ".join(w)))
        elif i % 3 == 1:
            rows.append((i, prose(100 + i, rng.randrange(1, 150))))
        else:
            rows.append((i, prose(200 + i % 20, 40) + "\n" + shared + " " + prose(1000 + i, 20)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
