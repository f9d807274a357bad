"""Fixtures shared by the operator tests."""

from __future__ import annotations

import random

# names that the operators use inside, as extra columns with other meanings
CLASHING = ["id", "part", "hash", "norm", "kept", "keep_id", "size", "copies", "n", "cls", "bucket", "key", "salt",
            "position", "line", "host", "w", "spans", "score", "text_sha256", "registers", "digest", "block", "place"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(n))


def documents(spark, rows, clash=True):
    """(doc_id, text[, source]) rows as a documents table, with clashing columns."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if clash:
        for i, c in enumerate(CLASHING):
            df = df.withColumn(c, df["doc_id"] * 0 + i)
    return df


def odd_rows(seed: int = 5):
    """Nulls, empty and very long texts, ties, repeated rows, case variants."""
    rng = random.Random(seed)
    long = words(rng, 20_000)
    base = words(rng, 120)
    lines = [words(rng, 8) for _ in range(6)]
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, long, "big"), (4, long.upper(), "big"), (5, base), (6, base), (6, base),
            (7, base.replace("a", "A")), (8, base.upper(), None), (9, "É" + base), (10, "é" + base), (None, base),
            (None, "alone"), (11, words(rng, 3)), (12, words(rng, 3))]
    rows += [(20 + i, "\n".join([words(rng, 9), *rng.sample(lines, 4), "  " + lines[0].upper() + "\t", "", lines[1]]), f"s{i % 5}")
             for i in range(30)]
    rows += [(60 + i, base + " " + words(rng, 1 + i), "near") for i in range(12)]
    rows += [(80, base + " tail one"), (80, words(rng, 60))]  # an id with two texts
    return rows


def near_like_rows(seed: int = 11):
    """Documents for the pipeline: 100 clean ones, short ones, case copies and
    near copies (ids 500, 501, ... near 500; 600, 601, ... near 600)."""
    rng = random.Random(seed)
    rows = [(i, words(rng, 70), f"s{i % 4}") for i in range(100)]
    rows += [(200 + i, words(rng, 5), "s1") for i in range(10)]
    rows += [(300 + i, rows[i][1].replace("a", "A"), "s2") for i in range(10)]
    rows += [(400, None, "s1"), (401, "", None)]
    for g in (500, 600):
        base = words(rng, 90).split()
        rows += [(g + i, " ".join([*base[:88], f"e{i}"]), "s3") for i in range(8)]
    return rows
