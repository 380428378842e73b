"""Small tables with the cases that every operator must define."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, words string, fp string, row string, start int, end int"


def words(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    parts = ["the", "of", "an", "er", "on", "st", "ing", "tion", "ble", "re"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n)]


def docs(spark, texts, lang="en"):
    """Documents 0, 1, …, with further columns whose names the operators use themselves."""
    rows = [(i, t, lang, "src0", None if t is None else len(t), "w", "f", "r", 7, 8) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


ODD = [None, "", " \n\t ", "a", "a b", "é ß 日本", "x y \x1c z", "same same", "same same", "a" * 300_000, "ab " * 40_000]
