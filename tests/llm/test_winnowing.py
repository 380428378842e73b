"""Winnowing against choosing in every window, one after the other."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from reviewrank.llm import winnowing as wi

from .cases import ODD, docs, words


def chosen(text, gram=wi.GRAM, window=wi.WINDOW):
    """(hash, position) of the smallest of each window, the rightmost of equal ones."""
    symbols = [w[i : i + wi.SYMBOL] for w in re.findall(r"[^\x20\x09-\x0D]+", text) for i in range(0, len(w), wi.SYMBOL)]
    hashes = []
    for i in range(max(1, len(symbols) - gram + 1) if symbols else 0):
        h = 42
        for s in symbols[i : i + gram]:
            h = xxhash.xxh64_intdigest(s.encode(), seed=h)
        hashes.append((h - (1 << 64) if h >> 63 else h) >> wi.PLACE_BITS)
    out = []
    for start in range(max(1, len(hashes) - window + 1) if hashes else 0):
        place = min(range(start, min(start + window, len(hashes))), key=lambda i: (hashes[i], -i))
        if not out or out[-1][1] != place:
            out.append((hashes[place], place))
    return out


def shown(text):
    return " ".join(f"{h & ((1 << 64 - wi.PLACE_BITS) - 1):x}@{p}" for h, p in chosen(text))


TEXTS = [t for t in ODD if t is None or len(t) < 10_000] + [
    "a" * 1500, "ab " * 700, "é😀" * 400, "x" * wi.SYMBOL, "y" * (wi.SYMBOL + 1), "same " * 90, "\n" * 700, "one two three four five",
    " ".join(words(1, 400)), " ".join(words(2, 90)), " ".join(words(2, 90)), "0123456789" * 160, "a b c d e f g h i j k l",
]


def test_fingerprints(spark):
    rng = random.Random(5)
    texts = [*TEXTS, *["".join(rng.choice("ab \U0001f600") for _ in range(n)) for n in range(0, 60, 3)]]
    got = {r["doc_id"]: r for r in wi.fingerprints(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        assert got[i]["fingerprint"] == shown(t or ""), (i, (t or "")[:40])
        assert set(got[i]["hashes"]) == {h for h, _ in chosen(t or "")} and len(got[i]["hashes"]) == len(set(got[i]["hashes"]))
        assert got[i]["row"] == "r"
    assert wi.fingerprints(docs(spark, [])).collect() == []


def test_match_guarantee(spark):
    run = wi.GRAM + wi.WINDOW - 1
    for seed in range(5):
        shared = [w[: wi.SYMBOL] for w in words(seed, run)]
        texts = [" ".join(words(seed + 10, 80) + shared), "\n".join(["z"] + shared + words(seed + 20, 200)), " ".join(words(seed + 30, 200))]
        sets = {r["doc_id"]: set(r["hashes"]) for r in wi.fingerprints(docs(spark, texts)).collect()}
        assert sets[0] & sets[1]


def test_long_text(spark):
    text = " ".join(words(8, 150_000))
    row = wi.fingerprints(docs(spark, [text])).select("fingerprint").first()
    assert row["fingerprint"] == shown(text)


def test_edited_texts(spark):
    table = docs(spark, [*TEXTS, " ".join(words(3, 500))])
    texts = [t or "" for t in [*TEXTS, " ".join(words(3, 500))]]
    got = {r["doc_id"]: r for r in wi.edited_texts(table).collect()}
    assert len(got) == len(texts)
    order = list(range(len(texts)))[::-1]
    for i, k in enumerate(order):
        text, following = texts[k], texts[order[(i + 1) % len(order)]]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        a, b, c = ({h for h, _ in chosen(t)} for t in (text, edited, following))
        like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        r = got[k]
        assert (r["n_chars"], r["fingerprint"], r["edited_fingerprint"]) == (len(text), shown(text), shown(edited))
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["near_edited"], r["near_next"]) == pytest.approx((like(a, b), like(a, c)))


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_next_rows(spark, kind):
    """Ids of any type, repeated and null ones, over several buckets."""
    rng = random.Random(1)
    ids = [*range(0, 300, 3), *[7] * 30, None, None]
    rng.shuffle(ids)
    rows = [(i, f"t{k}") for k, i in enumerate(ids)] + [(50, "twin"), (50, "twin")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    got = wi.beside_next(table.repartition(5), {"size": F.length("text")}, ["text", "doc_id", "size"]).collect()
    assert sorted((r["text"] for r in got)) == sorted(t for _, t in rows)
    assert sorted(r["next_text"] for r in got) == sorted(t for _, t in rows)  # a circle through all rows
    assert all(r["next_size"] == len(r["next_text"]) for r in got)
    rank = {k: i for i, k in enumerate(sorted({r["doc_id"] for r in got if r["doc_id"] is not None}, reverse=True))}
    place = lambda k: rank.get(k, len(rank))
    steps = [place(r["next_doc_id"]) - place(r["doc_id"]) for r in got]
    assert sorted(steps)[0] == -len(rank) and steps.count(-len(rank)) == 1 and all(s in (0, 1) for s in steps if s >= 0) and sum(s < 0 for s in steps) == 1
    assert wi.beside_next(table.limit(0), {}, ["text"]).collect() == []
    one = wi.beside_next(table.limit(1), {}, ["text"]).first()
    assert one["next_text"] == one["text"]
