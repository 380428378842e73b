"""The audit of sources against counting in plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from reviewrank.llm import divergence as di

from .cases import ODD

DOCS = "doc_id bigint, text string, lang string, source string, term string, n bigint, p int, value int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, 2, 3) for r in rows], DOCS)


def expected(rows, least):
    groups, documents = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        groups[lang, source].update(found)
        documents[lang].update(set(found))
    out = []
    for (lang, source), own in groups.items():
        kept = sorted(t for t, n in documents[lang].items() if n >= least)
        sums = {s: c for (l, s), c in groups.items() if l == lang}
        whole = sum(sums.values(), Counter())
        share = lambda c, t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept))
        pairs = [(s, sum(abs(share(own, t) - share(c, t)) for t in kept)) for s, c in sums.items() if s != source]
        terms = [(t, share(own, t) - share(whole, t)) for t in kept if own[t] and share(own, t) > share(whole, t)]
        for part, found in (("pair", pairs), ("term", terms)):
            ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(ranked) if part == "pair" or i < 50]
    return sorted(out)


def made(n, seed):
    rng = random.Random(seed)
    stock = [f"w{chr(97 + i)}{'é' * (i % 3)}" for i in range(26)] + [f"x{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9)]
    texts = [" ".join(rng.choice(stock[: rng.randint(2, len(stock))]).upper() for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return [(i, t, rng.choice(["en", "fr", "en", None, "a\x01b"]), rng.choice(["s0"] * 4 + ["s1", "é", None, "S2", "z\x01"])) for i, t in enumerate(texts)]


ROWS = [*made(300, 1), *[(900 + i, t, "odd", "s") for i, t in enumerate(ODD)], (990, "12 34", "en", "empty source"), (991, "one", "rare", "a"), (992, "two", "rare", "b")]
ROWS += [(0, "again ÀÉ ß [x_y`z{q", "en", "s0")] * 9


@pytest.mark.parametrize("most", [di.MOST_TERMS, 0])
def test_audit(spark, most):
    """Through sparse vectors, and through tables as for a vocabulary of any size."""
    got = sorted(tuple(r) for r in di.audit(table(spark, ROWS).repartition(5), least_documents=6, most_terms=most).collect())
    assert got == expected(ROWS, 6)
    assert {r[4] for r in got if r[0] == "rare"} == {0}


@pytest.mark.parametrize("most", [di.MOST_TERMS, 0])
def test_nothing_to_count(spark, most):
    assert di.audit(table(spark, []), most_terms=most).collect() == []
    none = [(1, None, None, None), (2, "", "en", "a"), (3, "..", "en", "b")]
    got = sorted(tuple(r) for r in di.audit(table(spark, none), most_terms=most).collect())
    assert got == expected(none, 30) and len(got) == 2


def test_large_counts(spark):
    """Products beyond 64 bits stay exact."""
    from pyspark.sql import functions as F

    n, total, kept = 3 * 10**13 + 7, 9 * 10**13 + 1, 123_457
    row = spark.range(1).select(di._share(F.lit(n), F.lit(total), F.lit(kept).cast("long"))).first()
    assert row[0] == 1 + 10**9 * (n + 5) // (total + 5 * kept)


def test_all_bytes_part_terms_as_the_pattern_does(spark):
    text = "".join(map(chr, range(1, 256))) + "aZ\u20ac\U0001f600\x85B\u2028c"
    clean = spark.createDataFrame([(text, "l", "s")], "text string, lang string, source string")
    row = di.led_terms(clean).first()
    found = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)))
    assert dict(zip(row["terms"], row["counts"])) == {f"l\x01{t}": n for t, n in found.items()}


@pytest.mark.parametrize("at_once", [1, 40, di.WORDS_AT_ONCE])
def test_a_task_hands_on_sums(spark, at_once):
    """One sum per term and group, and a term in as many lists as it has documents there, up to the least number."""
    rows = [(f"The word é the w{i} {'x ' * (i % 3)}1", "l", "s" if i % 4 else "") for i in range(100)] + [("", "l", "none")]
    clean = spark.createDataFrame(rows, "text string, lang string, source string").coalesce(1)
    table = di.led_terms(clean, 30, words_at_once=at_once).collect()
    sums, lists = Counter(), Counter()
    for r in table:
        assert (r["once"] is None) != (r["source"] is None) and r["lang"] == "l"
        assert r["once"] is None or len(set(r["once"])) == len(r["once"])
        lists.update(r["once"] or [])
        for t, n in zip(r["terms"] or [], r["counts"] or []):
            sums[r["source"], t] += n
    expected, documents = Counter(), Counter()
    for text, _, source in rows:
        found = re.findall("[a-zé]+", text.lower())
        expected.update((source, f"l\x01{t}") for t in found)
        documents.update(f"l\x01{t}" for t in set(found))
    assert sums == expected and {r["source"] for r in table} == {"s", "", "none", None}
    if at_once < di.WORDS_AT_ONCE:
        assert {t: min(n, 30) for t, n in lists.items()} == {t: min(n, 30) for t, n in documents.items()}
    else:
        assert lists == {t: min(n, 30) for t, n in documents.items()}
        assert len(table) == 3 + 30
