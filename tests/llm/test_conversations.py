"""Repair of conversations against a search through all edits."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import pytest

from reviewrank.llm import conversations as co

ROWS = "conv_id bigint, turn bigint, role string, text string, copies int, audit string, segment string"
LEGAL = re.compile(r"(s?(ua)+)?")


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], ROWS)


def faults(rows):
    """Rows in order with copies written out, each with its fault."""
    key = lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])
    seen, out = set(), []
    for _, _, role, text, copies in sorted(rows, key=key):
        for _ in range(copies):
            words = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
            seen.add((role, text))
            out.append((role, text, fault))
    return out


def expected(rows):
    """All figures; the edits by trying every way for a few rows, else row by row over role sequences."""
    rows = [(c, t, r if r is not None else " ", x if x is not None else " ", n) for c, t, r, x, n in rows]
    listed = faults(rows)
    turns = {t for _, t, _, _, n in rows if t is not None and n}
    near = [a[0][:1] + b[0][:1] for a, b in zip(listed, listed[1:])]
    head = [max(turns) - min(turns) + 1 - len(turns) if turns else 0]
    head += [sum(f == k for *_, f in listed) for k in ("blank", "duplicate", "truncated")] + [sum(p not in ("su", "ua", "au") for p in near)]
    # cheapest (cost, audit, lines) per prefix of role initials, which are cut to what still matters
    live = {"": (0, "", [])}

    def grow(live, choices):
        new = {}
        for shape, (cost, audit, lines) in live.items():
            for extra, mark, added in choices:
                grown = shape + "".join(a[0][:1] for a in added)
                if any(a[0] == "" for a in added) or not any(LEGAL.fullmatch(grown + end) for end in ("", "a", "ua")):
                    continue
                short = grown if len(grown) < 4 else grown[-2:] if grown[-1] == "a" else grown[-3:]
                got = (cost + extra, audit + mark, lines + added)
                if short not in new or got[:2] < new[short][:2]:
                    new[short] = got
        return new

    empty = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"], ["user", "assistant", "user"]]
    for role, text, fault in listed:
        ways = [(4, "D", [])]
        if fault not in ("blank", "duplicate"):
            extra = 3 * (fault == "truncated")
            ways += [(extra, "K", [(role, text)])] + [(3 + extra, "R", [(r, text)]) for r in ("user", "assistant")]
        choices = [(3 * len(e) + c, "I" * len(e) + m, [(r, "") for r in e] + add) for e, (c, m, add) in itertools.product(empty, ways)]
        live = grow(live, choices)
    live = grow(live, [(3 * len(e), "I" * len(e), [(r, "") for r in e]) for e in empty])
    cost, audit, lines = min((v for shape, v in live.items() if LEGAL.fullmatch(shape)), key=lambda v: v[:2])
    text = "\n".join(f"{r}:{t}" for r, t in lines)
    return (*head, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def made(conv, n, seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["a.", "b!", "c?", "cut", "cut too \n", "", " \t", "long. " * 40, None, "é 日."]
    turns = [*range(n), None]
    return [(conv, rng.choice(turns), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"t{rng.random()}.", rng.choice([0, 1, 1, 1, 2])) for _ in range(n)]


def results(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def test_small_conversations(spark):
    rows = [r for c in range(60) for r in made(c, c % 7, c)]
    rows += [(100, 0, "user", "Hi.", 1), (100, 1, "assistant", "Yes.", 1), (101, 0, "user", "x.", 0), (None, 3, "user", "q?", 1), (None, None, None, None, 1)]
    rows += [(102, 5, "user", "same.", 4), (103, 2**40, "assistant", "a.", 1), (103, -5, "system", "s.", 1)]
    got = results(co.repaired(table(spark, rows)))
    ids = {r[0] for r in rows}
    assert got == {c: expected([r for r in rows if r[0] == c]) for c in ids}
    assert got[101] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[100][4:6] == (0, 0) and got[100][6] == "KK"
    assert results(co.repaired(table(spark, []))) == {}


def test_long_conversations_spread_over_tasks(spark):
    rows = [r for c, n in ((1, 900), (2, 5), (3, 400), (None, 300)) for r in made(c, n, n)]
    for conf in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.adaptive.enabled"):
        spark.conf.set(conf, "false")
    try:
        got = results(co.repaired(table(spark, rows).repartition(3), most_sent=2))
    finally:
        for conf in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.adaptive.enabled"):
            spark.conf.unset(conf)
    assert got == {c: expected([r for r in rows if r[0] == c]) for c in (1, 2, 3, None)}


def test_copies_of_one_row(spark):
    rows = [(1, 0, "user", "again.", 1)] * 5000 + [(1, 1, "assistant", "a.", 1)]
    gaps, blank, duplicate, truncated, illegal, cost, audit, _ = results(co.repaired(table(spark, rows)))[1]
    assert (gaps, blank, duplicate, truncated, illegal, cost) == (0, 0, 4999, 0, 4999, 4 * 4999)
    assert audit == "K" + "D" * 4999 + "K"


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant" if t % 2 else "system", f"One {t}. Two!", 1) for c in range(40) for t in range(6)] + [(None, None, None, None, 1)]
    got = {(r["conv_id"], r["turn"]): (r["role"], r["text"], r["copies"]) for r in co.damaged(table(spark, rows)).collect()}
    for conv, turn, role, text, _ in rows:
        show = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", show(text)) if kind == 2 else show(text)
        assert got[conv, turn] == ("user" if kind == 4 else show(role), text, {0: 0, 3: 2}.get(kind, 1))


def test_other_grammars(spark):
    shifts, ends = co.lr_states(co.GRAMMAR)
    assert len(shifts) == 4 and shifts[0].keys() == {"s", "u"} and 0 in ends
    with pytest.raises(ValueError, match="right-recursive"):
        co.lr_states({"c": ["c u", "u"]})
    only = {"c": ["u a"]}
    rows = table(spark, [(1, 0, "user", "a.", 1), (1, 1, "user", "b.", 1), (2, 0, "system", "x.", 0)])
    got = results(co.repaired(rows, only))
    assert got[1][5:7] == (3, "KR")
