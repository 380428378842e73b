"""Near-duplicate vectors, SimHash and components against brute force."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
import xxhash

from reviewrank.llm import vectors
from reviewrank.llm.components import components
from reviewrank.llm.simhash import as_hex, near_fingerprints, one_of_each_group, simhash_groups
from reviewrank.llm.vectors import linked_vectors
from reviewrank.session import written

from .cases import ODD, docs, words


class Roots(dict):
    def root(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self[max(a, b)] = min(a, b)


@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(5)
    links = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(500, i) for i in range(80)] + [(900, 901), (901, 900), (7, 7), (None, 3)],
        "random": [(rng.randrange(120), rng.randrange(120)) for _ in range(90)],
        "none": [],
    }[kind]
    found = components(spark.createDataFrame(links, "x bigint, y bigint"), "x", "y").collect()
    roots = Roots()
    for a, b in links:
        if a is not None and a != b:
            roots.join(a, b)
    assert {r["node"]: r["component"] for r in found} == {x: roots.root(x) for x in list(roots)}
    assert len(found) == len(roots)


def fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_groups(spark):
    base = words(1, 300)
    near = [" ".join(base[:i] + ["zz"] + base[i + 1 :]) for i in range(0, 300, 23)]
    texts = [*[t for t in ODD if len(t or "") < 1000], " ".join(base), " ".join(base).upper(), *near, " ".join(words(2, 80))]
    table = docs(spark, texts)
    got = {r["doc_id"]: (r["hex"], r["component_id"]) for r in simhash_groups(table).withColumn("hex", as_hex("fp")).collect()}
    prints = [fingerprint(t) for t in texts]
    roots = Roots()
    for i, a in enumerate(prints):
        for j in range(i + 1):
            if (a ^ prints[j]).bit_count() <= 3:
                roots.join(i, j)
    assert got == {i: (f"{p:016x}", roots.root(i)) for i, p in enumerate(prints)}
    kept = one_of_each_group(table)
    assert kept.columns == table.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({roots.root(i) for i in range(len(texts))})


def test_simhash_repeated_rows_and_null_ids(spark):
    rows = [(3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (None, "other words here"), (1, None)]
    got = simhash_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == [("1", "1"), ("3", "3"), ("3", "3"), ("None", "3"), ("None", "None")]
    assert simhash_groups(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_near_fingerprints_finds_every_pair(spark):
    rng = random.Random(2)
    prints = [rng.getrandbits(64)]
    for _ in range(400):
        x = rng.choice(prints)
        for b in rng.sample(range(64), rng.randint(1, 4)):
            x ^= 1 << b
        prints.append(x)
    prints = list(dict.fromkeys(prints))
    signed = [(x - (1 << 64) if x >> 63 else x, i) for i, x in enumerate(prints)]
    got = near_fingerprints(spark.createDataFrame(signed, "fp bigint, rep bigint")).collect()
    assert {(r["a"], r["b"]) for r in got} == {(j, i) for i, x in enumerate(prints) for j in range(i) if (x ^ prints[j]).bit_count() <= 3}


def test_linked_vectors(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 12))
    x = [(centres[i % 6] + rng.normal(size=12) * 0.25).tolist() for i in range(300)]
    x += [x[0], x[0], [2 * v for v in x[1]]]  # copies, and the same direction
    odd = [None, [0.0] * 12, [math.nan] + [1.0] * 11, [math.inf] + [1.0] * 11, [None] + [1.0] * 11, [1.0, 2.0]]
    rows = [(i * 3, v, i) for i, v in enumerate([*x, *odd])] + [(None, x[0], 0)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in linked_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int"), block=32).collect()}
    m = np.array(x, "f4").astype(float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = m @ m.T >= 0.9
    roots = Roots()
    for i, j in zip(*np.nonzero(near)):
        roots.join(int(i), int(j))
    expected = {i * 3: (int(near[i].sum()) - 1, roots.root(i) * 3) for i in range(len(x))}
    expected |= {(len(x) + k) * 3: (0, (len(x) + k) * 3) for k in range(len(odd))}
    assert got == expected
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert linked_vectors(empty).collect() == []


def test_blocks_go_to_few_tiles(spark, monkeypatch):
    """All pairs of 40 blocks are compared; a block is sent to one tile per stretch, not to one task per block."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(320, 6))
    x[1::2] = x[::2] + rng.normal(size=(160, 6)) * 0.1
    tables = {}

    def kept(table, name, *more):
        tables.setdefault(name, []).append(written(table, name, *more))
        return tables[name][-1]

    monkeypatch.setattr(vectors, "written", kept)
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in linked_vectors(rows, least=0.5, block=8).collect()}
    m = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = m @ m.T >= 0.5
    roots = Roots()
    for i, j in zip(*np.nonzero(near)):
        roots.join(int(i), int(j))
    assert got == {i: (int(near[i].sum()) - 1, roots.root(i)) for i in range(len(x))}
    pairs, stretches = tables["block-pairs"][-1].count(), math.ceil(math.sqrt(8 * spark.sparkContext.defaultParallelism))
    assert pairs > 600 and tables["tile-sides"][0].count() <= 40 * stretches


def test_a_side_of_a_tile_fits_its_bytes():
    assert [vectors._tile(n, 2048, 64, 12) for n in (1, 10, 11, 300, 10**6)] == [1, 1, 2, 30, 32]
    assert vectors._tile(10**6, 2048, 10**5, 12) == 1
