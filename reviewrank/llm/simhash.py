"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into two 32-bit segments. Fingerprints at a distance of at most three bits have
one segment at a distance of at most one, so each fingerprint looks up the 33 values of the Hamming
ball of radius one of each segment in the table of segment values, and the matches are verified by
their whole distance. Copies share a fingerprint and are grouped first, so a large group of copies is
one row of the search, whatever its size.

Defined cases: a null or blank text has fingerprint zero, linked like any other; a text with fewer
words than a shingle has its whole sequence as one shingle; rows that repeat a doc_id are fingerprinted
one by one; a row with a null doc_id keeps its fingerprint and takes the group's id if another row has
one, else null; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewrank.llm.components import components
from reviewrank.session import written

SEGMENTS, SEGMENT_BITS = 2, 32
#: XXH64's seed for shingles, the same as that of Spark's ``xxhash64``.
SEED = 42


def _fingerprinter(words_in_shingle: int, seed: int) -> Callable[[Iterator], Iterator]:
    """The function for Arrow batches; shipped by value, so that workers need no package."""

    def fingerprint(text: str | None) -> int:
        import numpy as np
        import xxhash

        words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and spaces only
        if not words:
            return 0
        line = b" ".join(words)
        spaces = np.flatnonzero(np.frombuffer(line, "u1") == 32)
        size = min(words_in_shingle, len(words))
        starts = [0, *(spaces[: len(words) - size] + 1).tolist()]
        ends = [*spaces[size - 1 :].tolist(), len(line)]
        digest = xxhash.xxh64_intdigest
        votes, block = np.zeros(64, "i8"), 1 << 16  # blocks of shingles bound the memory of a long text
        for i in range(0, len(starts), block):
            hashes = np.array([digest(line[s:e], seed) for s, e in zip(starts[i : i + block], ends[i : i + block])], "<u8")
            votes += np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="i8")
        return int(np.packbits(votes * 2 > len(starts), bitorder="little").view("<i8")[0])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [fingerprint(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())], ["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, words_in_shingle: int = 3, seed: int = SEED) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a long) of every row of ``docs`` (``doc_id, text``)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select("doc_id", "text")
    return narrow.mapInArrow(_fingerprinter(words_in_shingle, seed), f"doc_id {kind}, fp bigint")


def _segment(fp: Column, segment: int) -> Column:
    return F.shiftrightunsigned(fp, segment * SEGMENT_BITS).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))


def _key(segment: int, value: Column) -> Column:
    """Segment number and value in one long."""
    return value.bitwiseOR(F.lit(segment << SEGMENT_BITS))


def _ball(segment: int, value: Column, masks: Column) -> Column:
    return F.transform(masks, lambda mask: _key(segment, value.bitwiseXOR(mask)))


def near_fingerprints(distinct: DataFrame, most_bits: int = 3) -> DataFrame:
    """``a, b, bits``: pairs of ``rep`` whose ``fp`` differ in ``most_bits`` or fewer bits.

    ``distinct`` has one row ``fp, rep`` per fingerprint.
    """
    radius = most_bits // SEGMENTS
    if radius > 1:
        raise ValueError("segments of 32 bits take at most three differing bits")
    masks = [0] + [1 << i for i in range(SEGMENT_BITS)] * radius
    fp = F.col("fp")
    stored = F.explode(F.array(*(_key(s, _segment(fp, s)) for s in range(SEGMENTS))))
    ball = F.array(*(F.lit(m).cast("bigint") for m in masks))
    probes = F.explode(F.concat(*(_ball(s, _segment(fp, s), ball) for s in range(SEGMENTS))))
    table = distinct.select(stored.alias("key"), fp.alias("fp_b"), F.col("rep").alias("b"))
    looked_up = distinct.select(probes.alias("key"), fp.alias("fp_a"), F.col("rep").alias("a"))
    bits = F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b")))
    met = looked_up.join(table, "key").where((F.col("a") < F.col("b")) & (bits <= most_bits))
    return met.select("a", "b", bits.alias("bits")).distinct()


def simhash_groups(docs: DataFrame, words_in_shingle: int = 3, most_bits: int = 3) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest doc_id reachable over links, for every row."""
    marked = written(fingerprints(docs, words_in_shingle), "fingerprints")
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct-fingerprints")
    named = distinct.where("rep is not null")
    groups = components(near_fingerprints(named, most_bits), "a", "b")
    smallest = distinct.join(groups, F.col("rep") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id")
    )
    return marked.join(smallest, "fp").select("doc_id", "fp", "component_id")


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each_group(docs: DataFrame, words_in_shingle: int = 3, most_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their group; the others go.

    Rejected ids are joined, not kept ones, as they are fewer. Rows that repeat a kept doc_id stay
    together, and so do rows without a doc_id whose group has none.
    """
    groups = simhash_groups(docs, words_in_shingle, most_bits)
    rejected = written(groups.where("not (doc_id <=> component_id)").select(F.col("doc_id").alias("rejected")).distinct(), "rejected")
    return docs.join(rejected, F.col("doc_id").eqNullSafe(F.col("rejected")), "left_anti")
