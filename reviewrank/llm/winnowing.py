"""Document fingerprints by winnowing (Schleimer, Wilkerson & Aiken, SIGMOD 2003), in native expressions.

A text's symbols are its words, cut after ``SYMBOL`` code points, so that a text without blanks has symbols too.
Every k-gram of symbols is hashed; of each window of consecutive hashes the smallest is chosen, the
rightmost one where several are equal, and kept with its position. Two texts that share a run of
``window + gram - 1`` symbols or more therefore share a chosen hash, and a chosen hash that they share
comes from an equal run of ``gram`` symbols (but for collisions of 36 bits).

Array functions keep no running state at a bearable price, so a k-gram is hashed by XXH64 afresh instead of
being rolled on from the one before; and code points as symbols cost about ten times as much (README).

Memory is in proportion to one text: about 20 bytes a byte while it is worked on.

Defined cases: a null text is empty; a text without symbols has an empty fingerprint; one of fewer symbols
than a k-gram is hashed as a whole; one of fewer k-grams than a window has one chosen hash. Repeated rows
stay, with equal fingerprints. Further columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewrank.llm.arrays import drawn, let

GRAM = 5
WINDOW = 8
SYMBOL = 12
#: Low bits that hold a position; the hash has the others.
PLACE_BITS = 28
#: Ids drawn per bucket to place the bounds of the buckets; they steer balance only.
IDS_PER_BUCKET = 32


def symbols_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"[^\x20\x09-\x0D]{{1,{SYMBOL}}}"), F.lit(0))


def _packed(gram: Column, place: Column) -> Column:
    """Hash and place in one number: the smaller hash comes first, then the place further right."""
    last = (1 << PLACE_BITS) - 1
    return F.xxhash64(gram).bitwiseAND(F.lit(~last)).bitwiseOR(F.lit(last) - place)


def _hashes(symbols: Column, gram: int) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.size(symbols) - (gram - 1), F.lit(1)))
    each = F.transform(starts, lambda i: _packed(F.slice(symbols, i, F.lit(gram)), i - 1))
    return F.when(F.size(symbols) > 0, each).otherwise(F.array().cast("array<bigint>"))


def _minima(hashes: Column, window: int) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.size(hashes) - (window - 1), F.lit(1)))
    each = F.transform(starts, lambda i: F.array_min(F.slice(hashes, i, F.lit(window))))
    return F.when(F.size(hashes) > 0, F.array_distinct(each)).otherwise(hashes)


def chosen(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The chosen hashes of a text from left to right, packed with their positions."""
    return let(symbols_of(text), lambda s: let(_hashes(s, gram), lambda v: _minima(v, window)))


def hash_set(found: Column) -> Column:
    """The different chosen hashes."""
    return F.array_distinct(F.transform(found, lambda v: F.shiftright(v, PLACE_BITS)))


def as_text(found: Column) -> Column:
    """``hash@position`` of each chosen hash from left to right, blank-joined; positions count symbols."""
    last = F.lit((1 << PLACE_BITS) - 1)
    shown = lambda v: F.concat(F.lower(F.hex(F.shiftrightunsigned(v, PLACE_BITS))), F.lit("@"), last - v.bitwiseAND(last))
    return F.array_join(F.transform(found, shown), " ")


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two sets; two empty sets are alike."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def fingerprints(docs: DataFrame, text: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Adds ``fingerprint`` and ``hashes``; one pass over the rows, nothing is shuffled."""
    found = docs.withColumn("_chosen", chosen(F.coalesce(F.col(text), F.lit("")), gram, window))
    return found.withColumns({"fingerprint": as_text(F.col("_chosen")), "hashes": hash_set(F.col("_chosen"))}).drop("_chosen")


# --- documents beside the next one ---------------------------------------------------------------


def _bounds(keyed: DataFrame, spark: SparkSession) -> list:
    """Keys that cut the rows into about equal buckets, from ids drawn by hash; literals, so stable on a retry."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, wanted = keyed.count(), buckets * IDS_PER_BUCKET
    some = keyed.where(drawn(wanted, rows, F.lit("bounds"), "_key")).distinct()
    keys = [r["_key"] for r in some.orderBy("_key").collect()]
    return list(dict.fromkeys(keys[i * len(keys) // buckets] for i in range(1, buckets))) if keys else []


def _bucket(bounds: list, id_type: str) -> Column:
    """Number of bounds at or below a row's key."""
    if not bounds:
        return F.lit(0)
    literals = F.array(*[F.struct(F.lit(b["id"]).cast(id_type).alias("id"), F.lit(b["h"]).alias("h")) for b in bounds])
    return F.size(F.filter(literals, lambda b: b <= F.col("_key")))


def beside_next(docs: DataFrame, added: dict[str, Column], payload: list[str]) -> DataFrame:
    """Adds the columns ``added``, and ``next_<name>`` for each payload column: the values of the next row by
    descending doc_id, with those of the first row after the last one. Rows of one doc_id go by the hash of
    the text, then by the text; null ids come last.

    Rows are cut into buckets of ids and put in order inside each. The first row of a bucket (one row per
    bucket) is also put behind the last one of the bucket before it, so that no bucket needs another.
    """
    spark, id_type = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    key = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h")).alias("_key")
    bucket = _bucket(_bounds(docs.select(key), spark), id_type).alias("_bucket")
    placed = docs.select("*", key).select("*", bucket, F.lit(0).alias("_copy"))
    descending = Window.orderBy(F.desc("_bucket"))  # one row per bucket, whatever the data
    tops = placed.groupBy("_bucket").agg(F.max("_key").alias("_top"))
    before = F.coalesce(F.lag("_bucket").over(descending), F.min("_bucket").over(Window.partitionBy()))
    order = [F.desc("_key"), F.desc("text")]
    first = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    heads = (
        placed.join(F.broadcast(tops.withColumn("_before", before)), "_bucket")
        .where(F.col("_key").eqNullSafe(F.col("_top")))
        .withColumn("_n", first)
        .where("_n = 1")
        .select(*docs.columns, "_key", F.col("_before").alias("_bucket"), F.lit(1).alias("_copy"))
    )
    following = Window.partitionBy("_bucket").orderBy("_copy", *order)
    both = placed.unionByName(heads).withColumns(added)  # after the heads are known, so once per row
    beside = both.withColumns({f"next_{c}": F.lead(c).over(following) for c in payload})
    return beside.where("_copy = 0").drop("_key", "_bucket", "_copy")


def edited_texts(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint beside that of an edited text, whose last third (rounded down)
    is replaced by as many first code points of the next document by descending doc_id, or all it has, and
    the likeness of its fingerprint to the edited text's and to the next document's.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    pairs = beside_next(texts, {"chosen": chosen(F.col("text"))}, ["text", "chosen"])
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = pairs.withColumns(
        {
            "n_chars": n.cast("long"),
            "edited": F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)),
            "own": hash_set(F.col("chosen")),
        }
    )
    both = edited.withColumn("edited_chosen", chosen(F.col("edited")))
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("chosen")).alias("fingerprint"),
        as_text(F.col("edited_chosen")).alias("edited_fingerprint"),
        likeness(F.col("own"), hash_set(F.col("edited_chosen"))).alias("near_edited"),
        likeness(F.col("own"), hash_set(F.col("next_chosen"))).alias("near_next"),
    )
