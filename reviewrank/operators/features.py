"""Claim features: trailing counts, provider-relative cost, exact duplicates, weekend service.

Every per-key figure is aggregated first (partial sums before the shuffle) and joined back, so a
provider, beneficiary or group of copies that holds a large share of all rows never has to fit
in one task, as it would with a plain window over the rows. Equal figures join back by equi-join;
adaptive execution broadcasts a side when its measured size allows and splits skewed partitions
otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewrank.functions.expr import is_weekend, packed, unpacked, wall_clock_seconds
from reviewrank.schema import CLAIMS, COUNT_COLUMNS, OPTIONAL_CLAIM_TYPES, require_columns
from reviewrank.session import few, written

DAY = 86_400
NO_DATE = -(2**60)
#: Hashes of copies, providers, and claims that only share a hash, up to which they are broadcast.
MOST_SHARED, MOST_PROVIDERS, MOST_LONE = 2_000_000, 500_000, 100_000
#: Windows' lengths in a block of trailing counts: the longer, the fewer instants are needed in two blocks.
BLOCK_SPANS = 8

# Two claims are copies when they agree on these.
DUPLICATE_FIELDS = [
    "beneficiary_id",
    "provider_id",
    "claim_type",
    "service_date",
    "paid_amount",
    "diagnosis_count",
    "procedure_count",
    "units",
]


def typed_claims(claims: DataFrame) -> DataFrame:
    """Cast the canonical columns to their types; text dates are parsed and a bad one fails."""
    require_columns(claims, CLAIMS.fieldNames())
    return claims.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in CLAIMS.fields})


def _instant() -> Column:
    return F.coalesce(wall_clock_seconds(F.col("service_date")), F.lit(NO_DATE))


def trailing_counts(claims: DataFrame, key: str, days: int = 30) -> DataFrame:
    """Per key and instant, the claims in the ``days`` up to and including it.

    Returns ``key, _instant, same`` (claims at the instant) and ``trailing``. Rows are first
    counted per key and second. Time is cut into blocks of ``BLOCK_SPANS`` windows' lengths; a window
    reaches back into the last such length of one earlier block at most, so only the instants there are
    sent to the next block as well. A task then holds at most one block and one window of seconds of one
    key, however many claims the key has.
    """
    if days <= 0:
        raise ValueError("the window must be longer than zero days")
    span = days * DAY
    counted = (
        claims.filter(F.col(key).isNotNull())
        .groupBy(key, _instant().alias("_instant"))
        .agg(F.count(F.lit(1)).alias("same"))
    )
    long = BLOCK_SPANS * span
    block = F.floor(F.col("_instant") / F.lit(long))
    late = F.pmod(F.col("_instant"), F.lit(long)) >= F.lit(long - span)
    ahead = F.when(late, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    placed = counted.withColumn("_ahead", F.explode(ahead)).withColumn("_block", block + F.col("_ahead")).drop("_ahead")
    window = Window.partitionBy(key, "_block").orderBy("_instant").rangeBetween(-span, 0)
    return (
        placed.withColumn("trailing", F.sum("same").over(window))
        .filter(F.col("_block") == block)
        .select(key, "_instant", "same", "trailing")
    )


def arrival_numbers(claims: DataFrame, key: str) -> DataFrame:
    """``claim_id, key, _instant, _place``: the place of a claim among those of its key and instant.

    Rows are spread by ranges of (key, instant, claim id), written once with the number of their
    range, numbered inside each range and shifted by the sizes of the earlier ranges of the group.
    Range bounds contain the claim id, so a group of any size spreads over many tasks.
    """
    parts = int(claims.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = [key, "_instant"]
    narrow = claims.filter(F.col(key).isNotNull()).select("claim_id", key, _instant().alias("_instant"))
    spread = narrow.repartitionByRange(parts, *group, "claim_id").withColumn("_range", F.spark_partition_id())
    ranged = written(spread, f"arrival-{key}")
    inside = Window.partitionBy(*group, "_range").orderBy("claim_id")
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        ranged.groupBy(*group, "_range")
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_shift", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .drop("_size")
    )
    return (
        ranged.withColumn("_row", F.row_number().over(inside))
        .join(shift, [*group, "_range"])
        .select("claim_id", *group, (F.col("_row") + F.col("_shift")).alias("_place"))
    )


def with_trailing_count(
    claims: DataFrame, key: str, out: str, days: int = 30, ties: str = "peers", source: DataFrame | None = None
) -> DataFrame:
    """Adds ``out``, the trailing count of the claim's key.

    ``ties="peers"`` counts all claims of the same instant; ``ties="arrival"`` counts those up to
    the claim itself, in order of claim id. A claim without key gets null. ``source`` is the table
    to count in, where ``claims`` already carries joined columns.
    """
    if ties not in ("peers", "arrival"):
        raise ValueError("ties must be 'peers' or 'arrival'")
    source = claims if source is None else source
    counts = trailing_counts(source, key, days)
    based = claims.withColumn("_instant", _instant())
    if ties == "peers":
        joined = based.join(counts.drop("same"), [key, "_instant"], "left")
        return joined.withColumnRenamed("trailing", out).drop("_instant")
    places = arrival_numbers(source, key).select("claim_id", "_place")
    return (
        based.join(counts, [key, "_instant"], "left")
        .join(places, "claim_id", "left")
        .withColumn(out, F.col("trailing") - F.col("same") + F.col("_place"))
        .drop("_instant", "same", "trailing", "_place")
    )


def provider_statistics(claims: DataFrame) -> DataFrame:
    return (
        claims.filter(F.col("provider_id").isNotNull())
        .groupBy("provider_id")
        .agg(F.avg("paid_amount").alias("_mean"), F.stddev_samp("paid_amount").alias("_std"))
    )


def _zscore() -> Column:
    usable = F.col("_std").isNotNull() & (F.col("_std") != 0)
    value = (F.col("paid_amount") - F.col("_mean")) / F.col("_std")
    return F.coalesce(F.when(usable, value), F.lit(0.0))


def with_provider_zscore(claims: DataFrame) -> DataFrame:
    """Adds ``provider_paid_zscore`` (sample deviation; 0 where it is null or 0)."""
    # Without its own exchange the small side would keep adaptive execution from splitting a hot provider.
    statistics = provider_statistics(claims).hint("rebalance")
    joined = claims.join(statistics, "provider_id", "left")
    return joined.withColumn("provider_paid_zscore", _zscore()).drop("_mean", "_std")


def _copy_key(claims: DataFrame) -> Column:
    kinds = dict(claims.dtypes)
    values = [F.col(c) + F.lit(0.0) if kinds[c] in ("double", "float") else F.col(c) for c in DUPLICATE_FIELDS]  # -0.0 becomes 0.0
    return F.xxhash64(*values)


def shared_keys(claims: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
    """``_copy_key``: the hashes of the fields that more than one claim has; and of the claims with such a hash those whose
    fields no other claim has (``_lone_`` and the field), which is none unless hashes collide.

    Partial counts collapse copies before the shuffles. Both tables are written, so that their size is known when
    the joins are planned, and the claims stay where they are."""
    hashed = claims.select(key.alias("_copy_key"), *DUPLICATE_FIELDS)
    counted = hashed.groupBy("_copy_key").agg(F.count(F.lit(1)).alias("_copies"))
    shared = written(counted.filter("_copies > 1").select("_copy_key"), "shared-keys")
    asked = F.broadcast(shared) if few(shared, MOST_SHARED) else shared
    groups = hashed.join(asked, "_copy_key", "left_semi").groupBy(*DUPLICATE_FIELDS).agg(F.count(F.lit(1)).alias("_copies"))
    lone = groups.filter("_copies = 1").select(*[F.col(c).alias(f"_lone_{c}") for c in DUPLICATE_FIELDS])
    return shared, written(lone, "lone-fields")


def with_duplicate_indicator(claims: DataFrame, source: DataFrame | None = None, key: Column | None = None) -> DataFrame:
    """Adds ``duplicate_indicator``: 1 on every copy; null equals null.

    Claims look up the hash of their fields, which is shorter than the fields and known to be shared or not; where
    hashes collide, the fields decide. ``key`` is another hash."""
    key = _copy_key(claims) if key is None else key
    shared, lone = shared_keys(claims if source is None else source, key)
    # Its own exchange lets adaptive execution split a hot group where the hashes are too many to broadcast.
    keys = shared.withColumn("_is_dup", F.lit(1)).hint("rebalance")
    keys = F.broadcast(keys) if few(shared, MOST_SHARED) else keys
    marked = claims.withColumn("_copy_key", key).join(keys, "_copy_key", "left").drop("_copy_key")
    copied = F.col("_is_dup").isNotNull()
    if not lone.isEmpty():
        same = [F.col(c).eqNullSafe(F.col(f"_lone_{c}")) for c in DUPLICATE_FIELDS]
        fields = lone.withColumn("_is_lone", F.lit(1)).hint("rebalance")
        marked = marked.join(F.broadcast(fields) if few(lone, MOST_LONE) else fields, same, "left")
        copied = copied & F.col("_is_lone").isNull()
    return marked.withColumn("duplicate_indicator", copied.cast("int")).drop("_is_dup", "_is_lone", *[f"_lone_{c}" for c in DUPLICATE_FIELDS])


#: Features that follow from one column of the same row.
ROW_FEATURES = {"paid_amount_log": "paid_amount", "weekend_service": "service_date"}


def with_row_features(claims: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Adds the row features, or those of ``names``."""
    features = {
        "paid_amount_log": lambda: F.log1p("paid_amount"),
        "weekend_service": lambda: F.coalesce(is_weekend(F.col("service_date")), F.lit(False)).cast("int"),
    }
    return claims.withColumns({n: make() for n, make in features.items() if names is None or n in names})


def claim_features(claims: DataFrame, days: int = 30, ties: str = "peers") -> DataFrame:
    """All model features. Extra columns pass through.

    Claims are shuffled once for the provider's counts, once for the beneficiary's and, only if shared
    hashes are above ``MOST_SHARED``, once more for the copies; their counts travel as one number, and their date as the instant. Statistics of few
    providers are broadcast behind both shuffles; those of many share one table per (provider, instant) with the counts.
    """
    base = typed_claims(claims)
    kinds = dict(base.dtypes)
    whole = [c for c in (*COUNT_COLUMNS, *OPTIONAL_CLAIM_TYPES) if kinds.get(c) in ("bigint", "int")]
    carried = base.withColumns(packed(whole, "_whole")).drop(*whole)
    if ties == "peers":
        counts = trailing_counts(base, "provider_id", days).withColumnRenamed("trailing", "provider_claim_count_30d").drop("same")
        statistics = written(provider_statistics(base), "provider-statistics")
        # The date is the instant and what a second leaves out, so only that goes along.
        parts = F.unix_micros("service_date") - F.col("_instant") * 1_000_000
        timed = carried.withColumn("_instant", _instant()).withColumn("_rest", F.when(F.col("service_date").isNotNull(), parts)).drop("service_date")
        broadcast = few(statistics, MOST_PROVIDERS)
        if broadcast:
            placed = timed.join(counts, ["provider_id", "_instant"], "left")
        else:
            placed = timed.join(counts.join(statistics, "provider_id"), ["provider_id", "_instant"], "left")
            placed = placed.withColumn("provider_paid_zscore", _zscore()).drop("_mean", "_std")
        seen = trailing_counts(base, "beneficiary_id", days).withColumnRenamed("trailing", "beneficiary_claim_count_30d").drop("same")
        date = F.when(F.col("_rest").isNotNull(), F.timestamp_micros(F.col("_instant") * 1_000_000 + F.col("_rest")))
        featured = placed.join(seen, ["beneficiary_id", "_instant"], "left").withColumn("service_date", date).drop("_instant", "_rest")
        if broadcast:
            featured = featured.join(F.broadcast(statistics), "provider_id", "left")
            featured = featured.withColumn("provider_paid_zscore", _zscore()).drop("_mean", "_std")
    else:
        featured = with_provider_zscore(carried)
        for key, out in (("provider_id", "provider_claim_count_30d"), ("beneficiary_id", "beneficiary_claim_count_30d")):
            featured = with_trailing_count(featured, key, out, days, ties, source=base)
    featured = featured.withColumns(unpacked(whole, "_whole", kinds))
    featured = with_duplicate_indicator(featured, source=base)
    derived = [
        "paid_amount_log",
        "weekend_service",
        "duplicate_indicator",
        "provider_claim_count_30d",
        "beneficiary_claim_count_30d",
        "provider_paid_zscore",
    ]
    return with_row_features(featured).select(*claims.columns, *derived)
