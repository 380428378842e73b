import random

import pytest
from frames import CLAIM, by_id, dated, five_claims, plan_of
from pyspark.sql import functions as F

from reviewrank.operators import features as ft
from reviewrank.schema import NUMERIC_FEATURES
from reviewrank.session import written
from generator import generate_claims


def test_five_claims(spark):
    table = ft.claim_features(five_claims(spark))
    assert by_id(table, "provider_claim_count_30d") == {"K7": 1, "K8": 2, "K9": 3, "L1": 1, "L2": 2}
    assert by_id(table, "beneficiary_claim_count_30d") == {"K7": 1, "K8": 1, "K9": 3, "L1": 1, "L2": 2}
    z = by_id(table, "provider_paid_zscore")
    assert [z[k] for k in ("K7", "K8", "K9", "L1", "L2")] == pytest.approx([-1, 0, 1, -(2**-0.5), 2**-0.5])
    assert set(by_id(table, "duplicate_indicator").values()) == {0}
    assert by_id(table, "weekend_service") == {"K7": 0, "K8": 0, "K9": 0, "L1": 1, "L2": 1}
    assert table.schema["service_date"].dataType.simpleString() == "timestamp"
    assert table.columns[:10] == five_claims(spark).columns


def test_tie_modes(spark):
    claims = dated(spark, [0, 0, 30, 31])
    peers = ft.with_trailing_count(ft.typed_claims(claims), "provider_id", "n")
    assert by_id(peers, "n") == {"C000": 2, "C001": 2, "C002": 3, "C003": 2}
    arrival = ft.claim_features(claims, ties="arrival")
    assert by_id(arrival, "provider_claim_count_30d") == {"C000": 1, "C001": 2, "C002": 3, "C003": 2}
    with pytest.raises(ValueError):
        ft.with_trailing_count(claims, "provider_id", "n", ties="other")


@pytest.mark.parametrize("days", [0, -3])
def test_window_must_be_positive(spark, days):
    with pytest.raises(ValueError, match="longer than zero"):
        ft.claim_features(five_claims(spark), days=days)


def test_missing_column(spark):
    with pytest.raises(ValueError, match="provider_id"):
        ft.claim_features(five_claims(spark).drop("provider_id"))


def test_bad_date_fails(spark):
    bad = five_claims(spark).withColumn("service_date", F.lit("soon"))
    with pytest.raises(Exception, match="soon"):
        ft.claim_features(bad).collect()


def test_copies_are_all_marked_and_null_equals_null(spark):
    rows = [
        ("A", "B1", "P1", "carrier", "2024-01-01", 10.0, 1, 1, 1, 0),
        ("B", "B1", "P1", "carrier", "2024-01-01", 10.0, 1, 1, 1, 5),
        ("C", None, "P1", "carrier", "2024-01-01", 10.0, 1, 1, 1, 0),
        ("D", None, "P1", "carrier", "2024-01-01", 10.0, 1, 1, 1, 0),
        ("E", "B1", "P1", "carrier", "2024-01-01", 10.0, 1, 1, 2, 0),
    ]
    table = ft.claim_features(spark.createDataFrame(rows, CLAIM))
    assert by_id(table, "duplicate_indicator") == {"A": 1, "B": 1, "C": 1, "D": 1, "E": 0}
    # A claim without key has no count; one without provider spread scores 0.
    assert by_id(table, "beneficiary_claim_count_30d")["C"] is None
    assert set(by_id(table, "provider_paid_zscore").values()) == {0.0}


def test_null_provider_scores_zero(spark):
    rows = [(f"C{i}", "B", None, "carrier", "2024-01-01", 10.0 * i, 1, 1, 1, 0) for i in range(3)]
    table = ft.claim_features(spark.createDataFrame(rows, CLAIM))
    assert set(by_id(table, "provider_claim_count_30d", "provider_paid_zscore").values()) == {(None, 0.0)}


def brute_counts(rows, key, days):
    span = days * 86_400
    return {
        r["claim_id"]: sum(1 for o in rows if o[key] == r[key] and 0 <= r["t"] - o["t"] <= span) for r in rows
    }


@pytest.mark.parametrize("days", [1, 7, 30])
def test_counts_match_brute_force_with_a_hot_key_and_times(spark, days):
    """One provider holds over a third of the claims; times are not whole days."""
    draw = random.Random(days)
    rows = []
    for i in range(400):
        t = 1_700_000_000 + draw.randrange(0, 90 * 86_400) // 1800 * 1800
        key = "HOT" if draw.random() < 0.4 else f"P{draw.randrange(12)}"
        rows.append({"claim_id": f"C{i:04d}", "provider_id": key, "t": t})
    table = spark.createDataFrame([(r["claim_id"], r["provider_id"], r["t"]) for r in rows], "claim_id string, provider_id string, t long")
    table = table.withColumn("service_date", F.timestamp_seconds("t")).repartition(7)
    peers = by_id(ft.with_trailing_count(table, "provider_id", "n", days), "n")
    assert peers == brute_counts(rows, "provider_id", days)
    arrival = by_id(ft.with_trailing_count(table, "provider_id", "n", days, ties="arrival"), "n")
    for r in rows:
        later = sum(
            1
            for o in rows
            if (o["provider_id"], o["t"]) == (r["provider_id"], r["t"]) and o["claim_id"] > r["claim_id"]
        )
        assert arrival[r["claim_id"]] == peers[r["claim_id"]] - later


def test_counts_do_not_depend_on_the_session_zone(spark):
    """30 calendar days stay 30 days across a change of the clocks."""
    claims = dated(spark, [60, 90])
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        table = ft.with_trailing_count(ft.typed_claims(claims), "provider_id", "n")
        assert by_id(table, "n") == {"C000": 1, "C001": 2}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_generated_claims_give_a_complete_matrix(spark):
    table = ft.claim_features(generate_claims(spark, 250, 0.04, seed=7))
    nulls = table.agg(*[F.count_if(F.col(c).isNull()) for c in NUMERIC_FEATURES]).first()
    assert sum(nulls) == 0
    low = table.agg(F.min("provider_claim_count_30d"), F.min("beneficiary_claim_count_30d")).first()
    assert min(low) >= 1


def test_partitions_do_not_change_features(spark):
    claims = generate_claims(spark, 300, 0.1, seed=3)
    columns = [*NUMERIC_FEATURES]
    results = [by_id(ft.claim_features(claims.repartition(n)), *columns) for n in (1, 4, 17)]
    for other in results[1:]:
        assert other.keys() == results[0].keys()
        for key, values in other.items():
            assert values == pytest.approx(results[0][key], abs=1e-9)


def test_no_window_runs_over_rows_of_a_key(spark):
    """Windows only see counted instants; claims themselves are joined, so adaptive execution may
    split a hot key. Nothing goes to one partition."""
    text = plan_of(ft.claim_features(five_claims(spark)))
    assert "SinglePartition" not in text
    for line in text.splitlines():
        if "Window" in line and "windowspec" in line.lower():
            assert "_block" in line


def test_duplicate_join_can_become_a_broadcast(spark):
    assert "REBALANCE" in plan_of(ft.claim_features(five_claims(spark)))


def test_hot_keys_are_split(spark):
    """A third of the claims share provider, beneficiary and date, and are copies of each other. With
    broadcasts off, every join of the claims themselves is split by adaptive execution."""
    hot = F.col("id") % 3 == 0
    claims = spark.range(60_000).repartition(8).select(
        F.format_string("C%08d", "id").alias("claim_id"),
        F.when(hot, "B").otherwise(F.concat(F.lit("B"), F.col("id") % 5_000)).alias("beneficiary_id"),
        F.when(hot, "P").otherwise(F.concat(F.lit("P"), F.col("id") % 500)).alias("provider_id"),
        F.lit("carrier").alias("claim_type"),
        F.when(hot, F.lit("2024-01-04")).otherwise(F.concat(F.lit("2024-02-1"), F.col("id") % 10)).alias("service_date"),
        F.when(hot, 5.0).otherwise(F.col("id") / 7).alias("paid_amount"),
        *[F.lit(1).cast("long").alias(c) for c in ("diagnosis_count", "procedure_count", "units", "length_of_stay")],
    )
    claims = written(claims, "hot")
    changed = {
        "spark.sql.shuffle.partitions": "100",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "2k",
    }
    before = {k: spark.conf.get(k) for k in changed if k != "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"}
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        for table, joins in ((ft.claim_features(claims), 3), (ft.with_provider_zscore(ft.typed_claims(claims)), 1)):
            table._jdf.queryExecution().toRdd().count()
            text = plan_of(table).split("== Initial Plan ==")[0]
            assert text.count("Join(skew=true)") == joins
        row = ft.claim_features(claims).filter("claim_id = 'C00000003'").first()
        assert (row["provider_claim_count_30d"], row["duplicate_indicator"]) == (20_000, 1)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
        spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")


def test_dates_come_back_to_the_microsecond(spark):
    """A date travels as its instant and a rest: parts of a second, other zones, repeated hours and far years are kept."""
    micros = [0, 1, -1, 1_730_610_000_123_456, 1_730_613_600_000_000, -62_135_596_800_000_000, 253_402_300_799_999_999, None]
    rows = [(f"C{i}", "B", "P", "carrier", m, 10.0, 1, 1, 1, 0) for i, m in enumerate(micros)]
    claims = spark.createDataFrame(rows, CLAIM.replace("service_date string", "service_date bigint")).withColumn("service_date", F.timestamp_micros("service_date"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            table = ft.claim_features(claims)
            assert by_id(table.withColumn("m", F.unix_micros("service_date")), "m") == {r[0]: r[4] for r in rows}
            assert "_rest" in plan_of(table)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
