import pytest
from frames import CLAIM, by_id
from pyspark.sql import functions as F

from reviewrank.operators.inject import COPIED_FIELDS, inject_at_rate, pick_exactly
from generator import by_service_date, generate_claims, plain_claims


def test_guards(spark):
    with pytest.raises(ValueError, match="rows"):
        generate_claims(spark, 99)
    with pytest.raises(ValueError, match="share of anomalies"):
        generate_claims(spark, 100, 0.25)


def test_shape(spark):
    table = generate_claims(spark, 5_000, 0.04, seed=42).cache()
    assert table.count() == 5_000 and table.select("claim_id").distinct().count() == 5_000
    assert table.agg(F.sum("is_injected_anomaly")).first()[0] == 200
    scenarios = {r[0]: r[1] for r in table.groupBy("anomaly_scenario").count().collect()}
    assert scenarios.pop("none") == 4_800 and len(scenarios) == 4 and min(scenarios.values()) > 25
    plain = table.filter("is_injected_anomaly = 0")
    shares = {r[0]: r[1] / 4_800 for r in plain.groupBy("claim_type").count().collect()}
    for name, share in {"carrier": 0.42, "inpatient": 0.12, "outpatient": 0.34, "pharmacy": 0.12}.items():
        assert shares[name] == pytest.approx(share, abs=0.03)
    medians = {r[0]: r[1] for r in plain.groupBy("claim_type").agg(F.median("paid_amount")).collect()}
    for name, paid in {"carrier": 220, "inpatient": 8_500, "outpatient": 900, "pharmacy": 140}.items():
        assert medians[name] == pytest.approx(paid, rel=0.12)
    low, high, mean = plain.agg(F.min("diagnosis_count"), F.max("diagnosis_count"), F.avg("diagnosis_count")).first()
    assert low >= 1 and high <= 12 and mean == pytest.approx(2.49, abs=0.1)
    assert plain.filter("claim_type <> 'inpatient' and length_of_stay > 0").count() == 0
    assert by_service_date(table).first()["service_date"].isoformat() == "2025-01-01T00:00:00"


def test_partitions_do_not_change_claims(spark):
    base = plain_claims(spark, 300, 5)
    one = sorted(inject_at_rate(base.coalesce(1), 0.1, 5).collect())
    many = sorted(inject_at_rate(base.repartition(16), 0.1, 5).select(*base.columns, "is_injected_anomaly", "anomaly_scenario").collect())
    assert one == many


@pytest.mark.parametrize("wanted", [1, 7, 299, 300, 500])
def test_exact_pick(spark, wanted):
    base = plain_claims(spark, 300, 5)
    assert base.filter(pick_exactly(base, wanted, 1)).count() == min(wanted, 300)


def test_scenarios_change_the_right_fields(spark):
    base = plain_claims(spark, 2_000, 9)
    before = {r["claim_id"]: r for r in base.collect()}
    copies = {tuple(r[c] for c in COPIED_FIELDS) for r in before.values()}
    for row in inject_at_rate(base, 0.2, 9).filter("is_injected_anomaly = 1").collect():
        old, kind = before[row["claim_id"]], row["anomaly_scenario"]
        ratio = row["paid_amount"] / old["paid_amount"]
        if kind == "high_paid":
            assert 7.9 < ratio < 18.1 and row["units"] == old["units"]
        elif kind == "excess_units":
            assert 30 <= row["units"] <= 99 and ratio == 1
        elif kind == "duplicate_like":
            assert tuple(row[c] for c in COPIED_FIELDS) in copies
        else:
            assert 2.9 < ratio < 6.1 and 12 <= row["procedure_count"] <= 24 and 12 <= row["diagnosis_count"] <= 24


def test_hot_claims_still_inject(spark):
    """A third of the rows share every field but the id."""
    rows = [(f"C{i:04d}", *("B", "P", "carrier", "2024-01-01", 10.0, 1, 1, 1, 0)) if i % 3 == 0 else (f"C{i:04d}", f"B{i}", f"P{i % 9}", "carrier", "2024-01-02", float(i), 1, 1, 1, 0) for i in range(300)]
    table = inject_at_rate(spark.createDataFrame(rows, CLAIM), 0.1, 3)
    assert table.count() == 300 and sum(by_id(table, "is_injected_anomaly").values()) == 30
