import pytest
from frames import by_id
from pyspark.sql import functions as F

from reviewrank.operators import queue as qu
from reviewrank.operators.ensemble import by_ensemble
from reviewrank.sources.tables import export_queue, read_in_order, read_metrics, read_scored_csv, write_metrics, write_scored

SCHEMA = (
    "claim_id string, claim_type string, paid_amount double, model_score_percentile double, rule_score double, "
    "ensemble_score double, is_flagged string, rule_reason_codes string, is_injected_anomaly double"
)
ROWS = [
    ("q-3", "inpatient", 1250.5, 0.97, 0.20, 0.893, "yes", "EXCESS_UNITS", 1.0),
    ("q-1", "carrier", 80.0, 0.55, 0.00, 0.495, "0", "", None),
    ("q-2", "carrier", 40.0, 0.12, 0.45, 0.153, " TRUE", "['HIGH_PROVIDER_UTILIZATION', \"EXCESS_UNITS\"]", 1.0),
    ("q-4", "pharmacy", 12.25, 0.02, 0.00, 0.018, "no", None, 0.0),
]


@pytest.fixture()
def queue(spark):
    return qu.prepare_queue(spark.createDataFrame(ROWS, SCHEMA))


def test_prepare(queue):
    rows = by_ensemble(queue).collect()
    assert [r["claim_id"] for r in rows] == ["q-3", "q-1", "q-2", "q-4"]
    assert [r["is_flagged"] for r in rows] == [True, False, True, False]
    assert [r["rule_reason_codes"] for r in rows] == [["EXCESS_UNITS"], [], ["HIGH_PROVIDER_UTILIZATION", "EXCESS_UNITS"], []]
    assert [r["reason_codes_display"] for r in rows] == [
        "EXCESS_UNITS", "MULTIVARIATE_OUTLIER", "HIGH_PROVIDER_UTILIZATION, EXCESS_UNITS", "MULTIVARIATE_OUTLIER",
    ]
    assert [r["is_injected_anomaly"] for r in rows] == [1, 0, 1, 0]


@pytest.mark.parametrize(
    ("text", "codes"),
    [
        ("['A', 'B']", ["A", "B"]),
        ('["A", "it\'s"]', ["A", "it's"]),
        ("('A', 'B')", ["A", "B"]),
        ("{'A'}", ["A"]),
        ("A, B|C", ["A", "B", "C"]),
        (" | ,A", ["A"]),
        ("['A', ' ']", ["A"]),
        ("['A, B']", ["A, B"]),
        ("[]", []),
        ("  ", []),
        (None, []),
    ],
)
def test_reason_text(spark, text, codes):
    frame = spark.createDataFrame(ROWS[:1], SCHEMA).withColumn("rule_reason_codes", F.lit(text).cast("string"))
    assert qu.prepare_queue(frame).first()["rule_reason_codes"] == codes


@pytest.mark.parametrize(
    ("value", "flag"),
    [(" YES ", True), ("no", False), (2, True), (0.9, False), (-1.5, True), (True, True), ("1.0", True), ("0.0", False), ("1", True)],
)
def test_flags(spark, value, flag):
    frame = spark.createDataFrame(ROWS[:1], SCHEMA).withColumn("is_flagged", F.lit(value))
    assert qu.prepare_queue(frame).first()["is_flagged"] is flag


@pytest.mark.parametrize(
    ("column", "value", "message"),
    [
        ("is_flagged", "maybe", "not a review flag"),
        ("is_flagged", None, "not a review flag"),
        ("paid_amount", "much", "paid_amount is not a number"),
        ("rule_score", "1.2", "rule_score lies outside"),
        ("ensemble_score", None, "ensemble_score lies outside"),
    ],
)
def test_bad_values_fail(spark, column, value, message):
    frame = spark.createDataFrame(ROWS, SCHEMA).withColumn(column, F.lit(value).cast("string"))
    with pytest.raises(Exception, match=message):
        qu.prepare_queue(frame).collect()
    if value is None:  # from a column, where a filter for values that are there could come first
        frame = spark.createDataFrame(ROWS, SCHEMA).withColumn(column, F.when(F.col("claim_id") < "q-3", F.col(column)))
    for figures in [qu.summarize_queue, qu.score_histogram, qu.filter_queue, lambda q: q.agg(F.sum("paid_amount"))]:
        with pytest.raises(Exception, match=message):
            figures(qu.prepare_queue(frame)).collect()


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="the queue lacks columns"):
        qu.prepare_queue(spark.createDataFrame([("A",)], "claim_id string"))


def test_filters(queue):
    kept = qu.filter_queue(queue, ["carrier"], 0.15, True, ["HIGH_PROVIDER_UTILIZATION"])
    assert [r["claim_id"] for r in kept.collect()] == ["q-2"]
    assert qu.filter_queue(queue).count() == 2
    assert qu.filter_queue(queue, [], flagged_only=False, reason_codes=[]).count() == 4
    assert qu.filter_queue(queue, flagged_only=False, minimum_score=0.495).count() == 2


def test_summary(queue):
    row = qu.summarize_queue(queue).first()
    assert (row["claims"], row["flagged_claims"], row["review_paid_amount"]) == (4, 2, 1290.5)
    assert (row["injected_scenarios"], row["flagged_injected_scenarios"]) == (2, 2)
    empty = qu.summarize_queue(queue.filter("false").drop("is_injected_anomaly")).first().asDict()
    assert empty == {"claims": 0, "flagged_claims": 0, "review_paid_amount": 0.0, "average_ensemble_score": 0.0}


def test_lists_and_charts(queue):
    assert [r[0] for r in qu.reason_code_list(queue).collect()] == ["EXCESS_UNITS", "HIGH_PROVIDER_UTILIZATION"]
    assert [r[0] for r in qu.claim_type_list(queue).collect()] == ["carrier", "inpatient", "pharmacy"]
    bands = qu.score_histogram(queue).collect()
    assert [r["claims"] for r in bands] == [1, 1, 0, 0, 1, 0, 0, 0, 1, 0]
    assert bands[0]["score_band"] == "(-0.001, 0.1]" and bands[9]["score_band"] == "(0.9, 1.0]"
    assert sorted(r["claims"] for r in qu.claim_type_mix(queue).collect()) == [1, 1, 2]


def test_histogram_edges(queue):
    """Bands are closed on the right; 0 belongs to the first."""
    edge = queue.withColumn("ensemble_score", F.when(F.col("claim_id") == "q-3", 0.0).otherwise(F.lit(0.3)))
    assert [r["claims"] for r in qu.score_histogram(edge).collect()][:4] == [1, 0, 3, 0]


def test_views(queue):
    assert qu.display_queue(queue).columns[0] == "Claim ID" and len(qu.display_queue(queue).columns) == 8
    detail = qu.claim_details(queue.withColumn("units", F.lit(4)), F.col("claim_id") == "q-3").collect()
    assert [(r["Field"], r["Value"]) for r in detail] == [("Claim type", "inpatient"), ("Units", "4")]
    assert by_id(qu.claim_signals(queue), "review_signals")["q-1"] == ["Multivariate Outlier"]
    assert qu.agreement_points(queue).count() == 4


def test_scored_csv_round_trip(spark, queue, tmp_path):
    write_scored(queue, str(tmp_path / "scored"), "csv")
    again = read_scored_csv(spark, str(tmp_path / "scored"))
    columns = [c for c in queue.columns]
    assert sorted(again.select(columns).collect(), key=str) == sorted(queue.collect(), key=str)
    export_queue(queue, str(tmp_path / "export"))
    first = sorted((tmp_path / "export").glob("*.csv"))[0].read_text().splitlines()
    assert first[1].startswith("q-3,") and "['EXCESS_UNITS']" in first[1]


def test_exported_files_keep_the_order(spark, tmp_path):
    """Many files, cut into stretches: places follow the sort order."""
    rows = [(f"c{i:04d}", *ROWS[0][1:5], (i * 37 % 101) / 101, *ROWS[0][6:]) for i in range(700)]
    queue = qu.prepare_queue(spark.createDataFrame(rows, SCHEMA).repartition(7))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        export_queue(queue, str(tmp_path / "out"))
        places = by_id(read_in_order(spark, str(tmp_path / "out")), "place")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    wanted = sorted(rows, key=lambda r: (-r[5], r[0]))
    assert [places[r[0]] for r in wanted] == list(range(1, 701))


def test_metrics_document_without_labels(spark, tmp_path):
    write_metrics(spark.createDataFrame([(0, 9)], "evaluation_available int, rows long"), None, str(tmp_path / "m"))
    found = {(r["ranking"], r["metric"]): r["value"] for r in read_metrics(spark, str(tmp_path / "m")).collect()}
    assert found == {("primary", "evaluation_available"): 0.0, ("primary", "rows"): 9.0}
