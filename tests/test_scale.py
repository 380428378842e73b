"""Plans and tables whose size must not grow faster than the input."""

from __future__ import annotations

import datetime
import re

from pyspark.sql import functions as F

from reviewrank.functions import expr
from reviewrank.operators import ensemble, features, inject, queue, ranking
from reviewrank.plans import views
from reviewrank.session import written
from reviewrank.sources import cms, tables


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scored(spark):
    rows = spark.range(2_000).select(
        F.format_string("C%05d", "id").alias("claim_id"),
        (F.col("id") % 50 / 50.0).alias("model_anomaly_score"),
        (F.col("id") % 4 / 4.0).alias("rule_score"),
    )
    return written(rows, "scale-scored")


def test_ranking_does_not_shuffle_the_claims(spark):
    """Few different scores: Spark knows so when it plans, and the claims stay where they are."""
    text = plan_of(ensemble.combine_scores(scored(spark)))
    assert text.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in text and "hashpartitioning" not in text


def test_a_looked_up_row_carries_few_scores(spark):
    table = written(ranking.rank_table(spark.range(20_000).select((F.col("id") / 7).alias("s")), "s"), "scale-ranks")
    splits = ranking.lookup_splits(table, [0.5])
    sizes = [len(r["_scores"]) for r in ranking.ecdf_cells(table, splits).collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 3 * ranking.LOOKED_UP


def test_only_donors_that_are_asked_for(spark):
    fields = [F.lit(None).cast("string").alias(c) for c in inject.COPIED_FIELDS if c != "paid_amount"]
    claims = spark.range(9).select(F.col("id").cast("string").alias("claim_id"), F.col("id").cast("double").alias("paid_amount"), *fields)
    key = F.floor(F.col("paid_amount") / 3)
    asked = spark.createDataFrame([(1,), (1,), (7,), (None,)], "donor_key long")
    found = inject.donor_table(claims, key, F.col("paid_amount"), asked).collect()
    assert [(r["donor_key"], r["donor_paid_amount"]) for r in found] == [(1, 3.0)]


def test_copies_are_looked_for_by_a_hash(spark):
    """The claims' fields are not shuffled to count them; zeros of either sign and nulls are equal."""
    fields = {c: F.lit("x") for c in ("beneficiary_id", "provider_id", "claim_type")}
    numbers = {c: F.lit(1).cast("long") for c in ("diagnosis_count", "procedure_count", "units")}
    paid = F.when(F.col("id") == 0, -0.0).when(F.col("id") == 1, 0.0).otherwise(F.col("id"))
    claims = spark.range(5).withColumns({**fields, **numbers, "paid_amount": paid.cast("double"), "service_date": F.lit(None).cast("timestamp")})
    marked = features.with_duplicate_indicator(claims)
    assert "Exchange hashpartitioning(beneficiary_id" not in plan_of(marked)
    assert {r["id"]: r["duplicate_indicator"] for r in marked.collect()} == {0: 1, 1: 1, 2: 0, 3: 0, 4: 0}


def test_trailing_counts_over_long_blocks(spark):
    """Instants on both sides of a block's end see each other; far ones do not."""
    days = [0, 1, 209, 211, 239, 240, 241, 270, 271, 480, 1_000]
    claims = spark.createDataFrame([("P", d) for d in days], "provider_id string, d int")
    claims = claims.select("provider_id", F.timestamp_seconds(F.col("d") * 86_400).alias("service_date"))
    found = {r["_instant"] // 86_400: r["trailing"] for r in features.trailing_counts(claims, "provider_id").collect()}
    assert found == {d: sum(d - 30 <= e <= d for e in days) for d in days}


def test_the_row_check_cleans_each_cell_once(spark):
    source = spark.createDataFrame(
        [("1", "2", "20240101", "20240101", "20240103", "5")],
        "DESYNPUF_ID string, CLM_ID string, CLM_FROM_DT string, CLM_ADMSN_DT string, CLM_THRU_DT string, CLM_PMT_AMT string",
    )
    check = re.findall(r"Filter exists.*", cms.canonical_records(written(source, "scale-extract"), "inpatient")._jdf.queryExecution().optimizedPlan().toString().replace("\n", " "))
    assert len(check) == 1 and check[0].split("Relation")[0].count("trim(") <= 5


def copied_claims(spark):
    """Rows of which two pairs are equal, one with a null; one row differs from a pair in one field only."""
    fields = "claim_id string, beneficiary_id string, provider_id string, claim_type string, service_date timestamp, paid_amount double, diagnosis_count long, procedure_count long, units long, length_of_stay long"
    rows = [("a", "b", "p", "t", None, 1.0, 1, 1, 1, 0), ("c", "b", "p", "t", None, 1.0, 1, 1, 1, 3), ("d", "b", "p", "t", None, 1.0, 1, 1, 2, 0)]
    rows += [("e", None, "q", "t", None, 0.0, 1, 1, 1, 0), ("f", None, "q", "t", None, -0.0, 1, 1, 1, 0), ("g", "q", None, "t", None, 0.0, 1, 1, 1, 0)]
    return written(spark.createDataFrame(rows, fields), "copied")


def test_short_keys_are_broadcast_whatever_their_bytes(spark):
    """Sizes at which Spark's own check would shuffle the claims once more."""
    claims = copied_claims(spark)
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "1b")
        marked = features.with_duplicate_indicator(claims)
        text = plan_of(marked)
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
        donors = plan_of(inject.donor_table(claims, F.col("units"), F.col("claim_id"), written(claims.select(F.col("units").alias("donor_key")), "asked")))
        assert "BroadcastHashJoin" in donors and "SortMergeJoin" not in donors
        assert plan_of(features.claim_features(claims)).count("SortMergeJoin") == 2
        assert {r["claim_id"]: r["duplicate_indicator"] for r in marked.collect()} == {"a": 1, "c": 1, "d": 0, "e": 1, "f": 1, "g": 0}
    finally:
        spark.conf.set(setting, before)


def test_copies_are_told_from_claims_of_the_same_hash(spark):
    for key in (F.lit(7), F.length("provider_id")):
        marked = features.with_duplicate_indicator(copied_claims(spark), key=key)
        assert {r["claim_id"]: r["duplicate_indicator"] for r in marked.collect()} == {"a": 1, "c": 1, "d": 0, "e": 1, "f": 1, "g": 0}


def test_the_queue_check_names_each_problem_once(spark):
    row = ("a", "t", 1.0, 0.5, 0.5, 0.5, 1, ["X"])
    source = spark.createDataFrame([row], "claim_id string, claim_type string, paid_amount double, model_score_percentile double, rule_score double, ensemble_score double, is_flagged int, rule_reason_codes array<string>")
    plan = queue.prepare_queue(written(source, "scale-queue")).select("claim_id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ensemble_score lies outside [0, 1]: ") == 1


def test_numbers_travel_as_one_and_come_back(spark):
    """Small numbers become one; nulls, negative and large ones come back as they are, with their types."""
    rows = [(1, 2, 3), (0, 0, 0), (2**21 - 1, 7, 0), (2**21, 7, 0), (-1, 5, 6), (None, 5, 6), (None, None, None), (2**62, -(2**31), 4)]
    table = spark.createDataFrame(rows, "a bigint, b int, c bigint")
    names = table.columns
    short = table.withColumns(expr.packed(names, "p")).drop(*names)
    assert [r["p"] is None for r in short.collect()] == [False, False, False, True, True, True, True, True]
    again = short.withColumns(expr.unpacked(names, "p", dict(table.dtypes))).select(*names)
    assert again.dtypes == table.dtypes and [tuple(r) for r in again.collect()] == rows


def test_claims_are_shuffled_with_one_number_for_their_counts(spark):
    """The counts of a claim are not among the columns of an exchange of claims; its features are right."""
    claims = copied_claims(spark).withColumns({"units": F.when(F.col("claim_id") == "d", F.lit(2**40)).otherwise(F.col("units"))})
    featured = features.claim_features(claims)
    text = featured._jdf.queryExecution().executedPlan().toString()
    assert "_whole" in text
    for c in ("procedure_count", "length_of_stay"):
        assert not re.search(rf"Exchange hashpartitioning\([^\n]*_instant[^\n]*\n[^\n]*Project \[[^\n]*[^_]{c}#", text)
    assert {r["claim_id"]: (r["units"], r["length_of_stay"]) for r in featured.collect()} == {r["claim_id"]: (r["units"], r["length_of_stay"]) for r in claims.collect()}


def test_row_features_are_not_stored(spark, tmp_path):
    """Features that follow from one row are made when they are read, not written."""
    order = "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp"
    line = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp"
    day = datetime.datetime(2024, 1, 6)
    spark.createDataFrame([(1, 5, day), (2, 5, day)], order).write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(1, 1, 1, 1, 3.0, 10.0, 0.04, 0.02, day), (1, 1, 2, 900_000, 3.0, 20.0, None, 0.02, day), (2, 1, 2, 1, None, 30.0, 0.1, 0.0, None)]
    spark.createDataFrame(lines, line).write.parquet(f"{tmp_path}/lineitem.parquet")
    table = views.featured(spark, str(tmp_path))
    stored = [f for f in table.inputFiles() if "/features-" in f]
    assert stored and "paid_amount_log" not in spark.read.parquet(*stored).columns
    rows = sorted((r["claim_id"], r["units"], r["diagnosis_count"], r["weekend_service"], round(r["paid_amount_log"], 4)) for r in table.collect())
    assert rows == [("CLM-1-1", 3, 4, 1, 2.3979), ("CLM-1-900000", 3, None, 1, 3.0445), ("CLM-2-1", None, 10, 0, 3.434)]
    assert set(views.featured(spark, str(tmp_path), ["claim_id", "paid_amount_log"]).columns) == {"claim_id", "paid_amount_log"}


def test_an_export_is_numbered_where_it_lies(spark, tmp_path):
    """The rows of the files are not shuffled to number them, plain or compressed."""
    rows = spark.range(3_000).select(F.format_string("C%05d", "id").alias("claim_id"), (F.col("id") * 7 % 3_000 / 3_000.0).alias("ensemble_score"))
    for codec in (None, "gzip"):
        path = f"{tmp_path}/{codec}"
        tables.export_queue(rows.repartition(6), path, codec)
        again = tables.read_in_order(spark, path)
        text = plan_of(again)
        assert "Exchange hashpartitioning(claim_id" not in text and "row_number" not in text
        found = [r["claim_id"] for r in again.orderBy("place").collect()]
        assert found == [r["claim_id"] for r in ensemble.by_ensemble(rows).collect()]
        assert sorted(r["place"] for r in again.collect()) == list(range(1, 3_001))
