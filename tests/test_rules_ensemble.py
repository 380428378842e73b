import pytest
from frames import by_id
from pyspark.sql import functions as F

from reviewrank.operators import ensemble
from reviewrank.operators.rules import RULES, rules_with, score_rules

NAMES = [rule.column for rule in RULES]


def one_feature(spark, column, value):
    """One claim whose other features are all 0."""
    quiet = spark.createDataFrame([("X",)], "claim_id string").withColumns({n: F.lit(0.0) for n in NAMES})
    return quiet.withColumn(column, F.lit(value))


def scores(spark, pairs):
    """Claims 0, 1, ... with the given model and rule scores."""
    rows = [(str(i), float(m), float(r)) for i, (m, r) in enumerate(pairs)]
    return spark.createDataFrame(rows, "claim_id string, model_anomaly_score double, rule_score double")


@pytest.mark.parametrize("rule", RULES, ids=NAMES)
def test_each_limit_from_both_sides(spark, rule):
    steps = {-0.25: False, 0.0: True, 0.25: not rule.exact}
    table = None
    for step in steps:
        row = one_feature(spark, rule.column, float(rule.limit) + step).withColumn("claim_id", F.lit(str(step)))
        table = row if table is None else table.unionByName(row)
    found = by_id(score_rules(table), "rule_score", "rule_reason_codes")
    for step, fires in steps.items():
        assert found[str(step)] == ((rule.weight, [rule.code]) if fires else (0.0, []))


def test_codes_keep_the_order_of_the_rules(spark):
    loud = one_feature(spark, NAMES[0], 900.0).withColumns({n: F.lit(1 if "dup" in n else 900) for n in NAMES[1:]})
    assert by_id(score_rules(loud), "rule_score", "rule_reason_codes")["X"] == (1.0, [rule.code for rule in RULES])
    assert by_id(score_rules(loud.select(*reversed(loud.columns))), "rule_score")["X"] == 1.0


def test_another_limit_for_one_rule(spark):
    seven = one_feature(spark, "units", 7)
    assert by_id(score_rules(seven), "rule_score") == {"X": 0.0}
    assert by_id(score_rules(seven, rules_with(units=7)), "rule_score") == {"X": 0.2}
    assert by_id(score_rules(seven, rules_with(units=7.5)), "rule_score") == {"X": 0.0}


@pytest.mark.parametrize("value", [float("nan"), None, "plenty"])
def test_unreadable_features_count_as_zero(spark, value):
    kind = "string" if isinstance(value, str) else "double"
    table = one_feature(spark, "units", 20).withColumn("provider_paid_zscore", F.lit(value).cast(kind))
    assert by_id(score_rules(table), "rule_score") == {"X": 0.2}


def test_rules_refuse_what_they_cannot_read(spark):
    table = one_feature(spark, "units", 1)
    for name in NAMES:
        with pytest.raises(ValueError, match=name):
            score_rules(table.drop(name))
    with pytest.raises(ValueError, match="no rule reads"):
        rules_with(colour=3)
    with pytest.raises(ValueError, match="sum to 1"):
        score_rules(table, RULES[1:])


@pytest.mark.parametrize("weight", [0.0, 0.25, 0.6, 1.0])
def test_blend_by_hand(spark, weight):
    """Five claims, two of them tied in the model score: shares .2, .5, .5, .8, 1."""
    pairs = [(-3, 0.15), (2, 0.0), (2, 0.45), (7, 0.3), (11, 0.1)]
    found = by_id(ensemble.combine_scores(scores(spark, pairs), weight, 0.1), "model_score_percentile", "ensemble_score")
    for i, share in enumerate([0.2, 0.5, 0.5, 0.8, 1.0]):
        assert found[str(i)][0] == share
        assert found[str(i)][1] == pytest.approx(weight * share + (1 - weight) * pairs[i][1], abs=1e-6)


def test_order_of_the_sink(spark):
    rows = ensemble.by_ensemble(ensemble.combine_scores(scores(spark, [(i % 7, (i % 3) / 4) for i in range(30)]))).collect()
    assert [r["ensemble_score"] for r in rows] == sorted((r["ensemble_score"] for r in rows), reverse=True)
    assert all(r["anomaly_score"] == r["ensemble_score"] for r in rows)


@pytest.mark.parametrize("rate", [0.05, 0.1, 0.2])
def test_flags_fit_the_rate_without_ties(spark, rate):
    table = ensemble.combine_scores(scores(spark, [(i * i, 0.0) for i in range(100)]), 1.0, rate)
    assert table.agg(F.sum("is_flagged")).first()[0] == round(100 * rate)


@pytest.mark.parametrize("bad", [{"model_weight": -1e-9}, {"model_weight": 1.5}, {"flag_rate": 0.0}, {"flag_rate": 0.3}])
def test_blend_parameters(spark, bad):
    with pytest.raises(ValueError, match="lies outside"):
        ensemble.combine_scores(scores(spark, [(1, 0), (2, 1)]), **bad)


@pytest.mark.parametrize(
    ("change", "message"),
    [("if(claim_id = 1, -0.01, rule_score)", "outside"), ("if(claim_id = 0, null, rule_score)", "missing"), ("'NaN'", "missing")],
)
def test_blend_refuses_scores(spark, change, message):
    table = scores(spark, [(1, 0), (2, 1)])
    with pytest.raises(ValueError, match=message):
        ensemble.combine_scores(table.withColumn("rule_score", F.expr(change)))


def test_blend_needs_rows_and_columns(spark):
    table = scores(spark, [(1, 0)])
    with pytest.raises(ValueError, match="no scored"):
        ensemble.combine_scores(table.where("false"))
    for name in ("model_anomaly_score", "rule_score"):
        with pytest.raises(ValueError, match=name):
            ensemble.combine_scores(table.drop(name))


def test_ties_at_the_cutoff_are_all_flagged(spark):
    """The threshold is the quantile of the rounded score, and the comparison includes it."""
    table = scores(spark, [(1 if i < 8 else 0, 0) for i in range(20)])
    assert ensemble.combine_scores(table, 0.9, 0.05).agg(F.sum("is_flagged")).first()[0] == 8
