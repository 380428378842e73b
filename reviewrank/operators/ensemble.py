"""Blend of model rank and rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewrank.functions.expr import np_round, number
from reviewrank.operators.ranking import average_rank_share, quantile_of, rank_table, with_avg_rank_pct
from reviewrank.schema import check_rate, check_weight, require_columns
from reviewrank.session import written


def check_scores(scored: DataFrame) -> None:
    """Raise for an empty table, a missing score, or a rule score outside [0, 1]; one pass."""
    model, rule = number(scored, "model_anomaly_score"), number(scored, "rule_score")
    found = scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(model.isNull() | rule.isNull()).alias("missing"),
        F.count_if((rule < 0) | (rule > 1)).alias("outside"),
    ).first()
    if not found["rows"]:
        raise ValueError("there are no scored claims")
    if found["missing"]:
        raise ValueError("some scores are missing or no numbers")
    if found["outside"]:
        raise ValueError("some rule scores lie outside [0, 1]")


def blend(scored: DataFrame, model_weight: float = 0.90, table: DataFrame | None = None) -> DataFrame:
    """Adds ``model_score_percentile`` (average rank share) and ``ensemble_score``.

    ``table`` is the rank table of the model scores of just these rows, where there already is one.
    """
    check_weight(model_weight)
    require_columns(scored, ["model_anomaly_score", "rule_score"], "the blend lacks scores")
    check_scores(scored)
    typed = scored.withColumns(
        {c: number(scored, c) for c in ["model_anomaly_score", "rule_score"]}
    ).drop("model_score_percentile")
    if table is None:  # written, so that Spark knows its size when it plans the join
        table = written(rank_table(typed, "model_anomaly_score"), "model-ranks")
    ranked = with_avg_rank_pct(typed, "model_anomaly_score", "_share", table)
    score = F.lit(model_weight) * F.col("_share") + F.lit(1.0 - model_weight) * F.col("rule_score")
    return ranked.withColumns(
        {"model_score_percentile": np_round(F.col("_share"), 6), "ensemble_score": np_round(score, 6)}
    ).drop("_share")


def ensemble_threshold(blended: DataFrame, flag_rate: float = 0.05) -> DataFrame:
    """One row with the ``1 - flag_rate`` quantile of the rounded ensemble score."""
    check_rate(flag_rate, "flag_rate")
    return quantile_of(rank_table(blended, "ensemble_score", unit_grid=True), 1 - flag_rate)


def flag_and_rank(blended: DataFrame, flag_rate: float = 0.05) -> DataFrame:
    """Adds ``is_flagged``, ``score_percentile`` and ``anomaly_score``.

    Both follow from the score alone, so they are computed on the distinct scores and joined back.
    ``blend`` leaves scores in [0, 1] with 6 digits, so these are at most 1,000,001 short rows,
    however many claims there are. They are written, so that Spark knows their size when it plans the join
    and broadcasts them where it allows; the claims are not shuffled then.
    """
    check_rate(flag_rate, "flag_rate")
    table = written(rank_table(blended, "ensemble_score", unit_grid=True), "ensemble-ranks")
    threshold = quantile_of(table, 1 - flag_rate).scalar()
    flagged = table.select(
        F.col("score").alias("_score"),
        (F.col("score") >= threshold).cast("int").alias("is_flagged"),
        np_round(average_rank_share(), 6).alias("score_percentile"),
    )
    places = written(flagged, "places")
    return (
        blended.join(places, F.col("ensemble_score") == F.col("_score"), "left")
        .drop("_score")
        .withColumn("anomaly_score", F.col("ensemble_score"))
    )


def combine_scores(scored: DataFrame, model_weight: float = 0.90, flag_rate: float = 0.05) -> DataFrame:
    """Blend, flag and rank. The result is not sorted; sort at the sink (``by_ensemble``).

    The blend is computed twice, with its score alone for the ranks and with the rows: a projection and
    a join with the model ranks, which costs less than writing all rows. ``scored`` should be a stored table.
    """
    check_rate(flag_rate, "flag_rate")
    return flag_and_rank(blend(scored, model_weight), flag_rate)


def by_ensemble(scored: DataFrame) -> DataFrame:
    """Highest score first; the claim id makes the order total."""
    return scored.orderBy(F.col("ensemble_score").desc(), F.col("claim_id"))
