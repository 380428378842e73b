"""Seeded claims for tests, and whole runs on them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewrank.functions.expr import np_round
from reviewrank.operators.inject import inject_at_rate, uniform
from reviewrank.operators.queue import prepare_queue
from reviewrank.plans.jobs import rank_claims, run_on_claims
from reviewrank.schema import Ranking
from reviewrank.session import written

# Share and median payment per claim type, spread of the payments, count means and
# clips, and the first day of the year that dates fall in.
TYPE_SHARES = {"carrier": 0.42, "inpatient": 0.12, "outpatient": 0.34, "pharmacy": 0.12}
MEDIAN_PAID = {"carrier": 220.0, "inpatient": 8_500.0, "outpatient": 900.0, "pharmacy": 140.0}
PAID_SIGMA = 0.65
COUNTS = {
    "diagnosis_count": (2.4, 1, 12),
    "procedure_count": (1.7, 1, 10),
    "units": (1.3, 1, 12),
    "length_of_stay": (4.2, 1, 30),
}
FIRST_DAY = "2025-01-01"


def _poisson(u: Column, mean: float, low: int, high: int) -> Column:
    """Clipped Poisson count: how many steps of the distribution function lie at or below ``u``."""
    value = F.lit(low).cast("long")
    term, below = math.exp(-mean), 0.0
    for k in range(high):
        below += term
        term *= mean / (k + 1)
        if k >= low:
            value = value + (u >= below).cast("long")
    return value


def _pick(u: Column, values: dict[str, float]) -> Column:
    chosen, below = None, 0.0
    names = list(values)
    for name in names[:-1]:
        below += values[name]
        chosen = F.when(u < below, name) if chosen is None else chosen.when(u < below, name)
    return chosen.otherwise(names[-1])


def plain_claims(spark: SparkSession, rows: int, seed: int) -> DataFrame:
    """Claims without anomalies. Every draw is a hash of row number, purpose and seed, so the table
    does not depend on how it is partitioned."""

    def draw(purpose: str) -> Column:
        return uniform(F.col("id"), purpose, seed)

    def between(purpose: str, low: int, high: int) -> Column:
        return F.lit(low) + F.floor(draw(purpose) * (high - low))

    kinds = spark.range(rows).withColumn("claim_type", _pick(draw("type"), TYPE_SHARES))
    median = F.create_map(*[F.lit(v) for pair in MEDIAN_PAID.items() for v in pair])[F.col("claim_type")]
    normal = F.sqrt(-2 * F.log(1 - draw("normal a"))) * F.cos(2 * math.pi * draw("normal b"))
    counts = {c: _poisson(draw(c), *shape) for c, shape in COUNTS.items()}
    counts["length_of_stay"] = F.when(F.col("claim_type") == "inpatient", counts["length_of_stay"]).otherwise(0)
    return kinds.select(
        F.format_string("CLM-%08d", "id").alias("claim_id"),
        F.format_string("BEN-%06d", between("beneficiary", 1, rows // 3)).alias("beneficiary_id"),
        F.format_string("PRV-%04d", between("provider", 1, max(80, rows // 15))).alias("provider_id"),
        "claim_type",
        F.date_add(F.lit(FIRST_DAY).cast("date"), F.floor(draw("day") * 365).cast("int"))
        .cast("timestamp")
        .alias("service_date"),
        np_round(median * F.exp(PAID_SIGMA * normal), 2).alias("paid_amount"),
        *[c.cast("long").alias(name) for name, c in counts.items()],
    )


def generate_claims(spark: SparkSession, rows: int = 5_000, anomaly_rate: float = 0.04, seed: int = 42) -> DataFrame:
    """Claims with labelled anomalies; the label is for evaluation only."""
    if rows < 100:
        raise ValueError("too few rows")
    if not 0 < anomaly_rate < 0.25:
        raise ValueError("share of anomalies")
    return inject_at_rate(plain_claims(spark, rows, seed), anomaly_rate, seed)


def by_service_date(claims: DataFrame) -> DataFrame:
    return claims.orderBy("service_date", "claim_id")


def train_on_generated(spark: SparkSession, output: str, rows: int, how: Ranking, fmt: str = "parquet") -> dict:
    return run_on_claims(generate_claims(spark, rows, 0.04, how.seed), output, how, fmt)


def demo_queue(spark: SparkSession, rows: int, how: Ranking) -> DataFrame:
    """Generated claims taken all the way to a review queue."""
    return prepare_queue(rank_claims(written(generate_claims(spark, rows, 0.04, how.seed), "claims"), how).scored)
