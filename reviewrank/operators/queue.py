"""Review queue: preparation, filters, figures and views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewrank.functions.expr import (
    np_round,
    number,
    parse_flag,
    parse_reason_codes,
    reason_badges,
    reason_display,
    sound,
)
from reviewrank.schema import QUEUE_COLUMNS, QUEUE_SCORE_COLUMNS, require_columns


def _problems(scored: DataFrame) -> list[Column]:
    """Per checked column: what is wrong with its value, or null."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("null"))

    paid = F.col("paid_amount").isNotNull() & number(scored, "paid_amount").isNull()
    out = [F.when(paid, F.concat(F.lit("paid_amount is not a number: "), shown("paid_amount")))]
    for name in QUEUE_SCORE_COLUMNS:
        inside = F.coalesce(number(scored, name).between(0.0, 1.0), F.lit(False))
        out.append(F.when(~inside, F.concat(F.lit(f"{name} lies outside [0, 1]: "), shown(name))))
    no_flag = parse_flag(scored, "is_flagged").isNull()
    return [*out, F.when(no_flag, F.concat(F.lit("not a review flag: "), shown("is_flagged")))]


def _checked(problems: list[Column]) -> Column:
    """``sound``, with the problem bound in a lambda. Written out, the problems stand in the condition twice, and it becomes
    a method too long for the JVM to compile, which then runs in its interpreter."""
    return F.exists(F.array(F.coalesce(*problems)), lambda found: sound([found]))


def _or_stop(value: Column, message: str, kind: str) -> Column:
    """The value; where it is null the job stops, also if a filter on the value comes before the check."""
    return F.coalesce(value, F.raise_error(F.lit(message)).cast(kind))


def prepare_queue(scored: DataFrame) -> DataFrame:
    """Typed and checked queue rows. A value that breaks the contract stops the job from inside
    the plan, whatever columns are read later, so no checking pass is needed. The result is not sorted;
    see ``by_ensemble``."""
    require_columns(scored, QUEUE_COLUMNS, "the queue lacks columns")
    changed = {
        "claim_id": F.col("claim_id").cast("string"),
        "claim_type": F.col("claim_type").cast("string"),
        "paid_amount": number(scored, "paid_amount"),
        **{c: _or_stop(number(scored, c), f"{c} lies outside [0, 1]: no number", "double") for c in QUEUE_SCORE_COLUMNS},
        "is_flagged": _or_stop(parse_flag(scored, "is_flagged"), "not a review flag: none", "boolean"),
        "rule_reason_codes": parse_reason_codes(scored, "rule_reason_codes"),
    }
    if "service_date" in scored.columns:
        changed["service_date"] = F.col("service_date").try_cast("timestamp")
    if "is_injected_anomaly" in scored.columns:
        label = F.coalesce(number(scored, "is_injected_anomaly"), F.lit(0.0))
        changed["is_injected_anomaly"] = label.cast("int")
    prepared = scored.where(_checked(_problems(scored))).withColumns(changed)
    return prepared.withColumn("reason_codes_display", reason_display(F.col("rule_reason_codes")))


def filter_queue(
    queue: DataFrame,
    claim_types: list[str] | None = None,
    minimum_score: float = 0.0,
    flagged_only: bool = True,
    reason_codes: list[str] | None = None,
) -> DataFrame:
    """All conditions must hold; an empty list means no condition."""
    kept = F.col("ensemble_score") >= minimum_score
    if flagged_only:
        kept = kept & F.col("is_flagged")
    if claim_types:
        kept = kept & F.col("claim_type").isin(list(claim_types))
    if reason_codes:
        wanted = F.array(*[F.lit(c) for c in reason_codes])
        kept = kept & F.arrays_overlap("rule_reason_codes", wanted)
    return queue.filter(kept)


def summarize_queue(queue: DataFrame) -> DataFrame:
    """One row of figures; injected totals only where the queue is labelled."""
    flagged = F.col("is_flagged")
    figures = [
        F.count(F.lit(1)).alias("claims"),
        F.count_if(flagged).alias("flagged_claims"),
        np_round(F.coalesce(F.sum(F.when(flagged, F.col("paid_amount"))), F.lit(0.0)), 2).alias(
            "review_paid_amount"
        ),
        np_round(F.coalesce(F.avg("ensemble_score"), F.lit(0.0)), 6).alias("average_ensemble_score"),
    ]
    if "is_injected_anomaly" in queue.columns:
        label = F.col("is_injected_anomaly").cast("long")
        figures += [
            F.coalesce(F.sum(label), F.lit(0)).alias("injected_scenarios"),
            F.coalesce(F.sum(F.when(flagged, label)), F.lit(0)).alias("flagged_injected_scenarios"),
        ]
    return queue.agg(*figures)


def reason_code_list(queue: DataFrame) -> DataFrame:
    codes = queue.select(F.explode("rule_reason_codes").alias("reason_code"))
    return codes.distinct().orderBy("reason_code")


def claim_type_list(queue: DataFrame) -> DataFrame:
    return queue.select("claim_type").filter(F.col("claim_type").isNotNull()).distinct().orderBy("claim_type")


def score_histogram(queue: DataFrame) -> DataFrame:
    """Claims per tenth of [0, 1]; bands are closed on the right, the first also holds 0, and empty
    bands are kept: every band is seeded with a zero row that the sum absorbs."""
    edges = [i / 10 for i in range(11)]
    names = [f"({-0.001 if i == 0 else edges[i]}, {edges[i + 1]}]" for i in range(10)]
    score = F.col("ensemble_score")
    band = F.when(score < 0, F.lit(None).cast("int"))
    for i in range(10):
        band = band.when(score <= edges[i + 1], F.lit(i))
    counted = queue.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("claims"))
    seeds = queue.sparkSession.range(10).select(F.col("id").cast("int").alias("band"), F.lit(0).alias("claims"))
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("band") + 1)
    return (
        counted.filter("band is not null")
        .unionByName(seeds)
        .groupBy("band")
        .agg(F.sum("claims").alias("claims"))
        .select("band", label.alias("score_band"), "claims")
        .orderBy("band")
    )


def claim_type_mix(queue: DataFrame) -> DataFrame:
    counted = queue.filter(F.col("claim_type").isNotNull()).groupBy("claim_type")
    return counted.agg(F.count(F.lit(1)).alias("claims")).orderBy(F.col("claims").desc(), "claim_type")


# Heads of the queue table, and of the single-claim view.
DISPLAY_COLUMNS = {
    "claim_id": "Claim ID",
    "claim_type": "Claim type",
    "paid_amount": "Paid amount",
    "model_score_percentile": "Model percentile",
    "rule_score": "Rule score",
    "ensemble_score": "Ensemble score",
    "is_flagged": "Flagged",
    "reason_codes_display": "Review signals",
}
DETAIL_COLUMNS = {
    "claim_type": "Claim type",
    "service_date": "Service date",
    "provider_id": "Provider",
    "beneficiary_id": "Beneficiary",
    "units": "Units",
    "provider_claim_count_30d": "Provider claims · 30d",
    "beneficiary_claim_count_30d": "Beneficiary claims · 30d",
    "provider_paid_zscore": "Provider paid z-score",
    "duplicate_indicator": "Duplicate indicator",
    "weekend_service": "Weekend service",
}


def display_queue(queue: DataFrame) -> DataFrame:
    return queue.select(*[F.col(c).alias(head) for c, head in DISPLAY_COLUMNS.items()])


def claim_details(queue: DataFrame, keep: Column | None = None) -> DataFrame:
    """``claim_id, Field, Value`` for the claims that ``keep`` selects (all without it)."""
    chosen = queue if keep is None else queue.filter(keep)
    present = {c: head for c, head in DETAIL_COLUMNS.items() if c in queue.columns}
    pairs = [F.struct(F.lit(h).alias("Field"), F.col(c).cast("string").alias("Value")) for c, h in present.items()]
    return chosen.select("claim_id", F.inline(F.array(*pairs)))


def claim_signals(queue: DataFrame) -> DataFrame:
    """The four score figures of a claim and its reasons in words."""
    return queue.select(
        "claim_id",
        "paid_amount",
        *QUEUE_SCORE_COLUMNS,
        reason_badges(F.col("rule_reason_codes")).alias("review_signals"),
    )


def agreement_points(queue: DataFrame) -> DataFrame:
    """Model percentile against rule score, for a scatter chart."""
    return queue.select("claim_id", "model_score_percentile", "rule_score", "claim_type", "paid_amount")

