"""Every operator as a named query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewrank.functions.expr import np_round
from reviewrank.operators import ensemble, evaluate, features, forest, inject, queue, ranking, rules, validate
from reviewrank.plans import views
from reviewrank.plans.jobs import rank_claims, run_on_claims
from reviewrank.schema import CLAIM_TYPES, ENRICHED, NUMERIC_FEATURES, QUEUE_COLUMNS
from reviewrank.session import scratch_path, written
from reviewrank.sources import cms, tables
from reviewrank.streaming.scoring import read_enriched_stream, read_scores, start_scoring

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTERED[function.__name__] = function
    return function


def r6(name: str) -> Column:
    return np_round(F.col(name), 6).alias(name)


def joined(name: str) -> Column:
    return F.array_join(name, "|").alias(name)


CANONICAL = [
    "claim_id",
    "source_claim_id",
    "beneficiary_id",
    "provider_id",
    "claim_type",
    "paid_amount",
    "diagnosis_count",
    "procedure_count",
    "units",
    "length_of_stay",
    "source_file_type",
    "source_record_count",
]

# --- ingestion -----------------------------------------------------------------------------------


@query
def collapse_segments(spark, sf_dir):
    claims = views.claims(spark, sf_dir)
    return claims.select(*views.CLAIM_COLUMNS, "source_record_count").withColumn(
        "service_date", views.day_text()
    )


@query
def ingest_carrier_wide(spark, sf_dir):
    claims = cms.adapt_cms(views.wide_carrier(spark, sf_dir), "Carrier")
    return claims.select(*CANONICAL, views.day_text())


@query
def ingest_facility(spark, sf_dir):
    claims = cms.adapt_cms(views.wide_facility(spark, sf_dir), "inpatient")
    return claims.select(*CANONICAL, views.day_text())


@query
def ingest_pharmacy(spark, sf_dir):
    claims = cms.adapt_cms(views.wide_pharmacy(spark, sf_dir), "pde")
    return claims.select(*CANONICAL, views.day_text())


@query
def ingest_source_problems(spark, sf_dir):
    """The pharmacy extract with some ids and dates spoilt."""
    source = views.wide_pharmacy(spark, sf_dir)
    spoilt = source.withColumns(
        {
            "DESYNPUF_ID": F.when(F.col("DESYNPUF_ID").cast("long") % 13 == 0, " nan ").otherwise(F.col("DESYNPUF_ID")),
            "SRVC_DT": F.when(F.col("DESYNPUF_ID").cast("long") % 17 == 0, F.concat(F.lit("day "), "DESYNPUF_ID")).otherwise(F.col("SRVC_DT")),
        }
    )
    found = cms.source_problems(spoilt, "pharmacy")
    return found.select("problem", "rows", F.array_join("examples", "|").alias("examples"))


@query
def validate_report(spark, sf_dir):
    """Uncollapsed records, so that repeated claim ids show up; figures shifted to break rules."""
    shifted = views.records(spark, sf_dir).withColumns(
        {
            "paid_amount": F.col("paid_amount") - 2_000,
            "units": F.col("units") - 1 - F.col("ln"),
            "provider_id": F.when(F.col("l_suppkey") % 10 != 0, F.col("provider_id")),
        }
    )
    return validate.validation_report(shifted)


@query
def inject_anomalies(spark, sf_dir):
    table = views.injected(spark, sf_dir)
    return table.select(
        *views.CLAIM_COLUMNS, "is_injected_anomaly", "anomaly_scenario"
    ).withColumn("service_date", views.day_text())


@query
def inject_at_rate(spark, sf_dir):
    """An exact share of anomalies with random scenarios, strengths and donors."""
    table = inject.inject_at_rate(views.claims(spark, sf_dir), rate=0.04, seed=7)
    return table.select(
        *views.CLAIM_COLUMNS, "is_injected_anomaly", "anomaly_scenario"
    ).withColumn("service_date", views.day_text())


@query
def csv_claims(spark, sf_dir):
    """Claims written as CSV and read back by name and type."""
    path = scratch_path(spark, "csv-claims")
    tables.write_claims(views.claims(spark, sf_dir), path, "csv")
    claims = tables.read_claims(spark, path, "csv")
    return claims.select(*views.CLAIM_COLUMNS, "source_record_count").withColumn(
        "service_date", views.day_text()
    )


@query
def csv_ingest_pharmacy(spark, sf_dir):
    """The pharmacy extract as a CSV file, through the header check and the adapter."""
    path = scratch_path(spark, "csv-pharmacy")
    tables.write_claims(views.wide_pharmacy(spark, sf_dir), path, "csv")
    claims = cms.ingest_cms_csv(spark, path, "prescription")
    return claims.select(*CANONICAL, views.day_text())


# --- features and rules --------------------------------------------------------------------------


@query
def rolling_provider_30d(spark, sf_dir):
    counted = features.with_trailing_count(views.claims(spark, sf_dir), "provider_id", "provider_claim_count_30d")
    return counted.select("claim_id", "provider_claim_count_30d")


@query
def rolling_beneficiary_30d(spark, sf_dir):
    counted = features.with_trailing_count(
        views.claims(spark, sf_dir), "beneficiary_id", "beneficiary_claim_count_30d"
    )
    return counted.select("claim_id", "beneficiary_claim_count_30d")


@query
def rolling_arrival_ties(spark, sf_dir):
    counted = features.with_trailing_count(
        views.claims(spark, sf_dir), "provider_id", "provider_claim_count_30d", ties="arrival"
    )
    return counted.select("claim_id", "provider_claim_count_30d")


@query
def rolling_provider_90d(spark, sf_dir):
    counted = features.with_trailing_count(views.claims(spark, sf_dir), "provider_id", "provider_claim_count", days=90)
    return counted.select("claim_id", "provider_claim_count")


@query
def duplicate_indicator(spark, sf_dir):
    marked = features.with_duplicate_indicator(views.injected(spark, sf_dir))
    return marked.select("claim_id", "duplicate_indicator")


@query
def provider_zscore(spark, sf_dir):
    scored = features.with_provider_zscore(views.injected(spark, sf_dir))
    return scored.select("claim_id", r6("provider_paid_zscore"))


@query
def row_features(spark, sf_dir):
    table = features.with_row_features(views.injected(spark, sf_dir))
    return table.select("claim_id", r6("paid_amount_log"), "weekend_service")


@query
def claim_features(spark, sf_dir):
    table = views.featured(spark, sf_dir)
    exact = [c for c in NUMERIC_FEATURES if c not in ("paid_amount_log", "provider_paid_zscore")]
    return table.select("claim_id", "claim_type", *exact, r6("paid_amount_log"), r6("provider_paid_zscore"))


@query
def rule_score(spark, sf_dir):
    return rules.score_rules(views.featured(spark, sf_dir), views.RULES).select("claim_id", "rule_score")


@query
def rule_score_default(spark, sf_dir):
    return rules.score_rules(views.featured(spark, sf_dir)).select("claim_id", "rule_score")


@query
def reason_codes(spark, sf_dir):
    scored = rules.score_rules(views.featured(spark, sf_dir), views.RULES)
    return scored.select("claim_id", joined("rule_reason_codes"))


# --- ranks and quantiles -------------------------------------------------------------------------


@query
def avg_rank_pct(spark, sf_dir):
    ranked = ranking.with_avg_rank_pct(views.amount_only(spark, sf_dir), "model_anomaly_score", "share")
    return ranked.select("claim_id", np_round(F.col("share"), 6).alias("score_percentile"))


@query
def ecdf_percentile(spark, sf_dir):
    """Carrier claims are the reference; all claims are looked up in it."""
    table = views.amount_only(spark, sf_dir)
    carrier = table.filter("claim_type = 'carrier'")
    splits = ranking.split_points(carrier, ["model_anomaly_score"])["model_anomaly_score"]
    cells = ranking.ecdf_cells(ranking.rank_table(carrier, "model_anomaly_score", splits=splits), splits)
    placed = ranking.with_ecdf_percentile(table, "model_anomaly_score", cells, splits, "share")
    return placed.select("claim_id", np_round(F.col("share"), 6).alias("model_score_percentile"))


@query
def quantile_flag(spark, sf_dir):
    flagged = ranking.with_quantile_flag(
        views.amount_only(spark, sf_dir), "model_anomaly_score", 0.05, "model_is_flagged"
    )
    return flagged.select("claim_id", "model_is_flagged")


@query
def feature_statistics(spark, sf_dir):
    """What the model preparation learns: median, mean and deviation of each numeric feature."""
    info = forest.fit_preparation(views.featured(spark, sf_dir))
    rows = [(n["name"], float(n["median"]), float(n["mean"]), float(n["scale"])) for n in info["numeric"]]
    table = spark.createDataFrame(rows, "feature string, median double, mean double, scale double")
    return table.select("feature", r6("median"), r6("mean"), r6("scale"))


@query
def model_matrix(spark, sf_dir):
    """The model inputs: imputed and scaled numbers, and the claim type as the 0/1 columns it stands for."""
    table = views.featured(spark, sf_dir, ["claim_id", *NUMERIC_FEATURES, forest.CATEGORICAL_FEATURE])
    info = forest.fit_preparation(table)
    numbers = [np_round(c, 4).alias(n["name"]) for n, c in zip(info["numeric"], forest.prepared_columns(info))]
    kind = forest.category_column(info)
    return table.select("claim_id", *numbers, *[(kind == c).cast("double").alias(f"is_{c}") for c in CLAIM_TYPES])


@query
def category_counts(spark, sf_dir):
    return queue.claim_type_mix(views.injected(spark, sf_dir))


# --- ensemble and evaluation ---------------------------------------------------------------------


def _ranked(spark: SparkSession, sf_dir: str, columns: list[str] | None = None, codec: str | None = None) -> DataFrame:
    """Ranked claims; ``columns`` are what a query reads of them, where it doesn't read them all."""
    return ensemble.combine_scores(views.ruled(spark, sf_dir, columns, codec), 0.90, 0.05)


#: What a queue shows of a claim besides its scores.
SHOWN = ["claim_id", "claim_type", "paid_amount"]


def _ranked_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What metrics read of the ranked claims as a written table, for queries that read them several times."""
    scores = ["model_anomaly_score", "rule_score", "ensemble_score", "anomaly_score"]
    return written(_ranked(spark, sf_dir).select("claim_id", evaluate.LABEL, *scores, "is_flagged"), "ranked")


@query
def ensemble_rank(spark, sf_dir):
    return _ranked(spark, sf_dir).select(
        "claim_id", "model_score_percentile", "ensemble_score", "is_flagged", "score_percentile", "anomaly_score"
    )


@query
def ensemble_cutoff(spark, sf_dir):
    blended = ensemble.blend(views.ruled(spark, sf_dir), 0.90)
    return ensemble.ensemble_threshold(blended, 0.05).select(np_round(F.col("quantile"), 6).alias("ensemble_threshold"))


@query
def top_k_claims(spark, sf_dir):
    """The 200 best by rule score; ties go by ensemble score, then by claim id."""
    best = evaluate.top_k(_ranked(spark, sf_dir), "rule_score", 200)
    return best.select("claim_id", "rule_score", "ensemble_score")


@query
def precision_recall_at_k(spark, sf_dir):
    metrics = evaluate.evaluate_ranking(_ranked_once(spark, sf_dir), "anomaly_score", 200, unit_grid=True)
    return metrics.select(
        "rows", "injected_anomalies", "top_k", "true_positives_at_k", "precision_at_k", "recall_at_k"
    )


@query
def roc_auc(spark, sf_dir):
    table = ranking.rank_table(views.amount_only(spark, sf_dir), "model_anomaly_score", "is_injected_anomaly")
    return evaluate.curve_metrics(table).select("rows", "injected_anomalies", "roc_auc")


@query
def average_precision(spark, sf_dir):
    table = ranking.rank_table(views.amount_only(spark, sf_dir), "model_anomaly_score", "is_injected_anomaly")
    return evaluate.curve_metrics(table).select("average_precision")


@query
def compare_strategies(spark, sf_dir):
    return evaluate.compare_strategies(_ranked_once(spark, sf_dir), 200)


@query
def evaluate_flagged(spark, sf_dir):
    return evaluate.evaluate_flagged(_ranked_once(spark, sf_dir), 200)


# --- review queue --------------------------------------------------------------------------------


def _text_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked claims as a scored text file may hold them: flags and codes written in several ways."""
    ranked = _ranked(spark, sf_dir, [*SHOWN, "ok", evaluate.LABEL])
    codes, form = F.col("rule_reason_codes"), F.col("ok") % 3
    quoted = F.transform(codes, lambda c: F.concat(F.lit("'"), c, F.lit("'")))
    yes = F.when(form == 0, "True").when(form == 1, "1").otherwise(" yes ")
    no = F.when(form == 0, "False").when(form == 1, "0").otherwise("NO")
    return ranked.withColumns(
        {
            "is_flagged": F.when(F.col("is_flagged") == 1, yes).otherwise(no),
            "rule_reason_codes": F.when(form == 0, F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")))
            .when(form == 1, F.array_join(codes, "|"))
            .otherwise(F.array_join(codes, " , ")),
            "paid_amount": F.col("paid_amount").cast("string"),
        }
    )


@query
def queue_prepare(spark, sf_dir):
    prepared = queue.prepare_queue(_text_queue(spark, sf_dir))
    return prepared.select(
        "claim_id",
        "claim_type",
        np_round(F.col("paid_amount"), 2).alias("paid_amount"),
        *["model_score_percentile", "rule_score", "ensemble_score", "is_flagged"],
        joined("rule_reason_codes"),
        "reason_codes_display",
        "is_injected_anomaly",
    )


@query
def csv_scored_queue(spark, sf_dir):
    """Ranked claims written as CSV (codes as list text) and read back as a queue."""
    path = scratch_path(spark, "csv-scored")
    tables.write_scored(_ranked(spark, sf_dir, codec="zstd"), path, "csv", compression="gzip")
    again = tables.read_scored_csv(spark, path)
    return again.select(
        "claim_id", "claim_type", "ensemble_score", "is_flagged", joined("rule_reason_codes"), "is_injected_anomaly"
    )


def _queue(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    return queue.prepare_queue(_ranked(spark, sf_dir, columns))


@query
def queue_filter(spark, sf_dir):
    kept = queue.filter_queue(
        _queue(spark, sf_dir),
        claim_types=["carrier", "inpatient"],
        minimum_score=0.5,
        flagged_only=True,
        reason_codes=["EXCESS_UNITS", "POSSIBLE_DUPLICATE"],
    )
    return ensemble.by_ensemble(kept).select("claim_id", "claim_type", "ensemble_score", joined("rule_reason_codes"))


@query
def export_queue_order(spark, sf_dir):
    """The filtered queue exported as CSV: each claim with its place in the files."""
    path = scratch_path(spark, "export")
    kept = queue.filter_queue(_queue(spark, sf_dir, SHOWN), minimum_score=0.3, flagged_only=False)
    tables.export_queue(kept.select(*QUEUE_COLUMNS), path, compression="gzip")
    again = tables.read_in_order(spark, path)
    return again.select("place", "claim_id", "ensemble_score", "is_flagged", "rule_reason_codes")


@query
def metrics_document(spark, sf_dir):
    """The metrics of a ranking written as one JSON document and read back."""
    path, ranked = scratch_path(spark, "metrics"), _ranked_once(spark, sf_dir)
    tables.write_metrics(evaluate.evaluate_flagged(ranked, 200), evaluate.compare_strategies(ranked, 200), path)
    return tables.read_metrics(spark, path)


@query
def queue_kpis(spark, sf_dir):
    return queue.summarize_queue(_queue(spark, sf_dir))


@query
def queue_kpis_visible(spark, sf_dir):
    """Figures of the default view (flagged claims only): the flagship query."""
    return queue.summarize_queue(queue.filter_queue(_queue(spark, sf_dir)))


@query
def queue_display(spark, sf_dir):
    shown = queue.display_queue(_queue(spark, sf_dir))
    return shown.withColumn("Paid amount", np_round(F.col("Paid amount"), 2))


@query
def queue_detail(spark, sf_dir):
    """All fields of every flagged claim, one row per field; the z-score as text of four digits."""
    score = F.format_string("%.4f", F.round("provider_paid_zscore", 4) + F.lit(0.0))
    visible = queue.filter_queue(_queue(spark, sf_dir)).withColumns(
        {"service_date": F.to_date("service_date"), "provider_paid_zscore": score}
    )
    return queue.claim_details(visible)


@query
def claim_signals(spark, sf_dir):
    flagged = queue.filter_queue(_queue(spark, sf_dir))
    return queue.claim_signals(flagged).select(
        "claim_id", np_round(F.col("paid_amount"), 2).alias("paid_amount"), "ensemble_score", joined("review_signals")
    )


@query
def score_agreement(spark, sf_dir):
    points = queue.agreement_points(_queue(spark, sf_dir))
    return points.withColumn("paid_amount", np_round(F.col("paid_amount"), 2))


@query
def reason_code_list(spark, sf_dir):
    return queue.reason_code_list(rules.score_rules(views.featured(spark, sf_dir), views.RULES))


@query
def claim_type_list(spark, sf_dir):
    return queue.claim_type_list(views.claims(spark, sf_dir))


@query
def score_histogram(spark, sf_dir):
    return queue.score_histogram(_queue(spark, sf_dir))


@query
def claim_type_mix(spark, sf_dir):
    return queue.claim_type_mix(queue.filter_queue(_queue(spark, sf_dir)))


# --- enriched claims and the model ---------------------------------------------------------------


def enriched(table: DataFrame) -> DataFrame:
    return table.select(*[F.col(f.name).cast(f.dataType) for f in ENRICHED.fields])


@query
def enriched_split(spark, sf_dir):
    """Enriched claims with some fields spoilt, and the fields that break the contract."""
    spoilt = views.featured(spark, sf_dir).withColumns(
        {
            "claim_type": F.when(F.col("ok") % 17 == 0, "dental").otherwise(F.col("claim_type")),
            "paid_amount": F.when(F.col("ok") % 19 == 0, -1.0).otherwise(F.col("paid_amount")),
            "provider_claim_count_30d": F.when(F.col("ok") % 23 == 0, 0).otherwise(F.col("provider_claim_count_30d")),
            "weekend_service": F.when(F.col("ok") % 29 == 0, 2).otherwise(F.col("weekend_service")),
            "units": F.when(F.col("ok") % 31 == 0, None).otherwise(F.col("units")),
        }
    )
    valid, rejected = validate.split_enriched(enriched(spoilt))
    kept = valid.select("claim_id", F.lit(True).alias("accepted"), F.lit("").alias("broken_rules"))
    return kept.unionByName(
        rejected.select("claim_id", F.lit(False).alias("accepted"), F.array_join("broken_rules", "|").alias("broken_rules"))
    )


def _trained(spark: SparkSession, sf_dir: str):
    """The model, and what it and the enriched claims have of the claims."""
    return forest.train_model(views.featured(spark, sf_dir, [*dict.fromkeys([*ENRICHED.fieldNames(), *NUMERIC_FEATURES])]))


@query
def forest_nodes(spark, sf_dir):
    """All nodes of a trained forest. Thresholds are in units of the scaled features."""
    table = views.featured(spark, sf_dir)
    info, nodes = forest.grow_forest(table, forest.fit_preparation(table), forest.TREES, forest.SAMPLE, seed=42)
    return nodes.select(
        "tree_id", "node_id", "feature", np_round(F.col("threshold"), 4).alias("threshold"), "category", "size", "depth"
    )


@query
def iforest_scores(spark, sf_dir):
    model, raw = _trained(spark, sf_dir)
    return forest.with_model_columns(raw, model).select(
        "claim_id", r6("model_anomaly_score"), "model_is_flagged", "model_score_percentile"
    )


@query
def strategy_metrics_of_run(spark, sf_dir):
    """Claims taken through the whole run, and the three strategies' metrics."""
    claims = views.injected(spark, sf_dir)
    ranked = rank_claims(claims.select(*views.CLAIM_COLUMNS, "is_injected_anomaly", "anomaly_scenario"))
    return ranked.comparison


@query
def run_facts(spark, sf_dir):
    """A whole run from stored claims to a saved model, and what it left; the model is saved once more over
    the tables that it was loaded from, and scores as before."""
    folder, claims = scratch_path(spark, "run"), views.injected(spark, sf_dir)
    run_on_claims(claims.select(*views.CLAIM_COLUMNS, "is_injected_anomaly", "anomaly_scenario"), folder)
    model = forest.load_model(spark, f"{folder}/model")
    forest.save_model(model, f"{folder}/model")
    table = tables.read_claims(spark, f"{folder}/scored")  # claims with their features, ids unique
    first = forest.with_raw_score(table, model).withColumnRenamed("model_anomaly_score", "again")
    same = forest.with_raw_score(first, forest.load_model(spark, f"{folder}/model"))
    changed = same.agg(F.count_if(~F.col("again").eqNullSafe(F.col("model_anomaly_score"))).cast("string").alias("value"))
    saved = changed.select(F.lit("saved again").alias("stage"), F.lit("changed_scores").alias("fact"), "value")
    return spark.read.parquet(f"{folder}/facts").unionByName(saved)


@query
def stream_scoring(spark, sf_dir):
    """Enriched claims as files, scored by a stream that stops when it has read them all; the model goes
    through its saved form."""
    model, raw = _trained(spark, sf_dir)
    ruled = rules.score_rules(forest.with_model_columns(raw, model))
    cutoff = ensemble.ensemble_threshold(ensemble.blend(ruled)).first()["quantile"]
    folder = scratch_path(spark, "stream")
    forest.save_model(model.with_threshold(cutoff), f"{folder}/model")
    enriched(raw).write.parquet(f"{folder}/in")
    stream = read_enriched_stream(spark, f"{folder}/in", files_per_batch=2)
    start_scoring(stream, forest.load_model(spark, f"{folder}/model"), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return read_scores(spark, f"{folder}/out").withColumn("reason_codes", joined("reason_codes"))
