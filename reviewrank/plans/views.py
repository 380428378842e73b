"""The test tables seen as claims: order lines are records, and lines with the same number are the
segments of one claim."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewrank.operators.features import ROW_FEATURES, claim_features, with_row_features
from reviewrank.operators.inject import COPIED_FIELDS, SCENARIOS, donor_table, inject
from reviewrank.operators.rules import rules_with, score_rules
from reviewrank.session import written
from reviewrank.sources.cms import collapse_segments

# Columns of a wide carrier extract that come once per record, in the order that sorts records of one line.
CARRIER_CELLS = {
    "HCPCS_CD": "l_partkey",
    "PRF_PHYSN_NPI": "l_suppkey",
    "LINE_NCH_PMT_AMT": "l_extendedprice",
    "ICD9_DGNS_CD": "l_discount",
}
# Limits at which every rule fires on the test tables.
LIMITS = {
    "provider_paid_zscore": 1.6,
    "units": 48,
    "provider_claim_count_30d": 13,
    "beneficiary_claim_count_30d": 5,
}
RULES = rules_with(**LIMITS)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def _claim_type(key: Column) -> Column:
    kind = F.when(key % 4 == 0, "carrier").when(key % 4 == 1, "inpatient")
    return kind.when(key % 4 == 2, "outpatient").otherwise("pharmacy")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    return order_lines(spark, sf_dir).select(
        F.concat_ws("-", F.lit("CLM"), key, line).alias("claim_id"),
        F.concat(F.lit("BEN-"), F.col("o_custkey")).alias("beneficiary_id"),
        F.concat(F.lit("PRV-"), F.col("l_suppkey")).alias("provider_id"),
        _claim_type(key).alias("claim_type"),
        F.col("l_shipdate").cast("timestamp").alias("service_date"),
        F.col("l_extendedprice").alias("paid_amount"),
        F.round(F.col("l_discount") * 100).cast("long").alias("diagnosis_count"),
        F.round(F.col("l_tax") * 100).cast("long").alias("procedure_count"),
        F.col("l_quantity").cast("long").alias("units"),
        F.when(key % 4 == 1, line).otherwise(0).cast("long").alias("length_of_stay"),
        key.alias("ok"),
        line.alias("ln"),
        "l_partkey",
        "l_suppkey",
    )


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.struct("l_partkey", "l_suppkey", "service_date", "paid_amount", "units")
    collapsed = collapse_segments(records(spark, sf_dir), order, carried=["ok", "ln", "claim_type"])
    return written(collapsed, "claims")  # later steps read the claims several times


def injected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims with labelled anomalies, chosen by arithmetic so that SQL can repeat it. A copied claim
    takes the fields of the first line of its order."""
    base = claims(spark, sf_dir)
    ok, ln = F.col("ok"), F.col("ln")
    names = F.array(*[F.lit(s) for s in SCENARIOS])
    table = inject(
        base,
        picked=(ok * 7 + ln) % 25 == 0,
        scenario=F.element_at(names, ((ok + ln) % 4 + 1).cast("int")),
        donors=lambda asked: donor_table(base, ok, ln, asked),
        donor_key=ok,
        paid_factor=F.lit(12.0),
        spike_factor=F.lit(4.0),
        new_units=60 + ln,
        spike_procedures=F.lit(18),
        spike_diagnoses=F.lit(18),
    )
    return table  # a projection of stored tables


def featured(spark: SparkSession, sf_dir: str, columns: list[str] | None = None, codec: str | None = None) -> DataFrame:
    """Claims with their features, stored but for those that follow from one row; ``columns`` are what is read of them,
    ``codec`` is what the table is compressed with."""
    table = claim_features(injected(spark, sf_dir))
    wanted = table.columns if columns is None else columns
    of_row = [c for c in ROW_FEATURES if c in wanted]
    needed = [*dict.fromkeys([*[c for c in wanted if c not in of_row], *[ROW_FEATURES[c] for c in of_row]])]
    return with_row_features(written(table.select(needed), "features", codec=codec), of_row).select(wanted)


def fixed_model_score() -> Column:
    """A stand-in for the model score that SQL can repeat to the last bit; it has many ties."""
    return F.floor(F.col("paid_amount") / 500.0) / 200.0 + F.col("units") / 100.0


def ruled(spark: SparkSession, sf_dir: str, columns: list[str] | None = None, codec: str | None = None) -> DataFrame:
    """Claims with both scores; ``columns`` are what is read of them besides the scores' own inputs."""
    inputs = ["paid_amount", *[rule.column for rule in RULES]]
    scored = score_rules(featured(spark, sf_dir, columns and [*dict.fromkeys([*columns, *inputs])], codec), RULES)
    return scored.withColumn("model_anomaly_score", fixed_model_score())


def amount_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Injected claims with the fixed score and no features, where a query needs no more."""
    return injected(spark, sf_dir).withColumn("model_anomaly_score", fixed_model_score())


# --- wide extracts -------------------------------------------------------------------------------


def wide_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text row per order, with one group of columns per record of the order, by line number. There
    are as many groups as the largest order has records; missing ones are null."""
    lines = order_lines(spark, sf_dir)
    most = lines.groupBy("l_orderkey").count().agg(F.max("count")).first()[0] or 1
    record = F.struct("l_linenumber", *CARRIER_CELLS.values())
    per_order = lines.groupBy("l_orderkey", "o_custkey", "o_orderdate").agg(
        F.array_sort(F.collect_list(record)).alias("records")
    )

    def cell(column: str, n: int) -> Column:
        value = F.get("records", F.lit(n))[column]
        text = value.cast("string")
        return F.when(value == 0, " NaN ").otherwise(text) if column == "l_discount" else text

    return per_order.select(
        F.col("o_custkey").cast("string").alias("DESYNPUF_ID"),
        F.col("l_orderkey").cast("string").alias(" clm_id "),
        F.date_format("o_orderdate", "yyyyMMdd").alias("CLM_FROM_DT"),
        *[cell(c, n).alias(f"{name}_{n + 1}") for name, c in CARRIER_CELLS.items() for n in range(most)],
    )


def wide_facility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text row per order line; the order is the claim and the line number its segment."""
    supplier = F.col("l_suppkey")
    day = F.date_format("l_shipdate", "yyyyMMdd")
    return order_lines(spark, sf_dir).select(
        F.concat(F.lit(" "), F.col("o_custkey"), F.lit(" ")).alias("DESYNPUF_ID"),
        F.col("l_orderkey").cast("string").alias("CLM_ID"),
        F.col("l_linenumber").cast("string").alias("SEGMENT"),
        F.concat(day, F.lit(".0")).alias("CLM_FROM_DT"),
        F.when(supplier % 10 != 0, supplier.cast("string")).otherwise("").alias("PRVDR_NUM"),
        F.when(supplier % 20 == 0, F.col("l_partkey").cast("string")).otherwise("none").alias("AT_PHYSN_NPI"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("-"), F.col("l_extendedprice")))
        .otherwise(F.col("l_extendedprice").cast("string"))
        .alias("CLM_PMT_AMT"),
        day.alias("CLM_ADMSN_DT"),
        F.date_format(F.date_add("l_shipdate", F.col("l_linenumber") - 3), "yyyyMMdd").alias("CLM_THRU_DT"),
        F.when(F.col("l_tax") > 0, F.col("l_tax").cast("string")).alias("ADMTNG_ICD9_DGNS_CD"),
        F.when(F.col("l_discount") > 0, F.col("l_discount").cast("string")).alias("ICD9_DGNS_CD_1"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).otherwise("<NA>").alias("ICD9_PRCDR_CD_1"),
        F.col("l_partkey").cast("string").alias("HCPCS_CD_1"),
    )


def wide_pharmacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.col("l_partkey")
    return order_lines(spark, sf_dir).select(
        F.col("o_custkey").cast("string").alias("DESYNPUF_ID"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("PDE_ID"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("SRVC_DT"),
        F.when(part % 7 == 0, "n/a").otherwise(part.cast("string")).alias("PROD_SRVC_ID"),
        F.when(part % 11 == 0, "3d").otherwise((F.col("l_quantity") + 0.7).cast("string")).alias("QTY_DSPNSD_NUM"),
        F.col("l_extendedprice").cast("string").alias("TOT_RX_CST_AMT"),
    )


def day_text(name: str = "service_date") -> Column:
    return F.date_format(name, "yyyy-MM-dd").alias(name)


CLAIM_COLUMNS = ["claim_id", *COPIED_FIELDS]
