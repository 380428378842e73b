"""Wide, all-text CMS DE-SynPUF extracts to canonical claims."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewrank.functions.expr import (
    add,
    at_least_zero,
    clean_text,
    count_populated,
    date_of,
    date_problem,
    first_nonempty,
    np_round,
    number,
    number_or_zero,
    sound,
    yyyymmdd_or_null,
    yyyymmdd_text,
)
from reviewrank.operators.validate import check_claims
from reviewrank.schema import require_columns
from reviewrank.session import written
from reviewrank.sources.tables import read_claims, read_text_csv, write_claims

@dataclass(frozen=True)
class Layout:
    """Where one kind of extract keeps things. A name that ends in ``_`` stands for all columns that
    continue it with a number."""

    claim_id: str
    date: str
    paid: str
    providers: tuple[str, ...] = ()
    diagnoses: tuple[str, ...] = ()
    procedures: tuple[str, ...] = ()
    quantity: str | None = None
    has_stay: bool = False


# The column names of the extracts, and other names of a kind.
_FACILITY = Layout(
    claim_id="CLM_ID",
    date="CLM_FROM_DT",
    paid="CLM_PMT_AMT",
    providers=("PRVDR_NUM", "AT_PHYSN_NPI", "OP_PHYSN_NPI", "OT_PHYSN_NPI"),
    diagnoses=("ICD9_DGNS_CD_", "LINE_ICD9_DGNS_CD_", "ADMTNG_ICD9_DGNS_CD"),
    procedures=("ICD9_PRCDR_CD_", "HCPCS_CD_"),
)
LAYOUTS = {
    "inpatient": replace(_FACILITY, has_stay=True),
    "outpatient": _FACILITY,
    "carrier": replace(_FACILITY, paid="LINE_NCH_PMT_AMT_", providers=("PRF_PHYSN_NPI_", "TAX_NUM_")),
    "pharmacy": Layout(
        claim_id="PDE_ID",
        date="SRVC_DT",
        paid="TOT_RX_CST_AMT",
        procedures=("PROD_SRVC_ID",),
        quantity="QTY_DSPNSD_NUM",
    ),
}
OTHER_NAMES = {"pde": "pharmacy", "prescription": "pharmacy"}
PERSON = "DESYNPUF_ID"
STAY_DAYS, STAY_FROM, STAY_TO = "CLM_UTLZTN_DAY_CNT", "CLM_ADMSN_DT", "CLM_THRU_DT"
MISSING_COLUMNS = "The extract lacks columns"
FILE_ORDER = "_FILE_ORDER"


def claim_kind(name: str) -> str:
    folded = name.strip().lower()
    kind = OTHER_NAMES.get(folded, folded)
    if kind not in LAYOUTS:
        raise ValueError(f"unknown kind of extract {name!r}; known are {', '.join(sorted(LAYOUTS))}")
    return kind


def with_plain_names(df: DataFrame) -> DataFrame:
    """Column names without outer blanks and in capitals."""
    plain = Counter(c.strip().upper() for c in df.columns)
    if max(plain.values()) > 1:
        raise ValueError(f"columns share a name: {[n for n, times in plain.items() if times > 1]}")
    return df.toDF(*plain)


def columns_like(df: DataFrame, names: tuple[str, ...]) -> list[str]:
    """The named columns that exist, in order; numbered ones by their number."""
    found: list[str] = []
    for name in names:
        shape = re.compile(re.escape(name) + (r".*?(\d*)" if name.endswith("_") else "()"))
        numbers = {c: int(m[1] or 0) for c in df.columns if (m := shape.fullmatch(c))}
        found += sorted(numbers, key=numbers.get)
    return found


def _source(df: DataFrame, claim_type: str) -> tuple[DataFrame, str, Layout]:
    kind = claim_kind(claim_type)
    source, layout = with_plain_names(df), LAYOUTS[kind]
    require_columns(source, [PERSON, layout.claim_id, layout.date], MISSING_COLUMNS)
    if not columns_like(source, (layout.paid,)):
        raise ValueError(f"{MISSING_COLUMNS}: {[layout.paid]}")
    if layout.has_stay and STAY_DAYS not in source.columns:
        require_columns(source, [STAY_FROM, STAY_TO], MISSING_COLUMNS)
    return source, kind, layout


def _date_columns(source: DataFrame, layout: Layout) -> list[str]:
    stay = layout.has_stay and STAY_DAYS not in source.columns
    return [layout.date, *([STAY_FROM, STAY_TO] if stay else [])]


def _stay(dates: list[Column], days: Column) -> Column:
    """The days of a stay: from its dates, where an extract has no days of its own (see ``_date_columns``)."""
    if len(dates) < 3:
        return days
    return F.coalesce(F.greatest(F.datediff(dates[2], dates[1]) + 1, F.lit(0)), F.lit(0)).cast("long")


def canonical_records(df: DataFrame, claim_type: str) -> DataFrame:
    """One canonical row per source row, in a single projection. A missing id or a bad date stops
    the job from inside the plan, whatever columns are read later.

    A row that names no provider gets one unique to its claim, so that unrelated claims neither
    form a false provider nor a hot key.
    """
    source, kind, layout = _source(df, claim_type)
    names = _date_columns(source, layout)
    paid = add([number_or_zero(source, c) for c in columns_like(source, (layout.paid,))], F.lit(0.0))
    procedures = F.col("_procedures")
    quantity = at_least_zero(number_or_zero(source, layout.quantity)).cast("long") if layout.quantity else F.lit(None).cast("long")
    segment = number(source, "SEGMENT") if "SEGMENT" in source.columns else F.lit(None).cast("double")
    # Rows without a segment number come after those with one.
    order = [F.coalesce(segment, F.lit(float("inf"))).alias("segment")]
    if FILE_ORDER in source.columns:
        order.append(F.col(FILE_ORDER).alias("row"))
    given = layout.has_stay and STAY_DAYS in source.columns
    days = at_least_zero(number_or_zero(source, STAY_DAYS)).cast("long") if given else F.lit(0).cast("long")
    # Cells are cleaned once, in a projection of their own.
    cells = source.select(
        clean_text(F.col(layout.claim_id)).alias("_id"),
        clean_text(F.col(PERSON)).alias("_person"),
        first_nonempty(columns_like(source, layout.providers)).alias("_named"),
        np_round(at_least_zero(paid), 2).alias("paid_amount"),
        count_populated(columns_like(source, layout.diagnoses)).alias("diagnosis_count"),
        count_populated(columns_like(source, layout.procedures)).alias("_procedures"),
        quantity.alias("_quantity"),
        days.alias("_days"),
        F.struct(*order).alias("_order"),
        *[yyyymmdd_text(n).alias(f"_text{i}") for i, n in enumerate(names)],
    )
    dates = [F.col(f"_date{i}") for i in range(len(names))]
    read = cells.withColumns({f"_date{i}": date_of(F.col(f"_text{i}")) for i in range(len(names))})

    def whole(row: Column) -> Column:
        missing = {layout.claim_id: row["_id"], PERSON: row["_person"]}
        problems = [F.when(c.isNull(), F.lit(f"{name} must not be missing")) for name, c in missing.items()]
        texts = [row[f"_text{i}"] for i in range(len(names))]
        return sound(problems + [date_problem(n, t, date_of(t)) for n, t in zip(names, texts)])

    # Bound in a lambda, each cleaned cell stands in the condition once. Written out, the condition becomes a
    # method too long for the JVM to compile, and the job runs in its interpreter.
    checked = F.exists(F.array(F.struct("_id", "_person", *[f"_text{i}" for i in range(len(names))])), whole)
    claim_id = F.concat(F.lit(f"CMS-{kind.upper()}-"), F.col("_id"))
    return read.where(checked).select(
        claim_id.alias("claim_id"),
        F.col("_id").alias("source_claim_id"),
        F.concat(F.lit("CMS-BEN-"), F.col("_person")).alias("beneficiary_id"),
        F.coalesce(F.concat(F.lit("CMS-PRV-"), F.col("_named")), F.concat(F.lit("CMS-NO-PROVIDER-"), claim_id)).alias("provider_id"),
        F.lit(kind).alias("claim_type"),
        dates[0].alias("service_date"),
        "paid_amount",
        "diagnosis_count",
        procedures.alias("procedure_count"),
        (F.col("_quantity") if layout.quantity else procedures).alias("units"),
        _stay(dates, F.col("_days")).alias("length_of_stay"),
        F.lit(kind).alias("source_file_type"),
        "_order",
    )


def first_by(name: str, order: Column) -> Column:
    """The first value that is not null in the given order; equal order goes by value."""
    return F.min(F.when(F.col(name).isNotNull(), F.struct(order, F.col(name))))[name].alias(name)


def collapse_segments(records: DataFrame, order: Column, carried: list[str] | None = None) -> DataFrame:
    """One row per claim id: first identity values, earliest date, largest figures, record count.

    All are mergeable, so segments of one claim are combined before the shuffle.
    ``carried`` are columns that depend on the claim id alone; they join the grouping key.
    """
    carried = carried or []
    fields = ["beneficiary_id", "provider_id", "claim_type"]
    firsts = ["source_claim_id", *fields, "source_file_type"]
    kept = [c for c in firsts if c in records.columns and c not in carried]
    ordered = order.alias("_at")
    # Sorting inside the aggregation goes by the first key: numbers sort faster than ids with one prefix.
    numbers = [c for c in carried if records.schema[c].dataType.typeName() in ("long", "integer")]
    rest = [c for c in carried if c not in numbers]
    collapsed = records.groupBy(*numbers, "claim_id", *rest).agg(
        *[first_by(c, ordered) for c in kept],
        F.min("service_date").alias("service_date"),
        *[
            F.max(c).alias(c)
            for c in ["paid_amount", "diagnosis_count", "procedure_count", "units", "length_of_stay"]
        ],
        F.count(F.lit(1)).alias("source_record_count"),
    )
    return collapsed.select("claim_id", *carried, *collapsed.columns[1 + len(carried) :])


def adapt_cms(df: DataFrame, claim_type: str) -> DataFrame:
    """Canonical claims of one extract. Type and source id follow from the claim id, so they are
    part of the grouping key instead of being aggregated."""
    records = canonical_records(df, claim_type)
    dependent = ["source_claim_id", "claim_type", "source_file_type"]
    return collapse_segments(records, F.col("_order"), carried=dependent)


def source_problems(df: DataFrame, claim_type: str) -> DataFrame:
    """What would stop the adapter: ``problem, rows, examples`` (the 3 smallest values), before a long run.

    One pass counts the problems of each kind by value; of the counts, only the three smallest values of a
    kind are kept in one place.
    """
    source, _, layout = _source(df, claim_type)
    empty = F.lit(None).cast("string")
    found = [
        F.when(clean_text(F.col(name)).isNull(), F.struct(F.lit(i), F.lit(f"missing {name}"), empty))
        for i, name in enumerate([PERSON, layout.claim_id])
    ]
    for i, name in enumerate(_date_columns(source, layout), len(found)):
        text = yyyymmdd_text(name)
        bad = text.isNotNull() & yyyymmdd_or_null(name).isNull()
        found.append(F.when(bad, F.struct(F.lit(i), F.lit(f"invalid {name}"), text)))
    typed = [c.cast("struct<place:int,problem:string,value:string>") for c in found]
    values = (
        source.select(F.inline(F.array_compact(F.array(*typed))))
        .groupBy("place", "problem", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = values.groupBy("place", "problem").agg(F.sum("n").alias("rows"))
    least = Window.partitionBy("place").orderBy("value")
    some = (
        values.filter("value is not null")
        .withColumn("_at", F.row_number().over(least))
        .filter("_at <= 3")
        .groupBy("place")
        .agg(F.sort_array(F.collect_list("value")).alias("examples"))
    )
    none = F.array().cast("array<string>")
    return totals.join(some, "place", "left").select("problem", "rows", F.coalesce("examples", none).alias("examples"))


def read_cms_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All columns as text, plus the place of the row in the files, for "first" among segments."""
    source = read_text_csv(spark, path, multi_line)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
    )
    return source.withColumn(FILE_ORDER, place)


def ingest_cms_csv(
    spark: SparkSession,
    path: str,
    claim_type: str,
    output: str | None = None,
    fmt: str = "parquet",
    multi_line: bool = False,
) -> DataFrame:
    """Adapt a CSV extract, write it, check it, and return the stored claims.

    Claims that break a rule, an empty table among them, raise; they lie at ``output`` to be looked at.
    Without ``output`` they are stored as a scratch table, as checking reads them a second time.
    """
    claims = adapt_cms(read_cms_csv(spark, path, multi_line), claim_type)
    if output is None:
        stored = written(claims, "ingested")
        check_claims(stored)
        return stored
    write_claims(claims, output, fmt)
    stored = spark.read.schema(claims.schema).parquet(output) if fmt == "parquet" else read_claims(spark, output, fmt)
    check_claims(stored)
    return stored
