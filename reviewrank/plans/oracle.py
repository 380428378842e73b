"""The same queries as SQL, for a second engine to check the results against."""

from __future__ import annotations

RECORDS = """
records AS (
  SELECT 'CLM-' || l_orderkey || '-' || l_linenumber AS claim_id,
         'BEN-' || o_custkey AS beneficiary_id,
         'PRV-' || l_suppkey AS provider_id,
         CASE l_orderkey % 4 WHEN 0 THEN 'carrier' WHEN 1 THEN 'inpatient'
                             WHEN 2 THEN 'outpatient' ELSE 'pharmacy' END AS claim_type,
         l_shipdate AS service_date,
         l_extendedprice AS paid_amount,
         CAST(round(l_discount * 100) AS BIGINT) AS diagnosis_count,
         CAST(round(l_tax * 100) AS BIGINT) AS procedure_count,
         CAST(l_quantity AS BIGINT) AS units,
         CAST(CASE WHEN l_orderkey % 4 = 1 THEN l_linenumber ELSE 0 END AS BIGINT) AS length_of_stay,
         l_orderkey AS ok, l_linenumber AS ln, l_partkey, l_suppkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

CLAIMS = (
    RECORDS
    + """,
claims AS (
  SELECT claim_id, ok, ln, claim_type,
         first(beneficiary_id ORDER BY l_partkey, l_suppkey, service_date, paid_amount, units) AS beneficiary_id,
         first(provider_id ORDER BY l_partkey, l_suppkey, service_date, paid_amount, units) AS provider_id,
         min(service_date) AS service_date, max(paid_amount) AS paid_amount,
         max(diagnosis_count) AS diagnosis_count, max(procedure_count) AS procedure_count,
         max(units) AS units, max(length_of_stay) AS length_of_stay, count(*) AS source_record_count
  FROM records GROUP BY claim_id, ok, ln, claim_type
)"""
)

INJECTED = (
    CLAIMS
    + """,
labelled AS (
  SELECT *, CASE WHEN (ok * 7 + ln) % 25 = 0 THEN 1 ELSE 0 END AS is_injected_anomaly,
         CASE WHEN (ok * 7 + ln) % 25 <> 0 THEN 'none'
              ELSE ['high_paid', 'excess_units', 'duplicate_like', 'utilization_spike'][(ok + ln) % 4 + 1]
         END AS anomaly_scenario
  FROM claims
),
donors AS (
  SELECT * FROM claims QUALIFY row_number() OVER (PARTITION BY ok ORDER BY ln, claim_id) = 1
),
injected AS (
  SELECT c.claim_id, c.ok, c.ln, c.is_injected_anomaly, c.anomaly_scenario,
         CASE WHEN c.anomaly_scenario = 'duplicate_like' THEN d.beneficiary_id ELSE c.beneficiary_id END AS beneficiary_id,
         CASE WHEN c.anomaly_scenario = 'duplicate_like' THEN d.provider_id ELSE c.provider_id END AS provider_id,
         CASE WHEN c.anomaly_scenario = 'duplicate_like' THEN d.claim_type ELSE c.claim_type END AS claim_type,
         CASE WHEN c.anomaly_scenario = 'duplicate_like' THEN d.service_date ELSE c.service_date END AS service_date,
         round_even(100e0 * CASE c.anomaly_scenario WHEN 'duplicate_like' THEN d.paid_amount
              WHEN 'high_paid' THEN c.paid_amount * 12e0
              WHEN 'utilization_spike' THEN c.paid_amount * 4e0 ELSE c.paid_amount END, 0) / 100e0 AS paid_amount,
         CASE c.anomaly_scenario WHEN 'duplicate_like' THEN d.diagnosis_count
              WHEN 'utilization_spike' THEN 18 ELSE c.diagnosis_count END AS diagnosis_count,
         CASE c.anomaly_scenario WHEN 'duplicate_like' THEN d.procedure_count
              WHEN 'utilization_spike' THEN 18 ELSE c.procedure_count END AS procedure_count,
         CASE c.anomaly_scenario WHEN 'duplicate_like' THEN d.units
              WHEN 'excess_units' THEN 60 + c.ln ELSE c.units END AS units,
         CASE c.anomaly_scenario WHEN 'duplicate_like' THEN d.length_of_stay ELSE c.length_of_stay END AS length_of_stay
  FROM labelled c JOIN donors d ON c.ok = d.ok
)"""
)

def chance(*parts: str) -> str:
    """52 bits of the MD5 of the parts' text."""
    text = " || ':' || ".join(f"({p})" for p in parts)
    return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT)"


def drawn(purpose: str, seed: int = 7) -> str:
    return f"({chance(f"'{seed}'", f"'{purpose}'", 'claim_id')} / 4503599627370496e0)"


AT_RATE = (
    CLAIMS
    + f""",
sized AS (
  SELECT wanted, greatest(1, wanted // 4) AS groups
  FROM (SELECT greatest(1, CAST(round_even(count(*) * 0.04e0, 0) AS BIGINT)) AS wanted FROM claims)
),
named AS (
  SELECT *, row_number() OVER (ORDER BY {chance("'7'", "'pick'", "claim_id")}, claim_id) <= wanted AS picked,
         {chance("'7'", "'donor group'", "claim_id")} % groups AS grp, {chance("'7'", "'donor of'", "claim_id")} % groups AS wants
  FROM claims, sized
),
labelled AS (
  SELECT *, CASE WHEN picked THEN ['high_paid', 'excess_units', 'duplicate_like', 'utilization_spike'][CAST(floor({drawn("scenario")} * 4) AS BIGINT) + 1]
            ELSE 'none' END AS anomaly_scenario FROM named
),
donors AS (
  SELECT * FROM named QUALIFY row_number() OVER (PARTITION BY grp ORDER BY {chance("'7'", "'donor'", "claim_id")}, claim_id) = 1
),
changed AS (
  SELECT *, CASE anomaly_scenario WHEN 'high_paid' THEN 8e0 + {drawn("paid")} * 10e0 WHEN 'utilization_spike' THEN 3e0 + {drawn("spike")} * 3e0 ELSE 1e0 END AS factor,
         CASE WHEN anomaly_scenario = 'excess_units' THEN CAST(floor(30e0 + {drawn("units")} * 70e0) AS BIGINT) ELSE units END AS new_units,
         CASE WHEN anomaly_scenario = 'utilization_spike' THEN CAST(floor(12e0 + {drawn("procedures")} * 13e0) AS BIGINT) ELSE procedure_count END AS new_procedures,
         CASE WHEN anomaly_scenario = 'utilization_spike' THEN CAST(floor(12e0 + {drawn("diagnoses")} * 13e0) AS BIGINT) ELSE diagnosis_count END AS new_diagnoses
  FROM labelled
),
injected AS (
  SELECT c.claim_id, coalesce(d.beneficiary_id, c.beneficiary_id) AS beneficiary_id, coalesce(d.provider_id, c.provider_id) AS provider_id,
         coalesce(d.claim_type, c.claim_type) AS claim_type, coalesce(d.service_date, c.service_date) AS service_date,
         round_even(coalesce(d.paid_amount, c.paid_amount * factor) * 100e0, 0) / 100e0 AS paid_amount,
         coalesce(d.diagnosis_count, new_diagnoses) AS diagnosis_count, coalesce(d.procedure_count, new_procedures) AS procedure_count,
         coalesce(d.units, new_units) AS units, coalesce(d.length_of_stay, c.length_of_stay) AS length_of_stay,
         CAST(c.picked AS INT) AS is_injected_anomaly, c.anomaly_scenario
  FROM changed c LEFT JOIN donors d ON c.anomaly_scenario = 'duplicate_like' AND d.grp = c.wants
)"""
)

DUPLICATE = """CASE WHEN count(*) OVER (PARTITION BY beneficiary_id, provider_id, claim_type, service_date,
                paid_amount, diagnosis_count, procedure_count, units) > 1 THEN 1 ELSE 0 END"""


def trailing(key: str, days: int = 30) -> str:
    return (
        f"count(*) OVER (PARTITION BY {key} ORDER BY service_date "
        f"RANGE BETWEEN INTERVAL {days} DAY PRECEDING AND CURRENT ROW)"
    )


def r(expression: str, digits: int = 6) -> str:
    return f"round_even(({expression}) * 1e{digits}, 0) / 1e{digits}"


ZSCORE = """CASE WHEN coalesce(stddev_samp(paid_amount) OVER (PARTITION BY provider_id), 0) = 0 THEN 0
            ELSE (paid_amount - avg(paid_amount) OVER (PARTITION BY provider_id))
                 / stddev_samp(paid_amount) OVER (PARTITION BY provider_id) END"""
WEEKEND = "CASE WHEN isodow(service_date) >= 6 THEN 1 ELSE 0 END"

FEATURED = (
    INJECTED
    + f""",
featured AS (
  SELECT *, ln(1e0 + paid_amount) AS paid_amount_log, {WEEKEND} AS weekend_service,
         {DUPLICATE} AS duplicate_indicator,
         {trailing("provider_id")} AS provider_claim_count_30d,
         {trailing("beneficiary_id")} AS beneficiary_claim_count_30d,
         {ZSCORE} AS provider_paid_zscore
  FROM injected
)"""
)


def ruled(
    z: str = "1.6e0", units: int = 48, provider: int = 13, beneficiary: int = 5, featured: str = FEATURED
) -> str:
    total = (
        f"CASE WHEN provider_paid_zscore >= {z} THEN 0.3e0 ELSE 0e0 END"
        f" + CASE WHEN units >= {units} THEN 0.2e0 ELSE 0e0 END"
        f" + CASE WHEN duplicate_indicator = 1 THEN 0.25e0 ELSE 0e0 END"
        f" + CASE WHEN provider_claim_count_30d >= {provider} THEN 0.15e0 ELSE 0e0 END"
        f" + CASE WHEN beneficiary_claim_count_30d >= {beneficiary} THEN 0.1e0 ELSE 0e0 END"
    )
    return (
        featured
        + f""",
ruled AS (
  SELECT *, {r(f"least(greatest({total}, 0e0), 1e0)")} AS rule_score,
         list_filter([CASE WHEN provider_paid_zscore >= {z} THEN 'HIGH_PROVIDER_RELATIVE_COST' END,
                      CASE WHEN units >= {units} THEN 'EXCESS_UNITS' END,
                      CASE WHEN duplicate_indicator = 1 THEN 'POSSIBLE_DUPLICATE' END,
                      CASE WHEN provider_claim_count_30d >= {provider} THEN 'HIGH_PROVIDER_UTILIZATION' END,
                      CASE WHEN beneficiary_claim_count_30d >= {beneficiary} THEN 'HIGH_BENEFICIARY_UTILIZATION' END],
                     lambda x: x IS NOT NULL) AS rule_reason_codes,
         floor(paid_amount / 500e0) / 200e0 + units / 100e0 AS model_anomaly_score
  FROM featured
)"""
    )


FIXED_SCORE = "floor(paid_amount / 500e0) / 200e0 + units / 100e0"
AMOUNT_ONLY = INJECTED + f", amounts AS (SELECT *, {FIXED_SCORE} AS model_anomaly_score FROM injected)"


def rank_share(score: str) -> str:
    """Average rank of ties over the row count."""
    return (
        f"(rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2e0)"
        f" / count(*) OVER ()"
    )


def ranked(ctes: str, table: str) -> str:
    """Blend, flag and ranks of the scored claims in ``table``."""
    return (
        ctes
        + f""",
shares AS (SELECT *, {rank_share("model_anomaly_score")} AS share FROM {table}),
blended AS (
  SELECT *, {r("share")} AS model_score_percentile,
         {r("0.9e0 * share + (1e0 - 0.9e0) * rule_score")} AS ensemble_score FROM shares
),
ranked AS (
  SELECT *, ensemble_score AS anomaly_score,
         CASE WHEN ensemble_score >= (SELECT quantile_cont(ensemble_score, 0.95) FROM blended) THEN 1 ELSE 0 END AS is_flagged,
         {r(rank_share("ensemble_score"))} AS score_percentile
  FROM blended
)"""
    )


RANKED = ranked(ruled(), "ruled")

QUEUE = (
    RANKED
    + """,
queue AS (
  SELECT * REPLACE (is_flagged = 1 AS is_flagged),
         CASE WHEN len(rule_reason_codes) > 0 THEN array_to_string(rule_reason_codes, ', ')
              ELSE 'MULTIVARIATE_OUTLIER' END AS reason_codes_display
  FROM ranked
)"""
)

CODES = "array_to_string(rule_reason_codes, '|')"
CLAIM_FIELDS = (
    "claim_id, beneficiary_id, provider_id, claim_type, strftime(service_date, '%Y-%m-%d') AS service_date, "
    "paid_amount, diagnosis_count, procedure_count, units, length_of_stay"
)
KPIS = f"""
SELECT count(*) AS claims, count_if(is_flagged) AS flagged_claims,
       {r("coalesce(sum(paid_amount) FILTER (WHERE is_flagged), 0e0)", 2)} AS review_paid_amount,
       {r("coalesce(avg(ensemble_score), 0e0)")} AS average_ensemble_score,
       CAST(sum(is_injected_anomaly) AS BIGINT) AS injected_scenarios,
       CAST(coalesce(sum(is_injected_anomaly) FILTER (WHERE is_flagged), 0) AS BIGINT) AS flagged_injected_scenarios
FROM queue"""


METRICS = [
    "evaluation_available", "rows", "injected_anomalies", "top_k", "true_positives_at_k", "precision_at_k", "recall_at_k", "roc_auc", "average_precision",
]


def metrics_of(score: str, table: str = "ranked") -> str:
    """One row of ranking metrics by brute force over windows."""
    order = f"{score} DESC, ensemble_score DESC, claim_id" if score != "ensemble_score" else f"{score} DESC, claim_id"
    return f"""(
  SELECT 1 AS evaluation_available, count(*) AS rows, CAST(sum(y) AS BIGINT) AS injected_anomalies,
         least(200, count(*)) AS top_k, CAST(sum(y) FILTER (WHERE place <= 200) AS BIGINT) AS true_positives_at_k,
         {r("sum(y) FILTER (WHERE place <= 200) / least(200e0, count(*))")} AS precision_at_k,
         {r("sum(y) FILTER (WHERE place <= 200) / CAST(sum(y) AS DOUBLE)")} AS recall_at_k,
         {r("(sum(avg_rank) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2e0) / (sum(y) * CAST(count(*) - sum(y) AS DOUBLE))")} AS roc_auc,
         {r("sum(hits / CAST(above AS DOUBLE)) FILTER (WHERE y = 1) / sum(y)")} AS average_precision
  FROM (
    SELECT is_injected_anomaly AS y, row_number() OVER (ORDER BY {order}) AS place,
           rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2e0 AS avg_rank,
           sum(is_injected_anomaly) OVER (ORDER BY {score} DESC) AS hits,
           count(*) OVER (ORDER BY {score} DESC) AS above
    FROM {table}
  )
)"""


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


CARRIER = """
SELECT 'CMS-CARRIER-' || l_orderkey AS claim_id, CAST(l_orderkey AS VARCHAR) AS source_claim_id,
       'CMS-BEN-' || o_custkey AS beneficiary_id,
       'CMS-PRV-' || first(l_suppkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS provider_id,
       'carrier' AS claim_type,
       round_even(sum(l_extendedprice ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) * 1e2, 0) / 1e2
         AS paid_amount,
       count_if(l_discount > 0) AS diagnosis_count, count(l_partkey) AS procedure_count, count(l_partkey) AS units,
       CAST(0 AS BIGINT) AS length_of_stay, 'carrier' AS source_file_type,
       CAST(1 AS BIGINT) AS source_record_count, strftime(o_orderdate, '%Y-%m-%d') AS service_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey, o_custkey, o_orderdate"""

FACILITY = """
SELECT 'CMS-INPATIENT-' || l_orderkey AS claim_id, CAST(l_orderkey AS VARCHAR) AS source_claim_id,
       first('CMS-BEN-' || o_custkey ORDER BY l_linenumber) AS beneficiary_id,
       first(provider ORDER BY l_linenumber, provider) AS provider_id, 'inpatient' AS claim_type,
       max(round_even(greatest(paid, 0e0) * 1e2, 0) / 1e2) AS paid_amount,
       max(CAST(l_tax > 0 AS BIGINT) + CAST(l_discount > 0 AS BIGINT)) AS diagnosis_count,
       max(CAST(l_returnflag <> 'N' AS BIGINT) + 1) AS procedure_count,
       max(CAST(l_returnflag <> 'N' AS BIGINT) + 1) AS units,
       CAST(max(greatest(l_linenumber - 3 + 1, 0)) AS BIGINT) AS length_of_stay, 'inpatient' AS source_file_type,
       count(*) AS source_record_count, strftime(min(l_shipdate), '%Y-%m-%d') AS service_date
FROM (
  SELECT *, CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS paid,
         CASE WHEN l_suppkey % 10 <> 0 THEN 'CMS-PRV-' || l_suppkey
              WHEN l_suppkey % 20 = 0 THEN 'CMS-PRV-' || l_partkey
              ELSE 'CMS-NO-PROVIDER-CMS-INPATIENT-' || l_orderkey END AS provider
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
) GROUP BY l_orderkey"""

PHARMACY = """
SELECT claim_id, source_claim_id, min(beneficiary_id) AS beneficiary_id,
       'CMS-NO-PROVIDER-' || claim_id AS provider_id, 'pharmacy' AS claim_type,
       max(round_even(l_extendedprice * 1e2, 0) / 1e2) AS paid_amount, CAST(0 AS BIGINT) AS diagnosis_count,
       max(CAST(l_partkey % 7 <> 0 AS BIGINT)) AS procedure_count,
       max(CASE WHEN l_partkey % 11 = 0 THEN 0 ELSE CAST(trunc(l_quantity + 0.7e0) AS BIGINT) END) AS units,
       CAST(0 AS BIGINT) AS length_of_stay, 'pharmacy' AS source_file_type, count(*) AS source_record_count,
       strftime(min(l_shipdate), '%Y-%m-%d') AS service_date
FROM (
  SELECT *, 'CMS-PHARMACY-' || l_orderkey || '-' || l_linenumber AS claim_id,
         l_orderkey || '-' || l_linenumber AS source_claim_id, 'CMS-BEN-' || o_custkey AS beneficiary_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
) GROUP BY claim_id, source_claim_id"""

PROBLEMS = """
SELECT 'missing DESYNPUF_ID' AS problem, count(*) AS rows, '' AS examples
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey % 13 = 0 HAVING count(*) > 0
UNION ALL
SELECT 'invalid SRVC_DT', count(*), array_to_string(list_sort(list(DISTINCT 'day ' || o_custkey))[1:3], '|')
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey % 17 = 0 HAVING count(*) > 0"""

REPORT = """,
shifted AS (
  SELECT * REPLACE (paid_amount - 2000 AS paid_amount, units - 1 - ln AS units,
                    CASE WHEN l_suppkey % 10 <> 0 THEN provider_id END AS provider_id) FROM records
),
repeated AS (SELECT claim_id FROM shifted GROUP BY claim_id HAVING count(*) > 1)
SELECT 'empty' AS check_name, CAST(count(*) = 0 AS BIGINT) AS violations FROM shifted
UNION ALL SELECT 'null_claim_id', count_if(claim_id IS NULL) FROM shifted
UNION ALL SELECT 'null_beneficiary_id', count_if(beneficiary_id IS NULL) FROM shifted
UNION ALL SELECT 'null_provider_id', count_if(provider_id IS NULL) FROM shifted
UNION ALL SELECT 'null_service_date', count_if(service_date IS NULL) FROM shifted
UNION ALL SELECT 'negative_paid_amount', count_if(paid_amount < 0) FROM shifted
UNION ALL SELECT 'negative_diagnosis_count', count_if(diagnosis_count < 0) FROM shifted
UNION ALL SELECT 'negative_procedure_count', count_if(procedure_count < 0) FROM shifted
UNION ALL SELECT 'negative_units', count_if(units < 0) FROM shifted
UNION ALL SELECT 'negative_length_of_stay', count_if(length_of_stay < 0) FROM shifted
UNION ALL SELECT 'repeated_claim_id', count(*) FROM repeated"""

NUMERIC = [
    "paid_amount_log",
    "diagnosis_count",
    "procedure_count",
    "units",
    "length_of_stay",
    "provider_claim_count_30d",
    "beneficiary_claim_count_30d",
    "provider_paid_zscore",
    "duplicate_indicator",
    "weekend_service",
]
STATISTICS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)')} AS median, "
    f"{r(f'avg({c})')} AS mean, {r(f'stddev_pop({c})')} AS scale FROM featured"
    for c in NUMERIC
)
MATRIX = ", ".join(
    [f"{r(f'({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()', 4)} AS {c}" for c in NUMERIC]
    + [
        f"CAST(claim_type = '{c}' AS DOUBLE) AS is_{c}"
        for c in ["carrier", "inpatient", "outpatient", "pharmacy"]
    ]
)

DETAILS = " UNION ALL ".join(
    f"SELECT claim_id, '{head}' AS \"Field\", CAST({value} AS VARCHAR) AS \"Value\" FROM queue WHERE is_flagged"
    for head, value in {
        "Claim type": "claim_type",
        "Service date": "CAST(service_date AS DATE)",
        "Provider": "provider_id",
        "Beneficiary": "beneficiary_id",
        "Units": "units",
        "Provider claims · 30d": "provider_claim_count_30d",
        "Beneficiary claims · 30d": "beneficiary_claim_count_30d",
        "Provider paid z-score": "printf('%.4f', round(provider_paid_zscore, 4) + 0e0)",
        "Duplicate indicator": "duplicate_indicator",
        "Weekend service": "weekend_service",
    }.items()
)

HISTOGRAM = """,
bands(band, score_band, low, high) AS (VALUES
  (0, '(-0.001, 0.1]', -0.001e0, 0.1e0), (1, '(0.1, 0.2]', 0.1e0, 0.2e0), (2, '(0.2, 0.3]', 0.2e0, 0.3e0),
  (3, '(0.3, 0.4]', 0.3e0, 0.4e0), (4, '(0.4, 0.5]', 0.4e0, 0.5e0), (5, '(0.5, 0.6]', 0.5e0, 0.6e0),
  (6, '(0.6, 0.7]', 0.6e0, 0.7e0), (7, '(0.7, 0.8]', 0.7e0, 0.8e0), (8, '(0.8, 0.9]', 0.8e0, 0.9e0),
  (9, '(0.9, 1.0]', 0.9e0, 1.0e0))
SELECT band, score_band, count(claim_id) AS claims
FROM bands LEFT JOIN queue ON ensemble_score > low AND ensemble_score <= high GROUP BY band, score_band"""

SPLIT = """,
spoilt AS (
  SELECT claim_id, CASE WHEN ok % 17 = 0 THEN 'dental' ELSE claim_type END AS claim_type,
         CASE WHEN ok % 19 = 0 THEN -1 ELSE paid_amount END AS paid_amount,
         CASE WHEN ok % 23 = 0 THEN 0 ELSE provider_claim_count_30d END AS provider_claim_count_30d,
         CASE WHEN ok % 29 = 0 THEN 2 ELSE weekend_service END AS weekend_service,
         CASE WHEN ok % 31 = 0 THEN NULL ELSE units END AS units
  FROM featured
),
judged AS (
  SELECT claim_id, concat_ws('|',
    CASE WHEN claim_type NOT IN ('carrier', 'inpatient', 'outpatient', 'pharmacy') THEN 'claim_type' END,
    CASE WHEN paid_amount < 0 THEN 'paid_amount' END,
    CASE WHEN units IS NULL THEN 'units' END,
    CASE WHEN provider_claim_count_30d < 1 THEN 'provider_claim_count_30d' END,
    CASE WHEN weekend_service NOT IN (0, 1) THEN 'weekend_service' END) AS broken_rules
  FROM spoilt
)
SELECT claim_id, broken_rules = '' AS accepted, broken_rules FROM judged"""

ORACLE: dict[str, str] = {
    "collapse_segments": with_(CLAIMS, f"SELECT {CLAIM_FIELDS}, source_record_count FROM claims"),
    "ingest_carrier_wide": CARRIER,
    "ingest_facility": FACILITY,
    "ingest_pharmacy": PHARMACY,
    "ingest_source_problems": PROBLEMS,
    "validate_report": "WITH " + RECORDS + REPORT,
    "inject_anomalies": with_(INJECTED, f"SELECT {CLAIM_FIELDS}, is_injected_anomaly, anomaly_scenario FROM injected"),
    "inject_at_rate": with_(AT_RATE, f"SELECT {CLAIM_FIELDS}, is_injected_anomaly, anomaly_scenario FROM injected"),
    "csv_claims": with_(CLAIMS, f"SELECT {CLAIM_FIELDS}, source_record_count FROM claims"),
    "csv_ingest_pharmacy": PHARMACY,
    "rolling_provider_30d": with_(
        CLAIMS, f"SELECT claim_id, {trailing('provider_id')} AS provider_claim_count_30d FROM claims"
    ),
    "rolling_beneficiary_30d": with_(
        CLAIMS, f"SELECT claim_id, {trailing('beneficiary_id')} AS beneficiary_claim_count_30d FROM claims"
    ),
    "rolling_provider_90d": with_(
        CLAIMS, f"SELECT claim_id, {trailing('provider_id', 90)} AS provider_claim_count FROM claims"
    ),
    "rolling_arrival_ties": with_(
        CLAIMS,
        f"""SELECT claim_id, {trailing('provider_id')} - count(*) OVER (PARTITION BY provider_id, service_date)
            + row_number() OVER (PARTITION BY provider_id, service_date ORDER BY claim_id) AS provider_claim_count_30d
            FROM claims""",
    ),
    "duplicate_indicator": with_(INJECTED, f"SELECT claim_id, {DUPLICATE} AS duplicate_indicator FROM injected"),
    "provider_zscore": with_(INJECTED, f"SELECT claim_id, {r(ZSCORE)} AS provider_paid_zscore FROM injected"),
    "row_features": with_(
        INJECTED,
        f"SELECT claim_id, {r('ln(1e0 + paid_amount)')} AS paid_amount_log, {WEEKEND} AS weekend_service FROM injected",
    ),
    "claim_features": with_(
        FEATURED,
        f"""SELECT claim_id, claim_type, diagnosis_count, procedure_count, units, length_of_stay,
            provider_claim_count_30d, beneficiary_claim_count_30d, duplicate_indicator, weekend_service,
            {r('paid_amount_log')} AS paid_amount_log, {r('provider_paid_zscore')} AS provider_paid_zscore
            FROM featured""",
    ),
    "rule_score": with_(ruled(), "SELECT claim_id, rule_score FROM ruled"),
    "rule_score_default": with_(ruled("3e0", 20, 40, 12), "SELECT claim_id, rule_score FROM ruled"),
    "reason_codes": with_(ruled(), f"SELECT claim_id, {CODES} AS rule_reason_codes FROM ruled"),
    "avg_rank_pct": with_(
        AMOUNT_ONLY, f"SELECT claim_id, {r(rank_share('model_anomaly_score'))} AS score_percentile FROM amounts"
    ),
    "ecdf_percentile": with_(
        AMOUNT_ONLY
        + """,
steps AS (
  SELECT DISTINCT model_anomaly_score AS score,
         count(*) OVER (ORDER BY model_anomaly_score) / CAST(count(*) OVER () AS DOUBLE) AS share
  FROM amounts WHERE claim_type = 'carrier'
)""",
        f"""SELECT claim_id, {r('coalesce(share, 0e0)')} AS model_score_percentile
            FROM amounts ASOF LEFT JOIN steps ON model_anomaly_score >= score""",
    ),
    "quantile_flag": with_(
        AMOUNT_ONLY,
        """SELECT claim_id, CASE WHEN model_anomaly_score >=
           (SELECT quantile_cont(model_anomaly_score, 0.95) FROM amounts) THEN 1 ELSE 0 END AS model_is_flagged
           FROM amounts""",
    ),
    "feature_statistics": with_(FEATURED, STATISTICS),
    "model_matrix": with_(FEATURED, f"SELECT claim_id, {MATRIX} FROM featured"),
    "category_counts": with_(INJECTED, "SELECT claim_type, count(*) AS claims FROM injected GROUP BY claim_type"),
    "ensemble_rank": with_(
        RANKED,
        """SELECT claim_id, model_score_percentile, ensemble_score, is_flagged, score_percentile, anomaly_score
           FROM ranked""",
    ),
    "ensemble_cutoff": with_(RANKED, f"SELECT {r('quantile_cont(ensemble_score, 0.95)')} AS ensemble_threshold FROM blended"),
    "top_k_claims": with_(
        RANKED,
        """SELECT claim_id, rule_score, ensemble_score FROM ranked
           ORDER BY rule_score DESC, ensemble_score DESC, claim_id LIMIT 200""",
    ),
    "precision_recall_at_k": with_(
        RANKED,
        f"""SELECT rows, injected_anomalies, top_k, true_positives_at_k, precision_at_k, recall_at_k
            FROM {metrics_of('anomaly_score')}""",
    ),
    "roc_auc": with_(
        AMOUNT_ONLY,
        f"""SELECT rows, injected_anomalies, roc_auc FROM
            {metrics_of('model_anomaly_score', '(SELECT *, 0 AS ensemble_score FROM amounts)')}""",
    ),
    "average_precision": with_(
        AMOUNT_ONLY,
        f"""SELECT average_precision FROM
            {metrics_of('model_anomaly_score', '(SELECT *, 0 AS ensemble_score FROM amounts)')}""",
    ),
    "compare_strategies": with_(
        RANKED,
        " UNION ALL ".join(
            f"SELECT '{name}' AS strategy, * FROM {metrics_of(score)}"
            for name, score in {
                "isolation_forest": "model_anomaly_score",
                "rules": "rule_score",
                "ensemble": "ensemble_score",
            }.items()
        ),
    ),
    "evaluate_flagged": with_(
        RANKED,
        f"""SELECT *, (SELECT CAST(sum(is_flagged) AS BIGINT) FROM ranked) AS flagged_claims
            FROM {metrics_of('anomaly_score')}""",
    ),
    "queue_prepare": with_(
        QUEUE,
        f"""SELECT claim_id, claim_type, paid_amount, model_score_percentile, rule_score, ensemble_score, is_flagged,
            {CODES} AS rule_reason_codes, reason_codes_display, is_injected_anomaly FROM queue""",
    ),
    "csv_scored_queue": with_(
        QUEUE,
        f"""SELECT claim_id, claim_type, ensemble_score, is_flagged, {CODES} AS rule_reason_codes,
            is_injected_anomaly FROM queue""",
    ),
    "queue_filter": with_(
        QUEUE,
        f"""SELECT claim_id, claim_type, ensemble_score, {CODES} AS rule_reason_codes FROM queue
            WHERE is_flagged AND claim_type IN ('carrier', 'inpatient') AND ensemble_score >= 0.5e0
              AND list_has_any(rule_reason_codes, ['EXCESS_UNITS', 'POSSIBLE_DUPLICATE'])""",
    ),
    "export_queue_order": with_(
        QUEUE,
        """SELECT row_number() OVER (ORDER BY ensemble_score DESC, claim_id) AS place, claim_id,
           CAST(ensemble_score AS VARCHAR) AS ensemble_score, CAST(is_flagged AS VARCHAR) AS is_flagged,
           '[' || array_to_string(list_transform(rule_reason_codes, lambda c: chr(39) || c || chr(39)), ', ') || ']' AS rule_reason_codes
           FROM queue WHERE ensemble_score >= 0.3e0""",
    ),
    "metrics_document": with_(
        RANKED,
        " UNION ALL ".join(
            f"SELECT '{name}' AS ranking, unnest({names}) AS metric, unnest([{values}]) AS value FROM {metrics_of(score)}"
            for name, score, names, values in [
                ("primary", "anomaly_score", [*METRICS, "flagged_claims"], ", ".join(f"{m}::DOUBLE" for m in METRICS) + ", (SELECT sum(is_flagged) FROM ranked)::DOUBLE"),
                *[
                    (n, c, METRICS, ", ".join(f"{m}::DOUBLE" for m in METRICS))
                    for n, c in {"isolation_forest": "model_anomaly_score", "rules": "rule_score", "ensemble": "ensemble_score"}.items()
                ],
            ]
        ),
    ),
    "queue_kpis": with_(QUEUE, KPIS),
    "queue_kpis_visible": with_(QUEUE, KPIS + " WHERE is_flagged"),
    "queue_display": with_(
        QUEUE,
        """SELECT claim_id AS "Claim ID", claim_type AS "Claim type", paid_amount AS "Paid amount",
           model_score_percentile AS "Model percentile", rule_score AS "Rule score", ensemble_score AS "Ensemble score",
           is_flagged AS "Flagged", reason_codes_display AS "Review signals" FROM queue""",
    ),
    "queue_detail": with_(QUEUE, DETAILS),
    "claim_signals": with_(
        QUEUE,
        """SELECT claim_id, paid_amount, ensemble_score, CASE WHEN len(rule_reason_codes) = 0
           THEN 'Multivariate Outlier' ELSE array_to_string(list_transform(rule_reason_codes, lambda c:
             CASE c WHEN 'HIGH_PROVIDER_RELATIVE_COST' THEN 'High Provider Relative Cost'
                    WHEN 'EXCESS_UNITS' THEN 'Excess Units' WHEN 'POSSIBLE_DUPLICATE' THEN 'Possible Duplicate'
                    WHEN 'HIGH_PROVIDER_UTILIZATION' THEN 'High Provider Utilization'
                    ELSE 'High Beneficiary Utilization' END), '|') END AS review_signals
           FROM queue WHERE is_flagged""",
    ),
    "score_agreement": with_(
        QUEUE, "SELECT claim_id, model_score_percentile, rule_score, claim_type, paid_amount FROM queue"
    ),
    "reason_code_list": with_(ruled(), "SELECT DISTINCT unnest(rule_reason_codes) AS reason_code FROM ruled"),
    "claim_type_list": with_(CLAIMS, "SELECT DISTINCT claim_type FROM claims"),
    "score_histogram": "WITH " + QUEUE + HISTOGRAM,
    "claim_type_mix": with_(
        QUEUE, "SELECT claim_type, count(*) AS claims FROM queue WHERE is_flagged GROUP BY claim_type"
    ),
    "enriched_split": "WITH " + FEATURED + SPLIT,
}
