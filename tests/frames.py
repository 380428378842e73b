"""Small hand-made tables."""

CLAIM = (
    "claim_id string, beneficiary_id string, provider_id string, claim_type string, service_date string, "
    "paid_amount double, diagnosis_count long, procedure_count long, units long, length_of_stay long"
)
FIVE = [
    ("K7", "ann", "doc-a", "carrier", "2023-03-06", 120.0, 2, 1, 3, 0),
    ("K8", "bo", "doc-a", "carrier", "2023-03-20", 180.0, 1, 2, 4, 0),
    ("K9", "ann", "doc-a", "inpatient", "2023-04-04", 240.0, 4, 2, 1, 5),
    ("L1", "cy", "doc-b", "pharmacy", "2023-03-11", 75.0, 1, 1, 9, 0),
    ("L2", "ann", "doc-b", "pharmacy", "2023-03-12", 95.0, 1, 1, 2, 0),
]


def five_claims(spark):
    return spark.createDataFrame(FIVE, CLAIM)


def by_id(df, *columns):
    rows = df.select("claim_id", *columns).collect()
    return {r[0]: (r[1] if len(columns) == 1 else tuple(r[1:])) for r in rows}


def dated(spark, days, key="P1", ids=None):
    """Claims of one provider, each of another beneficiary, on the given day numbers."""
    from datetime import date, timedelta

    rows = [
        (
            (ids or [f"C{i:03d}" for i in range(len(days))])[i],
            f"B{i}",
            key,
            "carrier",
            str(date(2024, 1, 1) + timedelta(days=d)),
            float(100 + i),
            1,
            1,
            1,
            0,
        )
        for i, d in enumerate(days)
    ]
    return spark.createDataFrame(rows, CLAIM)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
