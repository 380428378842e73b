"""Labelled anomalies put into a claims table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewrank.functions.expr import hash52, np_round
from reviewrank.session import few, written

# Scenario names in order, and the fields a copied claim takes from its donor.
SCENARIOS = ["high_paid", "excess_units", "duplicate_like", "utilization_spike"]
COPIED_FIELDS = [
    "beneficiary_id",
    "provider_id",
    "claim_type",
    "service_date",
    "paid_amount",
    "diagnosis_count",
    "procedure_count",
    "units",
    "length_of_stay",
]
MOST_ASKED = 2_000_000  # wanted donors up to which their keys are broadcast
SLICES = 20  # hashes are first counted by their 20 highest bits


def _hash(key: Column, purpose: str, seed: int) -> Column:
    return hash52(seed, purpose, key)


def uniform(key: Column, purpose: str, seed: int) -> Column:
    """A number in [0, 1) that depends on the key, the purpose and the seed only."""
    return _hash(key, purpose, seed).cast("double") * F.lit(2.0**-52)


def pick_exactly(claims: DataFrame, wanted: int, seed: int) -> Column:
    """A condition that holds for exactly ``wanted`` rows, those with the smallest hashed ids.

    Found by counting: hashes per slice (at most 2^20 rows), then the place inside the one slice
    in which the count is reached. No global sort, and no large limit.
    """
    place = _hash(F.col("claim_id"), "pick", seed)
    slice_of = F.shiftright(place, 52 - SLICES)
    running = F.sum("count").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, 0))
    reached = (
        claims.groupBy(slice_of.alias("slice"))
        .count()
        .withColumn("upto", running)
        .filter(F.col("upto") >= wanted)
        .orderBy("slice")
        .first()
    )
    if reached is None:
        return F.lit(True)
    rest = wanted - (reached["upto"] - reached["count"])
    last = (
        claims.filter(slice_of == reached["slice"])
        .select(place.alias("place"), "claim_id")
        .orderBy("place", "claim_id")
        .limit(rest)
        .agg(F.max(F.struct("place", "claim_id")).alias("last"))
        .first()["last"]
    )
    return (place < last["place"]) | ((place == last["place"]) & (F.col("claim_id") <= last["claim_id"]))


def inject(
    claims: DataFrame,
    picked: Column,
    scenario: Column,
    donors: DataFrame | Callable[[DataFrame], DataFrame],
    donor_key: Column,
    paid_factor: Column,
    spike_factor: Column,
    new_units: Column,
    spike_procedures: Column,
    spike_diagnoses: Column,
) -> DataFrame:
    """Changes the picked rows by their scenario and labels them.

    ``donors`` has ``donor_key`` and the copied fields under the prefix ``donor_``, or makes such a table
    for the keys that are asked for. Only the rows that copy another claim are joined with it; the others
    are projected where they are. The few copies are written before and after the join.
    """
    labelled = claims.withColumns(
        {
            "is_injected_anomaly": F.when(picked, 1).otherwise(0),
            "anomaly_scenario": F.when(picked, scenario).otherwise("none"),
        }
    )
    kind = F.col("anomaly_scenario")
    factor = F.when(kind == "high_paid", paid_factor).when(kind == "utilization_spike", spike_factor)
    changed = {
        "paid_amount": np_round(F.col("paid_amount") * F.coalesce(factor, F.lit(1.0)), 2),
        "units": F.when(kind == "excess_units", new_units.cast("long")).otherwise(F.col("units")),
        "procedure_count": F.when(kind == "utilization_spike", spike_procedures.cast("long")).otherwise(
            F.col("procedure_count")
        ),
        "diagnosis_count": F.when(kind == "utilization_spike", spike_diagnoses.cast("long")).otherwise(
            F.col("diagnosis_count")
        ),
    }
    copies = written(labelled.filter(kind.eqNullSafe("duplicate_like")).withColumn("donor_key", donor_key), "copies")
    found = donors(copies.select("donor_key")) if callable(donors) else donors
    copied = (
        copies.join(found, "donor_key", "left")
        .withColumns({c: F.coalesce(F.col(f"donor_{c}"), F.col(c)) for c in COPIED_FIELDS})
        .withColumn("paid_amount", np_round(F.col("paid_amount"), 2))
        .select(*labelled.columns)
    )
    return labelled.filter(~kind.eqNullSafe("duplicate_like")).withColumns(changed).unionByName(written(copied, "copied"))


def donor_table(claims: DataFrame, key: Column, order: Column, asked: DataFrame | None = None) -> DataFrame:
    """One donor per key: the first row in the given order, with its fields under ``donor_``. ``asked`` has the
    wanted keys as ``donor_key``; without it there is a donor for every key."""
    fields = [F.col(c).alias(f"donor_{c}") for c in COPIED_FIELDS]
    best = F.min(F.struct(order.alias("_at"), F.col("claim_id").alias("_id"), F.struct(*fields).alias("row")))
    keyed = claims.withColumn("donor_key", key)
    if asked is not None:
        keyed = keyed.join(F.broadcast(asked) if few(asked, MOST_ASKED) else asked, "donor_key", "left_semi")
    return keyed.groupBy("donor_key").agg(best.alias("best")).select("donor_key", "best.row.*")


def inject_at_rate(claims: DataFrame, rate: float, seed: int) -> DataFrame:
    """Exactly ``max(1, round(rows * rate))`` anomalies with random scenarios, chosen by hash.

    Donors are read from the unchanged table: claims fall into about as many hashed groups as there
    are copies, the first of each group is its donor, and every copy draws one group.
    """
    if not 0 < rate < 0.25:
        raise ValueError("the share of anomalies must lie between 0 and 0.25")
    wanted = max(1, round(claims.count() * rate))
    groups = max(1, wanted // 4)
    key = F.col("claim_id")

    def draw(purpose: str) -> Column:
        return uniform(key, purpose, seed)

    def between(purpose: str, low: float, high: float) -> Column:
        return F.lit(low) + draw(purpose) * (high - low)

    names = F.array(*[F.lit(s) for s in SCENARIOS])
    return inject(
        claims,
        picked=pick_exactly(claims, wanted, seed),
        scenario=F.element_at(names, (F.floor(draw("scenario") * len(SCENARIOS)) + 1).cast("int")),
        donors=lambda asked: donor_table(
            claims, F.pmod(_hash(key, "donor group", seed), F.lit(groups)), _hash(key, "donor", seed), asked
        ),
        donor_key=F.pmod(_hash(key, "donor of", seed), F.lit(groups)),
        paid_factor=between("paid", 8, 18),
        spike_factor=between("spike", 3, 6),
        new_units=F.floor(between("units", 30, 100)),
        spike_procedures=F.floor(between("procedures", 12, 25)),
        spike_diagnoses=F.floor(between("diagnoses", 12, 25)),
    )
