"""Global ranks, cumulative distributions and exact quantiles without a global sort.

A score column is first reduced to its distinct values with counts. These are cut into buckets of
about equal size; running counts are taken inside each bucket and shifted by the totals of the
lower buckets. Only the bucket totals (a bounded number of rows) meet in one task. Ranks,
percentiles, quantiles, ROC-AUC and average precision all read the resulting table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_BUCKETS = 4_096
NARROW_ENOUGH = 100_000
#: Scores in a bucket of a distribution that is made for look-ups: a row that is looked up carries its bucket along.
LOOKED_UP = 256
NARROWING = 0.005
GRID_BUCKETS = 64


def split_points(df: DataFrame, columns: list[str], buckets: int | None = None) -> dict[str, list[float]]:
    """Approximate quantiles per column, as literals. They only steer how evenly the buckets are
    filled; being literals, they put a row in the same bucket whenever a task is run again."""
    wanted = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(1, min(wanted, MAX_BUCKETS))
    if wanted == 1:
        return {c: [] for c in columns}
    probabilities = [i / wanted for i in range(1, wanted)]
    found = df.approxQuantile(columns, probabilities, 1.0 / (4 * wanted))
    return {c: sorted({v for v in values if math.isfinite(v)}) for c, values in zip(columns, found)}


def bucketed(
    df: DataFrame, column: str, splits: list[float], out: str = "_bucket", invalid: str = "error"
) -> DataFrame:
    """Bucket number by binary search in ``splits``, the same on every retry; with ``invalid="keep"``
    nulls get a bucket of their own."""
    edges = [-math.inf, *splits, math.inf] if splits else [-math.inf, 0.0, math.inf]
    return Bucketizer(splits=edges, inputCol=column, outputCol=out, handleInvalid=invalid).transform(df)


def rank_table(
    df: DataFrame,
    score: str,
    label: str | None = None,
    unit_grid: bool = False,
    splits: list[float] | None = None,
) -> DataFrame:
    """One row per distinct score: ``score, n, positives, upto, positives_upto, total,
    total_positives``; ``upto`` counts the rows with a score not above this one.

    ``unit_grid=True`` is for scores in [0, 1] rounded to 6 digits: their buckets are a plain
    expression and no pass for split points is needed.
    """
    value = F.col(score).cast("double") + F.lit(0.0)  # -0.0 becomes 0.0
    positive = F.col(label).cast("long") if label else F.lit(0).cast("long")
    rows = df.select(value.alias("score"), positive.alias("_positive")).filter(F.col("score").isNotNull())
    counted = rows.groupBy("score").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_positive"), F.lit(0)).alias("positives")
    )
    if unit_grid:
        counted = counted.withColumn("_bucket", F.floor(F.col("score") * GRID_BUCKETS).cast("double"))
    else:
        if splits is None:
            splits = split_points(rows, ["score"])["score"]
        counted = bucketed(counted, "score", splits)
    everything = Window.orderBy("_bucket")
    lower = everything.rowsBetween(Window.unboundedPreceding, -1)
    whole = everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shifts = (
        counted.groupBy("_bucket")
        .agg(F.sum("n").alias("_n"), F.sum("positives").alias("_p"))
        .select(
            "_bucket",
            F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_below"),
            F.coalesce(F.sum("_p").over(lower), F.lit(0)).alias("_positives_below"),
            F.sum("_n").over(whole).alias("total"),
            F.sum("_p").over(whole).alias("total_positives"),
        )
    )
    inside = Window.partitionBy("_bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
    # At most MAX_BUCKETS + 1 rows, whatever the data.
    return counted.withColumns(
        {"_upto": F.sum("n").over(inside), "_positives_upto": F.sum("positives").over(inside)}
    ).join(F.broadcast(shifts), "_bucket").select(
        "score",
        "n",
        "positives",
        (F.col("_upto") + F.col("_below")).alias("upto"),
        (F.col("_positives_upto") + F.col("_positives_below")).alias("positives_upto"),
        "total",
        "total_positives",
    )


def average_rank_share() -> Column:
    """Average rank of tied rows over the number of rows, from the columns of a rank table."""
    rank = F.col("upto") - (F.col("n") - 1) / F.lit(2.0)
    return rank / F.col("total")


def with_avg_rank_pct(df: DataFrame, score: str, out: str, table: DataFrame | None = None) -> DataFrame:
    """Adds ``out``, the average-tie rank share of ``score`` in this table (not rounded)."""
    table = rank_table(df, score) if table is None else table
    shares = table.select(F.col("score").alias("_score"), average_rank_share().alias(out))
    key = F.col(score).cast("double") + F.lit(0.0)
    return df.join(shares, key == F.col("_score"), "left").drop("_score")


def quantile_of(table: DataFrame, share: float, out: str = "quantile") -> DataFrame:
    """The exact quantile with linear interpolation, as a one-row table.

    The table is filtered to the one or two scores at the wanted places; nothing is sorted.
    """
    place = (F.col("total") - 1) * F.lit(float(share))
    before = F.col("upto") - F.col("n")

    def holds(index: Column) -> Column:
        return (before <= index) & (index < F.col("upto"))

    near = table.filter(holds(F.floor(place)) | holds(F.ceil(place)))
    ends = near.agg(
        F.min("score").alias("_a"), F.max("score").alias("_b"), F.max(place - F.floor(place)).alias("_t")
    )
    a, b, t = F.col("_a"), F.col("_b"), F.col("_t")
    step = b - a
    return ends.select(F.when(t >= 0.5, b - step * (1 - t)).otherwise(a + step * t).alias(out))


def column_quantiles(df: DataFrame, columns: list[str], share: float) -> dict[str, float]:
    """The exact quantile of several columns at once (nulls left out), as numbers on the driver.

    Selection by narrowing. A Greenwald-Khanna sketch, whose error in rank is bounded, puts a bracket
    around the wanted place; one pass counts exactly how many values lie below, at and inside its ends;
    the place then lies in one of five stretches, which becomes the next bracket. So each bracket is
    proven by counts, whatever the sketch said, and only the values of a bracket that holds few of them are
    counted one by one. Nothing is sorted as a whole.
    """
    typed = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])
    sizes = typed.agg(*[F.count(c).alias(c) for c in columns]).first()
    spans = {c: Span(-math.inf, math.inf, 0, sizes[c], (sizes[c] - 1) * share) for c in columns if sizes[c]}
    while wide := [c for c, s in spans.items() if s.low < s.high and s.inside > NARROW_ENOUGH]:
        tried = _sketched(typed, {c: spans[c] for c in wide})
        counted = typed.agg(
            *[
                F.count_if(test).alias(f"{c}{i}")
                for c, (a, b) in tried.items()
                for i, test in enumerate((F.col(c) < a, F.col(c) <= a, F.col(c) < b, F.col(c) <= b))
            ]
        ).first()
        for c, (a, b) in tried.items():
            spans[c] = spans[c].narrowed(a, b, [counted[f"{c}{i}"] for i in range(4)])
    return _interpolated(typed, spans)


@dataclass(frozen=True)
class Span:
    """A closed stretch of values that holds the ``floor(place)``-th smallest one (from 0), with the exact
    number of values below and inside it."""

    low: float
    high: float
    below: int
    inside: int
    place: float

    def narrowed(self, a: float, b: float, counts: list[int]) -> Span:
        """The one of the stretches before a, at a, between, at b and after b that holds the place;
        ``counts`` are the values below a, up to a, below b and up to b."""
        under_a, upto_a, under_b, upto_b = counts
        after = self.below + self.inside
        cuts = [
            (self.low, math.nextafter(a, -math.inf), self.below, under_a),
            (a, a, under_a, upto_a),
            (math.nextafter(a, math.inf), math.nextafter(b, -math.inf), upto_a, under_b),
            (b, b, max(under_b, upto_a), upto_b),
            (math.nextafter(b, math.inf), self.high, upto_b, after),
        ]
        wanted = math.floor(self.place)
        low, high, first, end = next(cut for cut in cuts if cut[2] <= wanted < cut[3])
        return Span(low, high, first, end - first, self.place)


def _sketched(typed: DataFrame, spans: dict[str, Span]) -> dict[str, tuple[float, float]]:
    """A value on either side of each place, as far apart as the sketch may be wrong."""
    accuracy, asked = round(2 / NARROWING), {}
    for c, s in spans.items():
        value = F.when((F.col(c) >= F.lit(s.low)) & (F.col(c) <= F.lit(s.high)), F.col(c))
        at = (math.floor(s.place) - s.below) / s.inside
        ends = [max(at - NARROWING, 0.0), min(at + NARROWING, 1.0)]
        asked[c] = F.percentile_approx(value, ends, accuracy).alias(c)
    found = typed.agg(*asked.values()).first()
    return {c: tuple(found[c]) for c in spans}


def _interpolated(typed: DataFrame, spans: dict[str, Span]) -> dict[str, float]:
    """The quantiles from spans of few different values: the value at the place, and the next one."""
    if not spans:
        return {}
    names = list(spans)
    cells = [
        F.struct(F.lit(i).alias("i"), F.when((F.col(c) >= F.lit(spans[c].low)) & (F.col(c) <= F.lit(spans[c].high)), F.col(c)).alias("score"))
        for i, c in enumerate(names)
    ]
    counted = typed.select(F.inline(F.array(*cells))).filter(F.col("score").isNotNull()).groupBy("i", "score").agg(F.count(F.lit(1)).alias("n"))
    below = F.element_at(F.array(*[F.lit(spans[c].below) for c in names]), F.col("i") + 1)
    first = F.element_at(F.array(*[F.lit(math.floor(spans[c].place)) for c in names]), F.col("i") + 1)
    # NARROW_ENOUGH different values of a column at most, whatever the data.
    upto = below + F.sum("n").over(Window.partitionBy("i").orderBy("score"))
    placed = counted.select("i", "score", upto.alias("upto"), first.alias("first")).filter("upto > first")
    values = {r["i"]: r["s"] for r in placed.groupBy("i").agg(F.min(F.struct("score", "upto")).alias("s")).collect()}
    out, later = {}, {}
    for i, c in enumerate(names):
        step = spans[c].place - math.floor(spans[c].place)
        out[c] = values[i]["score"] + 0.0
        if step and values[i]["upto"] <= math.floor(spans[c].place) + 1:
            later[c] = step  # the next value differs
    if later:
        following = typed.agg(*[F.min(F.when(F.col(c) > F.lit(out[c]), F.col(c))).alias(c) for c in later]).first()
        out |= {c: out[c] + (following[c] - out[c]) * step for c, step in later.items()}
    return out


def with_quantile_flag(
    df: DataFrame, score: str, flag_rate: float, out: str, table: DataFrame | None = None
) -> DataFrame:
    """Adds ``out``: 1 where the score reaches the ``1 - flag_rate`` quantile (ties all flagged)."""
    table = rank_table(df, score) if table is None else table
    threshold = quantile_of(table, 1 - flag_rate).scalar()
    return df.withColumn(out, (F.col(score) >= threshold).cast("int"))


def lookup_splits(table: DataFrame, splits: list[float]) -> list[float]:
    """Split points for ``ecdf_cells`` over a rank table: as many as its scores need, ``LOOKED_UP`` a bucket, up
    to ``MAX_BUCKETS`` buckets. A looked-up row holds its bucket's scores until its share is found, so their number
    must not grow with the table."""
    wanted = math.ceil(table.count() / LOOKED_UP)
    return split_points(table, ["score"], wanted)["score"] if wanted > len(splits) + 1 else splits


def ecdf_cells(reference: DataFrame, splits: list[float]) -> DataFrame:
    """A cumulative distribution made ready for look-ups: per bucket of ``splits`` the sorted scores of a
    rank table, the share of rows up to each, and the share below the bucket.

    Every bucket has a row, also one without scores, so an equi-join on the bucket finds each answer.
    """
    steps = bucketed(reference.select("score", (F.col("upto") / F.col("total")).alias("share")), "score", splits)
    filled = steps.groupBy("_bucket").agg(
        F.sort_array(F.collect_list(F.struct("score", "share"))).alias("_steps"), F.max("share").alias("_top")
    )
    buckets = reference.sparkSession.range(max(len(splits), 1) + 1).select(F.col("id").cast("double").alias("_bucket"))
    lower = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # MAX_BUCKETS + 1 rows at most
    none = F.array().cast("array<double>")
    return buckets.join(filled, "_bucket", "left").select(
        "_bucket",
        F.coalesce(F.max("_top").over(lower), F.lit(0.0)).alias("_below"),
        F.coalesce(F.col("_steps")["score"], none).alias("_scores"),
        F.coalesce(F.col("_steps")["share"], none).alias("_shares"),
    )


def with_ecdf_percentile(df: DataFrame, score: str, cells: DataFrame, splits: list[float], out: str) -> DataFrame:
    """Adds ``out``, the share of the reference rows with a score not above this one; null for no score.

    ``cells`` is the reference as ``ecdf_cells`` lays it out over the same ``splits``. One equi-join on the
    bucket, then a binary search inside the row: no state and no sorting, so ``df`` may be a stream.
    """
    value = F.col("_value")
    placed = df.withColumn("_value", F.col(score).cast("double") + F.lit(0.0))
    joined = bucketed(placed, "_value", splits, invalid="keep").join(cells, "_bucket", "left")
    n = F.size("_scores")

    def halve(span: Column, _: Column) -> Column:
        low, high = span["low"], span["high"]
        middle = F.shiftright(low + high, 1)
        reached = F.get(F.col("_scores"), middle) <= value
        moved = F.struct(
            F.when(reached, middle + 1).otherwise(low).alias("low"), F.when(reached, high).otherwise(middle).alias("high")
        )
        return F.when(low < high, moved).otherwise(span)

    steps = F.sequence(F.lit(1), F.greatest(F.ceil(F.log2(n + 1)).cast("int"), F.lit(1)))
    found = F.aggregate(steps, F.struct(F.lit(0).alias("low"), n.alias("high")), halve, lambda span: span["low"])
    share = F.coalesce(F.get(F.col("_shares"), found - 1), F.col("_below"))
    return joined.withColumn(out, F.when(value.isNotNull(), share)).drop("_value", "_bucket", "_below", "_scores", "_shares")
