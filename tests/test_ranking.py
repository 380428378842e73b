import numpy as np
import pandas as pd
import pytest
from frames import by_id, plan_of
from pyspark.sql import functions as F

from reviewrank.operators import ranking as rk


def table_of(spark, values, partitions=5):
    pdf = pd.DataFrame({"claim_id": [f"C{i:05d}" for i in range(len(values))], "s": values})
    return spark.createDataFrame(pdf, "claim_id string, s double").repartition(partitions)


@pytest.fixture(scope="module")
def scores():
    """Continuous values, a block of one value over a third of the rows, and both zeros."""
    rng = np.random.default_rng(5)
    return np.concatenate([rng.normal(size=900), np.full(700, 0.25), np.full(60, 0.0), np.full(60, -0.0), rng.integers(0, 5, 280)])


@pytest.mark.parametrize("buckets", [None, 1, 33])
def test_average_rank_matches_pandas(spark, scores, buckets):
    df = table_of(spark, scores)
    splits = None if buckets is None else rk.split_points(df, ["s"], buckets)["s"]
    table = rk.rank_table(df, "s", splits=splits)
    found = by_id(rk.with_avg_rank_pct(df, "s", "p", table), "p")
    wanted = pd.Series(scores).rank(method="average", pct=True)
    assert [found[f"C{i:05d}"] for i in range(len(scores))] == pytest.approx(list(wanted), abs=1e-12)


def test_partitions_do_not_change_ranks(spark, scores):
    found = [by_id(rk.with_avg_rank_pct(table_of(spark, scores, n), "s", "p"), "p") for n in (1, 4, 64)]
    assert found[0] == found[1] == found[2]


def test_unit_grid_equals_general_table(spark):
    values = np.round(np.random.default_rng(1).random(500), 2)
    df = table_of(spark, np.concatenate([values, [0.0, 1.0]]))
    general, grid = (rk.rank_table(df, "s", unit_grid=g).orderBy("score").collect() for g in (False, True))
    assert general == grid


@pytest.mark.parametrize("share", [0.0, 0.05, 0.5, 0.77, 0.95, 1.0])
def test_quantile_matches_numpy(spark, scores, share):
    table = rk.rank_table(table_of(spark, scores), "s")
    assert rk.quantile_of(table, share).first()[0] == pytest.approx(np.quantile(scores, share), abs=1e-12)


def columns_of(spark):
    rng = np.random.default_rng(2)
    n = 3_000
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 4, n).astype(float), "c": np.full(n, 7.0)})
    pdf["d"] = np.where(np.arange(n) < n * 0.498, -5.0, np.where(np.arange(n) < n * 0.503, rng.random(n), 5.0))
    pdf["e"] = np.where(np.arange(n) < n // 2, 1.0, 2.0)  # the middle lies between two values
    pdf.loc[:99, "a"] = np.nan
    pdf["none"] = np.nan
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("share", [0.0, 0.5, 0.95, 1.0])
def test_column_quantiles_narrow_to_the_exact_value(spark, monkeypatch, share):
    monkeypatch.setattr(rk, "NARROW_ENOUGH", 10)
    monkeypatch.setattr(rk, "NARROWING", 0.02)
    pdf, df = columns_of(spark)
    found = rk.column_quantiles(df, list(pdf.columns), share)
    assert "none" not in found
    for c in "abcde":
        assert found[c] == pytest.approx(pdf[c].quantile(share), abs=1e-12)


@pytest.mark.parametrize("side", ["below", "above", "one value"])
def test_a_missed_bracket_is_seen_by_the_counts(spark, monkeypatch, side):
    """Whatever the sketch says, the next bracket is one that the exact counts prove."""
    pdf, df = columns_of(spark)
    honest, lies = rk._sketched, []

    def sketched(typed, spans):
        if len(lies) < 2:
            lies.append(1)
            return {c: {"below": (-9.0, -8.5), "above": (8.5, 9.0), "one value": (0.7, 0.7)}[side] for c in spans}
        return honest(typed, spans)

    monkeypatch.setattr(rk, "NARROW_ENOUGH", 10)
    monkeypatch.setattr(rk, "_sketched", sketched)
    found = rk.column_quantiles(df, list("abde"), 0.5)
    for c in "abde":
        assert found[c] == pytest.approx(pdf[c].quantile(0.5), abs=1e-12)


def cells_of(spark, values, buckets=None):
    df = table_of(spark, values)
    splits = rk.split_points(df, ["s"], buckets)["s"]
    return rk.ecdf_cells(rk.rank_table(df, "s", splits=splits), splits), splits


@pytest.mark.parametrize("buckets", [None, 1, 33])
def test_ecdf_matches_searchsorted(spark, scores, buckets):
    rng = np.random.default_rng(9)
    asked = np.concatenate([rng.normal(size=300) * 3, scores[:200], [-99.0, 99.0, 0.25, -0.0]])
    cells, splits = cells_of(spark, scores, buckets)
    df = table_of(spark, asked).withColumn("_scores_of_mine", F.lit(1))
    found = by_id(rk.with_ecdf_percentile(df, "s", cells, splits, "p"), "p")
    wanted = np.searchsorted(np.sort(scores), asked, side="right") / len(scores)
    assert [found[f"C{i:05d}"] for i in range(len(asked))] == pytest.approx(list(wanted), abs=1e-12)


def test_ecdf_of_nothing_and_of_no_score(spark):
    cells, splits = cells_of(spark, [1.0, 2.0])
    df = table_of(spark, [0.0, 1.5, 2.0]).withColumn("s", F.when(F.col("s") > 0, F.col("s")))
    assert by_id(rk.with_ecdf_percentile(df, "s", cells, splits, "p"), "p") == {"C00000": None, "C00001": 0.5, "C00002": 1.0}
    empty, splits = cells_of(spark, np.array([], dtype=float))
    assert set(by_id(rk.with_ecdf_percentile(df.filter("s > 1"), "s", empty, splits, "p"), "p").values()) == {0.0}


def test_only_bucket_totals_meet_in_one_partition(spark, scores):
    """The single-partition exchange is fed by sums per bucket, never by rows or scores."""
    text = plan_of(rk.with_avg_rank_pct(table_of(spark, scores), "s", "p"))
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            assert any("keys=[_bucket" in below for below in lines[i + 1 : i + 3])
    assert "SinglePartition" in text


def test_null_scores_have_no_rank(spark):
    df = table_of(spark, [1.0, 2.0, 3.0]).withColumn("s", F.when(F.col("s") > 1, F.col("s")))
    assert by_id(rk.with_avg_rank_pct(df, "s", "p"), "p") == {"C00000": None, "C00001": 0.5, "C00002": 1.0}
