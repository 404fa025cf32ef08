import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from punctua.operators import explore
from punctua.operators.ordering import running_totals
from punctua.operators.selection import cut_points, percentiles
from punctua.operators.settle import store

SIZES = [10**6, 0]


def frame_of(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def sample(seed, n=500):
    dice = random.Random(seed)
    return [round(dice.gauss(2, 9), 1) for _ in range(n)]


@pytest.mark.parametrize("small_rows", SIZES)
def test_running_totals_by_key(spark, small_rows):
    rows = [(k, i, (i * 7) % 5) for k in ("a", "b", "c") for i in range(60)]
    table = store(spark.createDataFrame(rows, "k string, i int, n int").repartition(4))
    found = running_totals(table, ["k"], [F.col("i").desc()], {"n": "upto"}, small_rows)
    got = {(r.k, r.i): r.upto for r in found.collect()}
    wanted = {
        (k, i): sum(n for key, j, n in rows if key == k and j >= i) for k, i, _ in rows
    }
    assert got == wanted


@pytest.mark.parametrize("small_rows", SIZES)
@pytest.mark.parametrize("values", [sample(1), [3.0], [1.0, 1.0, 1.0], [5.0, None, 1.0, 2.0]])
def test_percentiles_equal_numpy(spark, small_rows, values):
    shares = [0.0, 0.25, 0.5, 0.9, 0.95, 1.0]
    found = percentiles(frame_of(spark, values), "x", shares, few_rows=small_rows).first().q
    assert found == pytest.approx(list(np.quantile([v for v in values if v is not None], shares)))


@pytest.mark.parametrize("small_rows", SIZES)
def test_percentiles_by_group(spark, small_rows):
    groups = {"a": sample(2, 101), "b": sample(3, 40), "c": [7.0]}
    rows = [(g, v) for g, values in groups.items() for v in values]
    frame = spark.createDataFrame(rows, "g string, x double")
    found = {r.g: r.q for r in percentiles(frame, "x", [0.1, 0.75], ["g"], small_rows).collect()}
    for group, values in groups.items():
        assert found[group] == pytest.approx(list(np.quantile(values, [0.1, 0.75])))


@pytest.mark.parametrize("small_rows", SIZES)
def test_cut_points_keep_equal_values_together(spark, small_rows):
    rows = [("a", i) for i in range(10)] + [("b", 1)] * 6 + [("b", 2)] * 4
    frame = spark.createDataFrame(rows, "g string, x int")
    found = {r.g: r._cuts for r in cut_points(frame, "g", F.col("x"), [0.0, 0.2, 0.5], small_rows).collect()}
    assert found == {"a": [None, 1, 4], "b": [None, 1, 1]}


def test_describe_equals_pandas(spark):
    values = sample(4)
    row = explore.describe(frame_of(spark, values), "x").first()
    wanted = pd.Series(values).describe(percentiles=[0.25, 0.5, 0.75, 0.9, 0.95])
    assert list(row) == pytest.approx(list(wanted))


def test_shape_equals_pandas(spark):
    values = sample(5)
    row = explore.shape(frame_of(spark, values), "x").first()
    assert row.skewness == pytest.approx(pd.Series(values).skew())
    assert row.kurtosis == pytest.approx(pd.Series(values).kurt())


@pytest.mark.parametrize("values", [sample(6), [4.0] * 5, [0.0, 0.1, 9.9, 10.0], [-99.0, 99.0, 1.0]])
def test_histogram_equals_numpy(spark, values):
    found = explore.histogram(frame_of(spark, values), "x", 20).orderBy("bin").collect()
    counts, edges = np.histogram(np.clip(values, -15, 30), bins=20)
    assert [r.n for r in found] == list(counts)
    assert [r.lower for r in found] == pytest.approx(list(edges[:-1]))
    assert [r.upper for r in found] == pytest.approx(list(edges[1:]))


def test_histogram_of_nothing(spark):
    found = explore.histogram(frame_of(spark, [None, None]), "x", 4).collect()
    assert [r.n for r in found] == [0, 0, 0, 0]


@pytest.mark.parametrize("small_rows", SIZES)
def test_box_summary(spark, small_rows):
    values = {"Clear": [1.0, 2.0, 3.0, 4.0, 100.0, 3.0], "Snow": [5.0], "Hail": [1.0]}
    rows = [(w, v) for w, vs in values.items() for v in vs]
    frame = spark.createDataFrame(rows, "weather string, delay_minutes double")
    found = {r.weather: r for r in explore.box_summary(frame, small_rows=small_rows).collect()}
    assert set(found) == {"Clear", "Snow"}
    clear = found["Clear"]
    q1, q2, q3 = np.quantile(values["Clear"], [0.25, 0.5, 0.75])
    assert (clear.q1, clear.median, clear.q3) == pytest.approx((q1, q2, q3))
    assert (clear.whisker_low, clear.whisker_high, clear.n) == (1.0, 4.0, 6)
    assert (found["Snow"].whisker_low, found["Snow"].whisker_high) == (5.0, 5.0)


def test_correlations_skip_incomplete_pairs(spark):
    data = pd.DataFrame({"a": [1.0, 2, 3, 4, None], "b": [2.0, 1, None, 5, 9],
                         "c": [1.0, 0, 1, 0, 2], "d": [3.0, 3, 1, 0, 2]})
    rows = [tuple(None if pd.isna(v) else float(v) for v in row) for row in data.itertuples(index=False)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double")
    found = {(r.column_name, r.row_name): r.correlation
             for r in explore.correlations(frame, list("abcd")).collect()}
    wanted = data.corr()
    assert found == pytest.approx({(x, y): wanted.loc[x, y] for x, y in found})
    assert len(found) == 6


def test_correlation_with_a_constant_is_unknown(spark):
    frame = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, b double")
    assert explore.correlations(frame, ["a", "b"]).first().correlation is None


def test_pivot_leaves_unused_cells_null(spark):
    frame = spark.createDataFrame(
        [("N1", 22, 1), ("N1", 22, 0), ("N2", 5, 1)], "service_code string, hour_of_night int, is_delayed int"
    )
    found = {r.service_code: r for r in explore.route_hour_pivot(frame).collect()}
    assert found["N1"].h22 == 0.5 and found["N1"].h5 is None and found["N2"].h5 == 1.0
    assert len(found["N1"]) == 25


def test_frequencies_and_shares(spark):
    frame = frame_of(spark, ["b", "a", "b", None, "c", "a"], "string")
    counted = [(r.x, r["count"]) for r in explore.frequencies(frame, "x").collect()]
    assert counted == [("a", 2), ("b", 2), ("c", 1)]
    shares = {r.x: r.share for r in explore.shares(frame, "x").collect()}
    assert shares == {"a": 0.4, "b": 0.4, "c": 0.2}


def test_distinct_values_in_string_order(spark):
    frame = frame_of(spark, ["N2", "N10", "N1", "N11", "N10"], "string")
    assert [r.x for r in explore.distinct_values(frame, "x", 3).collect()] == ["N1", "N10", "N11"]


def test_correlations_far_from_zero_and_in_one_scan(spark):
    dice = random.Random(3)
    rows = [(1e9 + dice.random(), 1e9 + dice.random() * (i % 7), None if i % 5 else float(i), float("nan"))
            for i in range(400)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(6)
    found = explore.correlations(frame, list("abcd"))
    data = pd.DataFrame(rows, columns=list("abcd"))
    data[["a", "b"]] -= 1e9
    wanted = data.corr()
    for row in found.collect():
        value = wanted.loc[row.column_name, row.row_name]
        assert row.correlation == (None if np.isnan(value) else pytest.approx(value, abs=1e-6))
    assert explore.correlations(frame.limit(0), ["a", "b"]).first().correlation is None


@pytest.mark.parametrize("rank_error", [0.05, 0.005])
def test_sketched_percentiles_are_within_their_error(spark, rank_error):
    values = sample(7, 20_000)
    row = explore.describe_approx(frame_of(spark, values).repartition(8), "x", rank_error=rank_error).first()
    ranked = np.sort(values)
    for share, name in ((0.25, "p25"), (0.5, "p50"), (0.95, "p95")):
        low, high = np.searchsorted(ranked, row[name]), np.searchsorted(ranked, row[name], "right")
        assert low <= (share + rank_error) * 20_000 + 1 and high >= (share - rank_error) * 20_000 - 1
    assert row["count"] == 20_000 and row["min"] == ranked[0] and row["max"] == ranked[-1]
    assert explore.describe_approx(frame_of(spark, [None]), "x").first().p50 is None
    with pytest.raises(ValueError):
        explore.sketch_size(1e-6)
