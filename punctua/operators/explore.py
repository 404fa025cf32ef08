"""Exploratory statistics: profiles, distributions, correlations, pivots."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua import config
from punctua.functions.columns import clamp, corrected_kurtosis, corrected_skewness, number
from punctua.operators.selection import FEW_ROWS, percentiles

# Weather order of the box plot.
BOX_ORDER = ["Clear", "Rain", "Windy", "Fog", "Snow"]


def hour_profile(trips: DataFrame) -> DataFrame:
    """Mean, sample deviation and number of delays per hour."""
    delay = number("delay_minutes")
    return trips.groupBy("hour_of_night").agg(
        F.mean(delay).alias("mean"), F.stddev(delay).alias("std"), F.count(delay).alias("count")
    )


def frequencies(frame: DataFrame, column: str) -> DataFrame:
    """How often each non-null value occurs, most frequent first."""
    return (
        frame.where(F.col(column).isNotNull()).groupBy(column)
        .agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), column)
    )


def shares(frame: DataFrame, column: str) -> DataFrame:
    """Share of the non-null rows that each value holds."""
    counts = (
        frame.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    )
    total = counts.agg(F.sum("n").alias("_rows"))  # one row
    return counts.crossJoin(F.broadcast(total)).select(
        column, (F.col("n") / F.col("_rows")).alias("share"))


def route_scatter(trips: DataFrame, targets: config.Targets = config.Targets()) -> DataFrame:
    """Per route: on-time share, travel-time variation, disruptions, and both target checks."""
    return (
        trips.groupBy("service_code")
        .agg(
            (1 - F.mean("is_delayed")).alias("pct_on_time"),
            F.mean(number("cv_travel_time")).alias("cv"),
            F.mean("disruption_count").alias("avg_disruptions"),
        )
        .withColumn("meets_on_time", F.col("pct_on_time") >= F.lit(targets.on_time_share))
        .withColumn("meets_cv", F.col("cv") <= F.lit(targets.travel_time_cv))
    )


def describe(
    frame: DataFrame,
    value: str,
    shares: Sequence[float] = (0.25, 0.5, 0.75, 0.9, 0.95),
    small_rows: int = FEW_ROWS,
) -> DataFrame:
    """One row: count, mean, deviation, minimum, exact percentiles, maximum.

    A null or NaN enters none of them. Percentiles are selected by counting digits, so no value is
    shuffled; ``small_rows`` are counted by whole values at once.
    """
    quantiles = percentiles(frame, value, shares, few_rows=small_rows)
    names = [f"p{round(share * 100)}" for share in shares]
    by_rank = quantiles.select(
        *[F.element_at("q", i + 1).alias(name) for i, name in enumerate(names)]
    )
    known = number(value)
    basics = frame.agg(
        F.count(known).alias("count"), F.mean(known).alias("mean"),
        F.stddev(known).alias("std"), F.min(known).alias("min"), F.max(known).alias("max"),
    )
    parts = basics.unionByName(by_rank, allowMissingColumns=True)
    order = ["count", "mean", "std", "min", *names, "max"]
    return parts.agg(*[F.max(name).alias(name) for name in order])


def sketch_size(rank_error: float) -> int:
    """Size parameter of a KLL sketch whose normalised rank error is ``rank_error``.

    By the published fit for 99 % confidence, 2.296 / k ** 0.9723; sizes go from 8 to 65,535.
    """
    if not 0 < rank_error < 1:
        raise ValueError("the rank error must be between 0 and 1")
    size = math.ceil((2.296 / rank_error) ** (1 / 0.9723))
    if size > 65_535:
        raise ValueError("no sketch is as exact as that; take describe")
    return max(8, size)


def describe_approx(
    frame: DataFrame,
    value: str,
    shares: Sequence[float] = (0.25, 0.5, 0.75, 0.9, 0.95),
    rank_error: float = 0.01,
) -> DataFrame:
    """:func:`describe` with percentiles off by at most ``rank_error`` of the rows, in one pass.

    The percentiles come from a mergeable KLL sketch of bounded size: each is a value of the
    column whose rank is that close to the wanted one, with 99 % confidence.
    """
    known = number(value)
    sketched = frame.agg(
        F.count(known).alias("count"), F.mean(known).alias("mean"),
        F.stddev(known).alias("std"), F.min(known).alias("min"), F.max(known).alias("max"),
        F.kll_sketch_agg_double(known, F.lit(sketch_size(rank_error))).alias("_sketch"),
    )
    found = [F.when(F.col("count") > 0, F.kll_sketch_get_quantile_double(
        "_sketch", F.lit(float(share)))).alias(f"p{round(share * 100)}") for share in shares]
    return sketched.select("count", "mean", "std", "min", *found, "max")


def shape(frame: DataFrame, value: str) -> DataFrame:
    """One row: bias-corrected skewness and excess kurtosis."""
    known = number(value)
    return frame.agg(
        corrected_skewness(known).alias("skewness"), corrected_kurtosis(known).alias("kurtosis")
    )


def _co_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per pair of columns, over the rows of a task where both are known, as ``MOMENTS``.

    Values are taken around the means of the first batch, so that sums of squares stay exact
    where a column lies far from 0.
    """
    centre, sums = None, None
    for batch in batches:
        values = np.stack([
            column.to_numpy(zero_copy_only=False).astype(np.float64) for column in batch.columns], 1)
        known = ~np.isnan(values)
        if centre is None:
            totals = np.where(known, values, 0).sum(0)
            centre = totals / np.maximum(known.sum(0), 1)
            centre[~np.isfinite(centre)] = 0.0
        values = np.where(known, values - centre, 0.0)
        mask = known.astype(np.float64)
        # Row a, column b: what a adds up to over the rows where b is known as well.
        part = np.stack([mask.T @ mask, values.T @ mask, (values * values).T @ mask,
                         values.T @ values])
        sums = part if sums is None else sums + part
    if sums is None:
        return
    rows, first, second, cross = sums
    left, right = np.triu_indices(len(rows), 1)
    n = rows[left, right]
    some = n > 0
    left, right, n = left[some], right[some], n[some]
    a, b = first[left, right] / n, first[right, left] / n
    yield pa.RecordBatch.from_arrays(
        [pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)), pa.array(n),
         pa.array(centre[left] + a), pa.array(centre[right] + b),
         pa.array(second[left, right] - n * a * a), pa.array(second[right, left] - n * b * b),
         pa.array(cross[left, right] - n * a * b)],
        ["a", "b", "n", "mean_a", "mean_b", "square_a", "square_b", "cross"])


MOMENTS = ("a int, b int, n double, mean_a double, mean_b double, square_a double, "
           "square_b double, cross double")


def _merged(one: Column, two: Column) -> Column:
    """Moments of two parts together."""
    n = one["n"] + two["n"]
    weight = one["n"] * two["n"] / n
    apart_a, apart_b = two["mean_a"] - one["mean_a"], two["mean_b"] - one["mean_b"]
    return F.struct(
        n.alias("n"), (one["mean_a"] + apart_a * two["n"] / n).alias("mean_a"),
        (one["mean_b"] + apart_b * two["n"] / n).alias("mean_b"),
        (one["square_a"] + two["square_a"] + apart_a * apart_a * weight).alias("square_a"),
        (one["square_b"] + two["square_b"] + apart_b * apart_b * weight).alias("square_b"),
        (one["cross"] + two["cross"] + apart_a * apart_b * weight).alias("cross"),
    )


def correlations(
    frame: DataFrame, columns: Sequence[str] = config.CORRELATED_COLUMNS
) -> DataFrame:
    """Pearson correlation of each column pair, over the rows where both are known.

    One lazy pass for columns with and without gaps: each task sends one row of moments for each
    pair, which are merged pair by pair. A pair without rows or with a constant is null.
    """
    numbers = frame.select(*[number(name).alias(name) for name in columns])
    fields = ["n", "mean_a", "mean_b", "square_a", "square_b", "cross"]
    parts = numbers.mapInArrow(_co_moments, MOMENTS).groupBy("a", "b").agg(
        F.collect_list(F.struct(*fields)).alias("parts"))  # one for each task
    zero = F.struct(*[F.lit(0.0).alias(name) for name in fields])
    merged = parts.select("a", "b", F.aggregate("parts", zero, lambda one, two: F.when(
        one["n"] == 0, two).otherwise(_merged(one, two))).alias("m"))
    scale = F.sqrt(F.col("m.square_a") * F.col("m.square_b"))
    found = merged.select("a", "b", F.when(scale > 0, F.col("m.cross") / scale).alias("correlation"))
    pairs = frame.sparkSession.createDataFrame(
        [(i, j, columns[j], columns[i]) for i, j in combinations(range(len(columns)), 2)],
        "a int, b int, row_name string, column_name string")
    return pairs.join(F.broadcast(found), ["a", "b"], "left").select(  # one row for each pair
        "row_name", "column_name", "correlation")


def histogram(
    frame: DataFrame,
    value: str,
    bins: int = 60,
    bounds: tuple[float, float] = config.PLOTTED_DELAY_BOUNDS,
) -> DataFrame:
    """Equal-width bins over the range of the clamped values: ``bin, lower, upper, n``.

    Bins are closed on the left, the last one on both sides; empty bins are listed. Equal
    values get a range of width 1 around them.
    """
    clamped = frame.select(clamp(number(value), *bounds).alias("x")).where(F.col("x").isNotNull())
    ends = clamped.agg(F.min("x").alias("a"), F.max("x").alias("b"))  # one row
    apart = F.col("a") < F.col("b")
    ends = ends.select(
        F.when(F.col("a").isNull(), 0.0).otherwise(F.when(apart, F.col("a")).otherwise(F.col("a") - 0.5))
        .alias("_low"),
        F.when(F.col("a").isNull(), 1.0).otherwise(F.when(apart, F.col("b")).otherwise(F.col("b") + 0.5))
        .alias("_high"),
    ).withColumn("_width", (F.col("_high") - F.col("_low")) / F.lit(bins))

    def edge(number: Column) -> Column:
        return F.when(number == bins, F.col("_high")).otherwise(
            F.col("_low") + number * F.col("_width"))

    guess = F.least(F.floor((F.col("x") - F.col("_low")) / F.col("_width")), F.lit(bins - 1))
    placed = clamped.crossJoin(F.broadcast(ends)).withColumn("_guess", guess).select(
        F.when(F.col("x") < edge(F.col("_guess")), F.col("_guess") - 1)
        .when((F.col("_guess") < bins - 1) & (F.col("x") >= edge(F.col("_guess") + 1)),
              F.col("_guess") + 1)
        .otherwise(F.col("_guess")).alias("bin")
    )
    filled = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    spine = frame.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return spine.join(filled, "bin", "left").crossJoin(F.broadcast(ends)).select(
        F.col("bin").cast("int").alias("bin"),
        edge(F.col("bin")).alias("lower"),
        edge(F.col("bin") + 1).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_summary(
    frame: DataFrame,
    group: str = "weather",
    value: str = "delay_minutes",
    order: Sequence[str] = BOX_ORDER,
    small_rows: int = FEW_ROWS,
) -> DataFrame:
    """Quartiles and whiskers per group: the outermost values within 1.5 quartile ranges.

    Quartiles are selected by counting digits; they meet the rows by broadcast, one row for each name
    in ``order``, and whiskers and counts are partial aggregates.
    """
    rows = frame.select(group, number(value).alias(value)).where(
        F.col(group).isin(list(order)) & F.col(value).isNotNull())
    quartiles = percentiles(rows, value, [0.25, 0.5, 0.75], [group], small_rows).select(
        group, *[F.element_at("q", i + 1).alias(f"q{i + 1}") for i in range(3)])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    known = F.col(value)
    lowest = F.min(F.when(known >= F.col("q1") - reach, known))
    highest = F.max(F.when(known <= F.col("q3") + reach, known))
    return (
        rows.join(F.broadcast(quartiles), group)
        .groupBy(group, "q1", "q2", "q3")
        .agg(F.count(F.lit(1)).alias("n"), lowest.alias("_low"), highest.alias("_high"))
        .select(
            group, "n", "q1", F.col("q2").alias("median"), "q3",
            F.least("_low", "q1").alias("whisker_low"),
            F.greatest("_high", "q3").alias("whisker_high"),
        )
    )


def route_hour_pivot(trips: DataFrame, hours: Sequence[int] = range(24)) -> DataFrame:
    """Share of delayed trips per route (row) and hour (column ``h0``, ...); null without trips."""
    wide = (
        trips.groupBy("service_code").pivot("hour_of_night", list(hours))
        .agg(F.avg("is_delayed"))
    )
    return wide.select("service_code", *[F.col(str(h)).alias(f"h{h}") for h in hours])


def distinct_values(frame: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Sorted distinct values, or the first ``limit`` of them."""
    values = frame.select(column).distinct().orderBy(column)
    return values if limit is None else values.limit(limit)


def first_rows(frame: DataFrame, key: str, limit: int = 20) -> DataFrame:
    """First rows in key order."""
    return frame.orderBy(key).limit(limit)
