"""Training set, feature stages, class weights, splits and folds."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua import config
from punctua.functions.columns import is_complete
from punctua.operators.joins import join_lookup
from punctua.operators.selection import FEW_ROWS, cut_points
from punctua.operators.settle import gather, settle

ROWS_PER_TASK = 10_000
ROWS_PER_SHORT_TASK = 40_000
# More tasks than this only when a task would hold more than the largest number of rows.
FEW_TASKS = 64
MAX_ROWS_PER_TASK = 2_000_000
# Tasks of a fit that holds the statistics of all nodes of a level in each, and rows of one beyond.
FEW_HEAVY_TASKS = 12
ROWS_PER_HEAVY_TASK = 4_000_000


def training_set(trips: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Features as doubles and the label, complete rows only; ``keep`` adds key columns."""
    features = [F.col(name).cast("double").alias(name) for name in config.FEATURES]
    label = F.col(config.LABEL).cast("double").alias(config.LABEL)
    table = trips.select(*keep, *features, label)
    return table.where(is_complete(table, [*config.FEATURES, config.LABEL]))


def spread_for_fitting(frame: DataFrame) -> DataFrame:
    """Partitions by hashed content for many passes over ``frame``.

    Samples of trees follow the partitions, so their number comes from the rows alone: the same
    rows and seed give the same model on every cluster.
    """
    rows = frame.count()
    wanted = max(1, min(FEW_TASKS, -(-rows // ROWS_PER_TASK)), -(-rows // MAX_ROWS_PER_TASK))
    columns = sorted(frame.columns)
    return frame.repartition(int(wanted), *columns).sortWithinPartitions(*columns)


def for_short_steps(frame: DataFrame, rows: int, side_by_side: int = 1) -> DataFrame:
    """Fewer partitions of a small frame for fits that run one short job per step.

    Rows are dealt by content again, so that samples of trees do not depend on where cached
    partitions lie. A frame whose partitions already hold many rows is left as it is. Of as many
    fits ``side_by_side`` each gets its part of the tasks.
    """
    wanted = max(1, -(-rows // (ROWS_PER_SHORT_TASK * side_by_side)))
    if wanted > FEW_TASKS:
        return frame
    columns = sorted(frame.columns)
    return frame.repartition(wanted, *columns).sortWithinPartitions(*columns)


def for_heavy_steps(frame: DataFrame, rows: int, side_by_side: int = 1) -> DataFrame:
    """Fewer partitions for fits whose tasks each make, send and merge as many statistics.

    In a forest those are the counts of all nodes of a level of all trees, whatever the rows of the
    task: many tasks of few rows cost more in them than in rows. Rows are dealt by content again; a frame
    of as few partitions is left as it is. Of as many fits ``side_by_side`` each gets its part of the tasks.
    """
    wanted = max(-(-FEW_HEAVY_TASKS // side_by_side), -(-rows // ROWS_PER_HEAVY_TASK))
    if frame.rdd.getNumPartitions() <= wanted:
        return frame
    columns = sorted(frame.columns)
    return frame.repartition(wanted, *columns).sortWithinPartitions(*columns)


def assembler(output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=config.FEATURES, outputCol=output, handleInvalid="skip")


def scaler(centre: bool) -> StandardScaler:
    """Unit deviation; ``centre`` also moves the mean to 0."""
    return StandardScaler(
        inputCol="raw_features", outputCol="features", withMean=centre, withStd=True
    )


def class_weights(frame: DataFrame, label: str = config.LABEL) -> DataFrame:
    """Balanced weight per class: rows / (classes x rows of the class)."""
    sizes = settle(frame.groupBy(label).agg(F.count(F.lit(1)).alias("n")))
    rows, classes = sizes.agg(F.sum("n"), F.count(F.lit(1))).first()
    weight = F.lit(float(rows or 0)) / (F.lit(classes) * F.col("n"))
    return sizes.select(label, "n", weight.alias("weight"))


def add_class_weights(frame: DataFrame, label: str = config.LABEL) -> DataFrame:
    return join_lookup(frame, class_weights(frame, label), [label], null_keys=True)


@dataclass(frozen=True)
class Moments:
    """Rows, and per feature the mean and the sum of squared deviations from it."""

    rows: int
    means: tuple[float, ...]
    squares: tuple[float, ...]

    def without(self, part: Moments) -> Moments:
        """Those of the other rows."""
        rows = self.rows - part.rows
        if rows <= 0:
            return Moments(0, (0.0,) * len(self.means), (0.0,) * len(self.means))
        means = tuple((self.rows * a - part.rows * b) / rows
                      for a, b in zip(self.means, part.means))
        squares = tuple(
            max(0.0, whole - own - rows * part.rows / self.rows * (mean - other) ** 2)
            for whole, own, mean, other in zip(self.squares, part.squares, means, part.means))
        return Moments(rows, means, squares)

    def deviations(self) -> tuple[float, ...]:
        """Sample deviations, 0 where there are fewer than two rows."""
        return tuple(math.sqrt(s / (self.rows - 1)) if self.rows > 1 else 0.0 for s in self.squares)


@dataclass(frozen=True)
class FoldTotals:
    """Class sizes and feature moments of all rows and of each fold, from one aggregation."""

    classes: dict[int, dict[float, int]]
    moments: dict[int, Moments]
    whole_classes: dict[float, int]
    whole: Moments

    def train_classes(self, fold: int) -> dict[float, int]:
        """Class sizes of the rows outside a fold; classes without rows there are left out."""
        own = self.classes.get(fold, {})
        left = {label: n - own.get(label, 0) for label, n in self.whole_classes.items()}
        return {label: n for label, n in left.items() if n > 0}

    def train_moments(self, fold: int) -> Moments:
        return self.whole.without(self.moments[fold]) if fold in self.moments else self.whole


def fold_totals(folded: DataFrame, label: str = config.LABEL) -> FoldTotals:
    """Totals of every fold; what is left without one follows by subtraction.

    One row for each fold and class comes here, and one for each fold and for all rows.
    """
    measures = [F.count(F.lit(1)).alias("n")]
    for i, name in enumerate(config.FEATURES):
        measures += [F.avg(name).alias(f"mean{i}"),
                     (F.var_pop(name) * F.count(name)).alias(f"square{i}")]
    rows = folded.rollup("fold", label).agg(F.grouping_id().alias("level"), *measures).collect()
    counts: dict[int, dict[float, int]] = {}
    moments: dict[int, Moments] = {}
    whole = Moments(0, (), ())
    for row in rows:
        if row.level == 0:
            counts.setdefault(row.fold, {})[row[label]] = row.n
            continue
        size = range(len(config.FEATURES))
        made = Moments(row.n, tuple(row[f"mean{i}"] or 0.0 for i in size),
                       tuple(row[f"square{i}"] or 0.0 for i in size))
        if row.level == 1:
            moments[row.fold] = made
        else:
            whole = made
    sizes: dict[float, int] = {}
    for own in counts.values():
        for value, n in own.items():
            sizes[value] = sizes.get(value, 0) + n
    return FoldTotals(counts, moments, sizes, whole)


def weight_of(sizes: Mapping[float, int], label: str = config.LABEL) -> Column:
    """Balanced class weight as a column, from known class sizes."""
    rows, column = sum(sizes.values()), F.lit(None).cast("double")
    for value, n in sizes.items():
        column = F.when(F.col(label).eqNullSafe(F.lit(value)), F.lit(rows / (len(sizes) * n))
                        ).otherwise(column)
    return column


def scaled(frame: DataFrame, moments: Moments) -> DataFrame:
    """Features centred and scaled to unit deviation, by known moments; a constant becomes 0."""
    return frame.withColumns({
        name: (F.col(name) - F.lit(mean)) * F.lit(1 / deviation if deviation > 0 else 0.0)
        for name, mean, deviation in zip(config.FEATURES, moments.means, moments.deviations())
    })


def shuffle_order(key: str, seed: int = config.SEED) -> Column:
    """Repeatable shuffled order of a key."""
    return F.xxhash64(F.col(key), F.lit(seed))


def _bands(
    frame: DataFrame, label: str, order: Column, shares: Sequence[float], small_rows: int
) -> DataFrame:
    """Add ``_band``: how many of the cut points of its class lie before the row."""
    cuts = gather(cut_points(frame, label, order, shares, small_rows))  # one row for each class
    placed = join_lookup(
        frame.withColumn("_order", order), cuts, [label], "inner", null_keys=True
    )
    passed = F.filter("_cuts", lambda cut: cut.isNull() | (F.col("_order") > cut))
    return placed.withColumn("_band", F.size(passed)).drop("_order", "_cuts")


def stratified_split(
    frame: DataFrame,
    label: str = config.LABEL,
    key: str = "trip_id",
    test_share: float = config.TEST_SHARE,
    order: Column | None = None,
    small_rows: int = FEW_ROWS,
) -> DataFrame:
    """Add ``is_test``: exactly the rounded share of each class, repeatable by key and seed.

    Rows without a label are a class of their own.

    Only the one cut point of each class is computed; marking rows needs no shuffle.
    """
    place = shuffle_order(key) if order is None else order
    banded = _bands(frame, label, place, [test_share], small_rows)
    return banded.withColumn("is_test", F.col("_band") == 0).drop("_band")


def stratified_folds(
    frame: DataFrame,
    folds: int = config.FOLDS,
    label: str = config.LABEL,
    key: str = "trip_id",
    order: Column | None = None,
    small_rows: int = FEW_ROWS,
) -> DataFrame:
    """Add ``fold`` (0 .. folds-1) with equal shares of each class."""
    place = shuffle_order(key) if order is None else order
    steps = [i / folds for i in range(1, folds)]
    return _bands(frame, label, place, steps, small_rows).withColumnRenamed("_band", "fold")


def random_split(
    frame: DataFrame, test_share: float = config.TEST_SHARE, seed: int = config.SEED
) -> list[DataFrame]:
    """Random training and test part."""
    return frame.randomSplit([1 - test_share, test_share], seed)
