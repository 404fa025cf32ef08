"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.operators.settle import BROADCAST_ROWS, fits_broadcast

NULL_SALTS = 4096
HEAVY_SHARE = 1 / 500
HEAVY_ROWS = 1_000_000
# Keys that the sketch of frequent keys keeps: its error is far below HEAVY_SHARE.
TRACKED = 10_000


def _spread(frame: DataFrame, salts: Column) -> Column:
    """Salt that also separates equal rows as long as they come from different partitions."""
    by_value = F.pmod(F.xxhash64(*frame.columns), salts)
    return F.pmod(by_value + F.spark_partition_id(), salts).cast("int")


def keyed_join(
    facts: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str, null_keys: bool = False
) -> DataFrame:
    """Join on equal keys, kept once; with ``null_keys`` a null meets a null as well."""
    if not null_keys:
        return facts.join(lookup, list(keys), how)
    renamed = lookup.withColumnsRenamed({key: f"_key_{key}" for key in keys})
    same = [facts[key].eqNullSafe(renamed[f"_key_{key}"]) for key in keys]
    return facts.join(renamed, reduce(and_, same), how).drop(*[f"_key_{key}" for key in keys])


def join_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
    null_keys: bool = False,
) -> DataFrame:
    """Join a settled lookup table: broadcast when its counted rows and bytes allow, else shuffled.

    Each lookup row is there once per key, so the skew join can split the facts of a hot key.
    Both ways give the same rows; ``null_keys`` lets null keys meet.
    """
    small = fits_broadcast(lookup, broadcast_rows)
    return keyed_join(facts, F.broadcast(lookup) if small else lookup, keys, how, null_keys)


def key_counts(
    facts: DataFrame, key: str, share: float = HEAVY_SHARE, at_least: int = HEAVY_ROWS
) -> list[tuple]:
    """``(key, rows)`` of keys of over ``share`` of the rows and ``at_least`` rows, in one pass.

    No key is shuffled: a mergeable sketch of bounded size counts frequent keys, from above, so none
    is missed; a key listed needlessly costs a little balance and changes no result. There can be
    fewer than 1/share such keys and some near it.
    """
    found = facts.where(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"approx_top_k(`{key}`, {int(2 / share)}, {TRACKED})").alias("top")).first()
    bar = max(found.rows * share, at_least)
    return sorted((item["item"], item["count"]) for item in found.top or [] if item["count"] > bar)


def heavy_keys(
    facts: DataFrame, key: str, share: float = HEAVY_SHARE, at_least: int = HEAVY_ROWS
) -> DataFrame:
    """The keys of :func:`key_counts`, with the tasks each needs as ``_salts``."""
    rows = [(value, -(-rows // max(at_least, 1))) for value, rows in key_counts(
        facts, key, share, at_least)]
    kind = facts.select(key).schema[0].dataType.simpleString()
    return facts.sparkSession.createDataFrame(rows, f"`{key}` {kind}, _salts int")


def join_skewed(
    facts: DataFrame,
    other: DataFrame,
    key: str,
    how: str = "inner",
    share: float = HEAVY_SHARE,
    at_least: int = HEAVY_ROWS,
) -> DataFrame:
    """Inner or left join of two large tables, in one join whose heavy keys are salted.

    A heavy key is spread over as many tasks as its counted rows need, and only its rows of
    ``other`` are copied, once for each. Rows without a key match nothing and are spread.
    """
    heavy = F.broadcast(heavy_keys(facts, key, share, at_least))
    salts = F.coalesce("_salts", F.lit(1))
    wide = F.when(F.col(key).isNull(), F.lit(NULL_SALTS)).otherwise(salts)
    salted = facts.join(heavy, key, "left").withColumn("_salt", _spread(facts, wide)).drop("_salts")
    copies = other.join(heavy, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return salted.join(copies, [key, "_salt"], how).drop("_salt")
