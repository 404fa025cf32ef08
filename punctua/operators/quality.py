"""Data rules; each gives one row ``(rule, checked, violations)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua import config


@dataclass(frozen=True)
class Checked:
    """A table, its key, and what is checked of it.

    ``unique`` names the rule that the key occurs once, ``rules`` the others with their conditions
    of violation. ``uses`` gives for a rule the column that refers to another table, and that
    table's place in the list.
    """

    frame: DataFrame
    key: str
    unique: str
    rules: Mapping[str, Column] = field(default_factory=dict)
    uses: Mapping[str, tuple[str, int]] = field(default_factory=dict)


def check_tables(tables: Sequence[Checked]) -> DataFrame:
    """All rules of some tables; every table is read once, and one shuffle serves all of them.

    Each row gives an entry for its key, one for each key that it refers to, and one for each rule
    that it breaks. Entries of one key meet, whichever table they come from: a key without an entry
    of its own table is unknown, so references need no join. Copies are folded before the
    shuffle, so a hot key is one row for each task. Nothing runs before the result is read.
    """
    rules = [(place, name) for place, table in enumerate(tables) for name in table.rules]
    uses = [name for table in tables for name in table.uses]
    measures = ["own", *[f"use{i}" for i in range(len(uses))]]

    def entry(what: int, key: Column, measure: str) -> Column:
        return F.struct(F.lit(what).alias("what"), key.cast("string").alias("key"),
                        *[F.lit(int(name == measure)).alias(name) for name in measures])

    parts = []
    for place, table in enumerate(tables):
        found = [entry(place, F.col(table.key), "own")]
        found += [entry(parent, F.col(column), f"use{uses.index(name)}")
                  for name, (column, parent) in table.uses.items()]
        found += [F.when(condition, entry(len(tables) + rules.index((place, name)), F.lit(None), "own"))
                  for name, condition in table.rules.items()]
        parts.append(table.frame.select(F.inline(F.array(*found))).where(F.col("what").isNotNull()))
    by_key = reduce(DataFrame.unionByName, parts).groupBy("what", "key").agg(
        *[F.sum(name).alias(name) for name in measures])

    def total(what: int, measure: str, condition: Column | None = None) -> Column:
        wanted = F.col("what") == what
        wanted = wanted if condition is None else wanted & condition
        return F.coalesce(F.sum(F.when(wanted, F.col(measure))), F.lit(0))

    known = F.col("key").isNotNull()
    rows = []
    for place, table in enumerate(tables):
        checked = total(place, "own")
        rows += [(name, checked, total(len(tables) + rules.index((place, name)), "own"))
                 for name in table.rules]
        rows.append((table.unique, total(place, "own", known),
                     F.count_if((F.col("what") == place) & known & (F.col("own") > 1))))
        for name, (_, parent) in table.uses.items():
            measure = f"use{uses.index(name)}"
            rows.append((name, total(parent, measure, known),
                         total(parent, measure, known & (F.col("own") == 0))))
    counted = by_key.agg(F.array(*[
        F.struct(F.lit(name).alias("rule"), checked.alias("checked"), violations.alias("violations"))
        for name, checked, violations in rows]).alias("rows"))
    return counted.select(F.inline("rows"))


def not_null(*columns: str, prefix: str) -> dict[str, Column]:
    return {f"{prefix}_{name}_not_null": F.col(name).isNull() for name in columns}


def in_domain(column: str, values: list[str], prefix: str) -> dict[str, Column]:
    """A null passes, as it does in an SQL CHECK."""
    return {f"{prefix}_{column}_domain": ~F.col(column).isin(values)}


def in_range(column: str, low: float, high: float, prefix: str) -> dict[str, Column]:
    return {f"{prefix}_{column}_range": ~F.col(column).between(low, high)}


def rejected_lines(rows: DataFrame, rejects: DataFrame, prefix: str) -> DataFrame:
    """For each reason why lines of a text table were rejected, how many of all lines they are."""
    lines = rows.select(F.lit(None).cast("string").alias("reason")).unionByName(
        rejects.select("reason")).agg(F.count(F.lit(1)).alias("checked"))  # one row
    return (
        rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("violations"))
        .crossJoin(F.broadcast(lines))
        .select(F.concat(F.lit(f"{prefix}_rejected_"), "reason").alias("rule"), "checked", "violations")
    )


def quality_report(
    trips: DataFrame,
    disruptions: DataFrame,
    pings: DataFrame,
    read: Mapping[str, tuple[DataFrame, DataFrame]] | None = None,
) -> DataFrame:
    """All declared rules over cleaned trips, disruptions and pings, by :func:`check_tables`.

    ``read`` adds, by name of a text table, the lines that its reader kept and rejected.
    """
    parts = [check_tables([
        Checked(trips, "trip_id", "trips_trip_id_unique", {
            **not_null("service_code", "operator", "is_delayed", prefix="trips"),
            **in_range("delay_minutes_clipped", *config.STORED_DELAY_BOUNDS, prefix="trips"),
        }),
        Checked(disruptions, "disruption_id", "disruptions_disruption_id_unique", {
            **not_null("service_code", prefix="disruptions"),
            **in_domain("severity", config.SEVERITIES, prefix="disruptions"),
        }),
        Checked(pings, "location_id", "pings_location_id_unique",
                uses={"pings_trip_id_known": ("trip_id", 0)}),
    ])]
    parts += [rejected_lines(rows, rejects, name) for name, (rows, rejects) in (read or {}).items()]
    return reduce(DataFrame.unionByName, parts)
