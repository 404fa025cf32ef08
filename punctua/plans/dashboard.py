"""Filtered queries behind the operations view; each takes stored trips."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from punctua.operators.explore import distinct_values, histogram, route_hour_pivot
from punctua.operators.kpi import operator_profile
from punctua.operators.prepare import filter_trips

DEFAULT_ROUTES = 5
DEFAULT_HOURS = (22, 5)
BINS = 50


@dataclass(frozen=True)
class Choice:
    """Filters; None leaves one open."""

    operators: Sequence[str] | None = None
    routes: Sequence[str] | None = None
    hours: tuple[int, int] | None = None

    def apply(self, trips: DataFrame) -> DataFrame:
        return filter_trips(trips, self.operators, self.routes, self.hours)


def default_choice(trips: DataFrame) -> Choice:
    """The first five routes in string order, all operators and hours."""
    first = distinct_values(trips, "service_code", DEFAULT_ROUTES).collect()
    return Choice(routes=[row.service_code for row in first])


def operator_overview(trips: DataFrame, choice: Choice) -> DataFrame:
    return operator_profile(choice.apply(trips))


def delay_distribution(trips: DataFrame, choice: Choice) -> DataFrame:
    return histogram(choice.apply(trips), "delay_minutes", BINS)


def delay_heatmap(trips: DataFrame, choice: Choice) -> DataFrame:
    return route_hour_pivot(choice.apply(trips))
