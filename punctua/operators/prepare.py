"""Cleaning and enrichment of trips and pings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua import config
from punctua.functions.columns import (
    calendar, clamp, complement, encode, hour_in_range, is_complete, load_share, minutes_between,
    off_schedule,
)
from punctua.operators.buckets import join_buckets
from punctua.operators.headway import add_headway
from punctua.operators.joins import join_lookup, join_skewed
from punctua.operators.settle import gather


def derive_trip_columns(
    trips: DataFrame, tolerance: float = config.Targets.tolerance_minutes
) -> DataFrame:
    """Delay, flags, load and calendar columns from the recorded times and counts."""
    delay = minutes_between(F.col("scheduled_depart"), F.col("actual_depart"))
    when = calendar(F.col("scheduled_depart"))
    return (
        trips.withColumn("delay_minutes", delay)
        .withColumn("is_delayed", off_schedule(F.col("delay_minutes"), tolerance))
        .withColumn("service_reliability_flag", complement(F.col("is_delayed")))
        .withColumn("load_factor", load_share(F.col("passenger_count"), F.col("capacity")))
        .withColumns({name: when[name] for name in ("day_of_week", "hour_of_night")})
    )


def clean_trips(trips: DataFrame) -> DataFrame:
    """Drop trips without a key, route, delay or label; fix types; clamp the delay.

    Text that is not a number becomes null and so drops the row where the column is required.
    """
    kinds = {"delay_minutes": "double", "is_delayed": "int", "load_factor": "double"}
    typed = trips.withColumns({
        name: F.col(name).try_cast(kind) for name, kind in kinds.items() if name in trips.columns
    })
    return typed.where(is_complete(typed, config.REQUIRED_TRIP_COLUMNS)).withColumn(
        "delay_minutes_clipped", clamp(F.col("delay_minutes"), *config.STORED_DELAY_BOUNDS)
    )


def add_weather_code(trips: DataFrame) -> DataFrame:
    return trips.withColumn("weather_code", encode(F.col("weather"), config.WEATHER_CODES))


def filter_trips(
    trips: DataFrame,
    operators: Sequence[str] | None = None,
    routes: Sequence[str] | None = None,
    hours: tuple[int, int] | None = None,
) -> DataFrame:
    """Trips of the chosen operators, routes and hours; None leaves a choice open."""
    if operators is not None:
        trips = trips.where(F.col("operator").isin(list(operators)))
    if routes is not None:
        trips = trips.where(F.col("service_code").isin(list(routes)))
    if hours is not None:
        trips = trips.where(hour_in_range(F.col("hour_of_night"), *hours))
    return trips


def _duration_aggregates() -> list[Column]:
    return [
        F.mean("actual_duration_min").alias("mean_dur"),
        F.stddev("actual_duration_min").alias("std_dur"),
        F.count(F.lit(1)).alias("trip_count"),
    ]


def _on_time_share() -> Column:
    on_time = F.sum("service_reliability_flag") / F.count(F.lit(1))
    return on_time.alias("pct_on_time")


def _with_variation(stats: DataFrame) -> DataFrame:
    return stats.withColumn("cv_travel_time", F.try_divide("std_dur", "mean_dur"))


def route_measures(trips: DataFrame, *more: Column) -> DataFrame:
    """Duration statistics, on-time share and ``more`` aggregates per route, in one pass."""
    return _with_variation(
        trips.groupBy("service_code").agg(*_duration_aggregates(), _on_time_share(), *more)
    )


def route_duration_stats(trips: DataFrame) -> DataFrame:
    """Mean, sample deviation and coefficient of variation of the travel time per route."""
    return _with_variation(trips.groupBy("service_code").agg(*_duration_aggregates()))


def route_on_time(trips: DataFrame) -> DataFrame:
    """On-time trips over all trips per route; a null flag counts as not on time."""
    return trips.groupBy("service_code").agg(_on_time_share())


def route_disruption_counts(disruptions: DataFrame) -> DataFrame:
    """Disruptions and high-severity disruptions per route, over all time."""
    return disruptions.groupBy("service_code").agg(
        F.count(F.lit(1)).alias("disruption_count"),
        F.sum(F.when(F.col("severity") == "High", 1).otherwise(0)).alias("high_severity_count"),
    )


def route_features(
    trips: DataFrame, disruptions: DataFrame, train_only: Column | None = None
) -> DataFrame:
    """One row per route: travel-time statistics, on-time share, disruption counts.

    Duration and on-time columns come from one aggregation. With ``train_only`` the statistics
    that see the label are taken from the rows it selects; routes without such rows keep null.
    """
    on_time = _on_time_share()
    if train_only is not None:
        rows = F.sum(F.when(train_only, 1).otherwise(0))
        hits = F.sum(F.when(train_only, F.col("service_reliability_flag")))
        on_time = F.try_divide(hits, rows).alias("pct_on_time")
    by_route = _with_variation(
        trips.groupBy("service_code").agg(*_duration_aggregates(), on_time)
    )
    return by_route.join(route_disruption_counts(disruptions), "service_code", "left").fillna(
        0, ["disruption_count", "high_severity_count"]
    )


def add_route_features(trips: DataFrame, features: DataFrame) -> DataFrame:
    """Attach route features to each trip; routes are few unless counted otherwise."""
    return join_lookup(trips, features.drop("trip_count"), ["service_code"])


def build_trips(
    trips: DataFrame, disruptions: DataFrame, train_only: Column | None = None
) -> DataFrame:
    """Cleaned and enriched trips with the stored columns, in ranges of route and departure."""
    cleaned = clean_trips(trips)
    features = gather(route_features(cleaned, disruptions, train_only))
    with_features = add_route_features(add_weather_code(cleaned), features)
    return add_headway(with_features).select(*config.TRIP_COLUMNS)


def trip_keys(trips: DataFrame) -> DataFrame:
    """What pings take from their trip, once for each trip."""
    return trips.select("trip_id", "service_code", "operator", "is_delayed")


def match_pings(pings: DataFrame, trips: DataFrame) -> DataFrame:
    """Every ping, with route, operator and label of its trip where there is one."""
    return join_skewed(pings, trip_keys(trips), "trip_id", "left").select(*config.PING_COLUMNS)


def enrich_pings(pings: DataFrame, trips: DataFrame) -> DataFrame:
    """Pings of known trips, with route, operator and label of the trip."""
    known = trip_keys(trips).where(F.col("service_code").isNotNull())
    return join_skewed(pings, known, "trip_id", "inner").select(*config.PING_COLUMNS)


def enrich_stored(pings: DataFrame, keys: DataFrame, heavy: Sequence = ()) -> DataFrame:
    """:func:`enrich_pings` with keys stored in buckets of trip_id.

    Pings stored in as many buckets are not shuffled, others once. ``keys`` holds
    :func:`trip_keys`, ``heavy`` the trips of so many pings that they go apart, never shuffled.
    """
    known = keys.where(F.col("service_code").isNotNull())
    return join_buckets(pings, known, "trip_id", "inner", heavy).select(*config.PING_COLUMNS)
