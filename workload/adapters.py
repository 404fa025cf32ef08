"""The three raw tables expressed over generic event, order and line-item tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua.functions.columns import (
    calendar, complement, load_share, off_schedule, padded_key,
)
from punctua.plans.ingest import Raw

WIDE_TOLERANCE = 15.0


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _cycle(column: str, length: int, first: int, factor: int = 1) -> Column:
    return (F.lit(first) + F.col(column) * factor % length).cast("int")


def trips(spark: SparkSession, folder: str, tolerance: float = 2.0) -> DataFrame:
    """Trips from events: the value is the delay plus 40 minutes."""
    events = _table(spark, folder, "events")
    weather = {"view": "Clear", "click": "Rain", "purchase": "Fog", "signup": "Snow",
               "error": "Windy"}
    names = F.create_map(*[F.lit(part) for pair in weather.items() for part in pair])
    delay = F.col("value") - 40
    shift = F.round(delay * 6e7).cast("bigint")
    when = calendar(F.col("ts"))
    passengers = F.get_json_object("props", "$.k").cast("int")
    delayed = off_schedule(delay, tolerance)
    planned = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    return events.select(
        padded_key("T", 7, F.col("event_id")).alias("trip_id"),
        F.concat(F.lit("N"), (F.col("user_id") % 30 + 1).cast("string")).alias("service_code"),
        F.concat(F.lit("OP"), (F.col("event_id") % 5).cast("string")).alias("operator"),
        padded_key("STOP_", 4, F.col("user_id") % 200 + 1).alias("origin_stop"),
        padded_key("STOP_", 4, F.col("event_id") % 200 + 1).alias("destination_stop"),
        planned.alias("scheduled_depart"),
        F.timestamp_add("MICROSECOND", shift, planned).alias("actual_depart"),
        _cycle("event_id", 70, 20).alias("scheduled_duration_min"),
        _cycle("event_id", 92, 18, 7).alias("actual_duration_min"),
        names[F.col("event_type")].alias("weather"),
        when["day_of_week"].alias("day_of_week"),
        when["hour_of_night"].alias("hour_of_night"),
        _cycle("user_id", 14, 1).alias("vehicle_age_years"),
        passengers.alias("passenger_count"),
        F.lit(75).alias("capacity"),
        _cycle("event_id", 29, 1).alias("driver_experience_yrs"),
        delay.alias("delay_minutes"),
        delayed.alias("is_delayed"),
        complement(delayed).alias("service_reliability_flag"),
        load_share(passengers, F.lit(75)).alias("load_factor"),
    )


def disruptions(spark: SparkSession, folder: str) -> DataFrame:
    """Disruptions from orders, on 24 of the 30 routes."""
    severities = {"F": "Low", "O": "Medium", "P": "High"}
    names = F.create_map(*[F.lit(part) for pair in severities.items() for part in pair])
    return _table(spark, folder, "orders").select(
        padded_key("D", 6, F.col("o_orderkey")).alias("disruption_id"),
        F.concat(F.lit("N"), (F.col("o_custkey") % 24 + 1).cast("string")).alias("service_code"),
        F.concat(F.lit("OP"), (F.col("o_orderkey") % 5).cast("string")).alias("operator"),
        F.col("o_orderpriority").alias("disruption_type"),
        F.col("o_orderdate").alias("start_time"),
        _cycle("o_orderkey", 175, 5).alias("duration_min"),
        names[F.col("o_orderstatus")].alias("severity"),
        _cycle("o_custkey", 19, 1).alias("affected_stops"),
        (F.col("o_orderkey") % 20 < 17).alias("resolved"),
    )


def pings(spark: SparkSession, folder: str) -> DataFrame:
    """Pings from line items; ids repeat and a third of the trips is unknown."""
    signal = {"A": "Good", "N": "Fair", "R": "Poor"}
    names = F.create_map(*[F.lit(part) for pair in signal.items() for part in pair])
    return _table(spark, folder, "lineitem").select(
        F.concat(
            F.lit("L"), F.col("l_orderkey").cast("string"), F.lit("-"),
            F.col("l_linenumber").cast("string"),
        ).alias("location_id"),
        padded_key("T", 7, F.col("l_orderkey")).alias("trip_id"),
        F.col("l_shipdate").alias("timestamp"),
        (51.3 + F.col("l_discount") * 4).alias("latitude"),
        (-0.5 + F.col("l_tax") * 8).alias("longitude"),
        (F.col("l_quantity") * 1.2).alias("speed_kmh"),
        (F.col("l_partkey") * 7 % 360).cast("double").alias("heading_deg"),
        names[F.col("l_returnflag")].alias("signal_quality"),
    )


def raw(spark: SparkSession, folder: str) -> Raw:
    return Raw(trips(spark, folder), disruptions(spark, folder), pings(spark, folder))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Label, score and prediction per trip, from a repeatable pseudo-score with ties."""
    score = (F.col("event_id") * 37 % 1000) / 1000
    return _table(spark, folder, "events").select(
        padded_key("T", 7, F.col("event_id")).alias("trip_id"),
        off_schedule(F.col("value") - 40, WIDE_TOLERANCE).alias("is_delayed"),
        score.alias("score"),
        (score >= 0.5).cast("int").alias("prediction"),
    )
