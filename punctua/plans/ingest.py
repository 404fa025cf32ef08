"""Raw tables to stored tables."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from punctua import schemas
from punctua.operators.buckets import (
    bucket_count, frequent_keys, read_buckets, spread_by_key, write_buckets,
)
from punctua.operators.prepare import build_trips, clean_trips, enrich_stored, trip_keys
from punctua.operators.settle import intermediates, side_by_side, store
from punctua.sources.tables import (
    current_version, publish, read_csv, read_table, write_table,
)


# The tables that ingestion makes; none is made from another.
TABLES = ("trips", "disruptions", "pings")


@dataclass(frozen=True)
class Raw:
    """The three raw tables."""

    trips: DataFrame
    disruptions: DataFrame
    pings: DataFrame


@dataclass(frozen=True)
class Stored:
    """Paths of the stored tables below one folder."""

    folder: str

    @property
    def trips(self) -> str:
        return f"{self.folder}/timetables_clean"

    @property
    def disruptions(self) -> str:
        return f"{self.folder}/disruptions_clean"

    @property
    def trip_keys(self) -> str:
        """What pings take from their trip, by trip."""
        return f"{self.folder}/trip_keys"

    @property
    def pings(self) -> str:
        return f"{self.folder}/locations_enriched"


def raw_csv(spark: SparkSession, folder: str) -> Raw:
    """Raw tables from ``timetables.csv``, ``disruptions.csv`` and ``locations.csv``.

    They are copied to Parquet first: later steps read them several times, mostly a few
    columns, and text can only be read whole.
    """
    return Raw(
        store(read_csv(spark, f"{folder}/timetables.csv", schemas.TIMETABLES)),
        store(read_csv(spark, f"{folder}/disruptions.csv", schemas.DISRUPTIONS)),
        store(read_csv(spark, f"{folder}/locations.csv", schemas.LOCATIONS)),
    )


def ingest(raw: Raw, stored: Stored, train_only: Column | None = None,
           tables: Collection[str] = TABLES) -> None:
    """Clean and enrich the raw tables and replace the stored ones, or those of them in ``tables``.

    Trips and disruptions are clustered by what reports filter on, so that such reads skip files;
    trips keep the ranges of the headway step, their only shuffle. Pings are kept by a hash of
    their trip, as are the trips' keys: raw pings are shuffled once to meet the keys and stay where
    they are, and later joins of the stored tables shuffle nothing.
    The three tables are made side by side, so that short stages of one leave no executor idle.
    ``train_only`` picks the trips whose labels the route features may see. Pings come with the keys
    of all cleaned trips, whether or not the trips are stored too.
    """
    if unknown := set(tables) - set(TABLES):
        raise ValueError(f"no such tables: {sorted(unknown)}")
    spark = raw.trips.sparkSession
    with intermediates(spark):
        _ingest(spark, raw, stored, train_only, tables)


def _ingest(spark: SparkSession, raw: Raw, stored: Stored, train_only: Column | None,
            tables: Collection[str]) -> None:
    count = bucket_count(spark)

    def write_trips() -> None:
        trips = build_trips(raw.trips, raw.disruptions, train_only)
        write_table(trips, stored.trips, cluster_by=["service_code", "scheduled_depart"],
                    in_ranges=True)

    def write_disruptions() -> None:
        write_table(raw.disruptions, stored.disruptions, cluster_by=["service_code", "start_time"])

    def write_pings() -> None:
        # The keys of the cleaned trips need no headway, so they do not wait for the stored trips.
        keys = trip_keys(clean_trips(raw.trips))
        publish(spark, stored.trip_keys, lambda path: write_buckets(
            spread_by_key(keys, "trip_id", count), path, "trip_id", count))
        heavy = frequent_keys(raw.pings, "trip_id")
        enriched = enrich_stored(raw.pings, stored_keys(spark, stored, count), heavy)
        publish(spark, stored.pings, lambda path: write_buckets(
            enriched, path, "trip_id", count, ["trip_id", "timestamp"]))

    works = dict(zip(TABLES, (write_trips, write_disruptions, write_pings)))
    side_by_side(spark, [works[name] for name in TABLES if name in tables])


def stored_keys(spark: SparkSession, stored: Stored, buckets: int | None = None) -> DataFrame:
    """The stored trips' keys, known to the planner as clustered by trip."""
    return _by_trip(spark, stored.trip_keys, buckets)


def stored_pings(spark: SparkSession, stored: Stored, buckets: int | None = None) -> DataFrame:
    """The stored pings, known to the planner as clustered by trip."""
    return _by_trip(spark, stored.pings, buckets)


def _by_trip(spark: SparkSession, path: str, buckets: int | None) -> DataFrame:
    """``buckets`` is the number that the table was written with, by default that of a shuffle."""
    version = current_version(spark, path)
    schema = spark.read.parquet(version).schema
    return read_buckets(spark, version, schema, "trip_id", buckets or bucket_count(spark))
