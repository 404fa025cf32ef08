"""Gap to the previous departure of the same route."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctua.operators.buckets import bucket_count, range_keys, read_buckets, write_buckets
from punctua.operators.settle import fresh_path, gather, store

SECONDS_PER_DAY = 86_400


def used_seconds(trips: DataFrame, depart: str = "scheduled_depart") -> DataFrame:
    """Stored ``(service_code, second, rows)``: departures per route and second."""
    known = trips.where(F.col(depart).isNotNull() & F.col("service_code").isNotNull())
    seconds = known.groupBy("service_code", F.unix_timestamp(depart).alias("second"))
    return store(seconds.agg(F.count(F.lit(1)).alias("rows")))


def slot_gaps(slots: DataFrame) -> DataFrame:
    """Add ``gap_min``, the minutes since the previous used second of the route.

    Windows run within a route and day (at most 86,400 rows) and over the last seconds of the
    route's days, so a route that holds most of the trips still gives bounded tasks.
    """
    dated = slots.withColumn("_day", F.floor(F.col("second") / SECONDS_PER_DAY))
    days = (
        dated.groupBy("service_code", "_day").agg(F.max("second").alias("_last"))
        .select("service_code", "_day", F.lag("_last").over(
            Window.partitionBy("service_code").orderBy("_day")).alias("_last_before"))
    )
    in_day = Window.partitionBy("service_code", "_day").orderBy("second")
    within = dated.withColumn("_before", F.lag("second").over(in_day))
    previous = F.coalesce("_before", "_last_before")
    return (
        within.join(days, ["service_code", "_day"])
        .withColumn("gap_min", (F.col("second") - previous) / F.lit(60.0))
        .drop("_day", "_before", "_last_before")
    )


def add_headway(
    trips: DataFrame, depart: str = "scheduled_depart", name: str = "headway_min"
) -> DataFrame:
    """Minutes since the previous departure of the route, ordered by departure and trip_id.

    Gaps are in whole seconds. The first departure of a route, and a trip without route or
    departure, has none; a trip without trip_id comes before the others of its instant. There
    is one plan for every size: one shuffle deals the trips into ordered ranges, stored in a bucket
    each, so that looking back within a range shuffles nothing. Only the first route of a range
    can have departures in the ranges before: one row for each range carries its last one over.
    Neither a route nor copies of a trip are held by one task: the input position is the last part
    of the order. The partitions of the result are the ranges.
    """
    spark = trips.sparkSession
    parts = bucket_count(spark)
    order = ["service_code", depart, "trip_id", "_at"]
    keys = F.array(*map(F.lit, range_keys(spark, parts)))
    dealt = (
        trips.withColumn("_at", F.monotonically_increasing_id())
        .repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
        .withColumn("_range", F.element_at(keys, F.col("_part") + 1))
    )
    path = fresh_path(spark, "ranges")
    write_buckets(dealt, path, "_range", parts, order)
    ranged = read_buckets(spark, path, dealt.schema, "_range", parts)
    # The last route of each range and its last departure; nulls come before all others.
    last = F.max(F.struct(F.col("service_code").alias("route"), F.col(depart).alias("time")))
    before = F.lag("_last").over(Window.orderBy("_part"))
    before = gather(  # one row for each range
        ranged.groupBy("_part").agg(last.alias("_last")).withColumn("_before", before)
        .select("_part", F.col("_before.route").alias("_route"),
                F.unix_timestamp("_before.time").alias("_second")))
    inside = Window.partitionBy("_range", "service_code").orderBy(depart, "trip_id", "_at")
    carried = F.when(F.col("_route") == F.col("service_code"), F.col("_second"))
    previous = F.coalesce(F.unix_timestamp(F.lag(depart).over(inside)), carried)
    gap = (F.unix_timestamp(depart) - previous) / F.lit(60.0)
    met = ranged.join(F.broadcast(before), "_part", "left")
    return met.withColumn(name, F.when(F.col("service_code").isNotNull(), gap)).select(
        *trips.columns, name
    )
