"""Rankings, threshold reports and KPI tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua import config
from punctua.functions.columns import target_state
from punctua.operators.headway import slot_gaps, used_seconds
from punctua.operators.prepare import route_measures

ROUTE_DELAYS = """
    SELECT service_code,
           round(avg(delay_minutes), 2)    AS avg_delay_min,
           round(stddev(delay_minutes), 2) AS std_delay_min,
           round(min(delay_minutes), 2)    AS min_delay_min,
           round(max(delay_minutes), 2)    AS max_delay_min,
           count(*)                        AS trips,
           round(avg(is_delayed) * 100, 1) AS pct_delayed
    FROM {rows}
    GROUP BY service_code
    ORDER BY avg_delay_min DESC, service_code
    LIMIT :routes
"""

DISRUPTION_BREAKDOWN = """
    SELECT disruption_type,
           count(*)                    AS count,
           round(avg(duration_min), 1) AS avg_duration_min,
           count_if(severity = 'High') AS high_count
    FROM {rows}
    GROUP BY disruption_type
    ORDER BY count DESC, disruption_type
"""

COUNT_BY_LABEL = "SELECT count(*) AS total FROM {rows} WHERE is_delayed = :flag"

OPERATOR_RELIABILITY = """
    SELECT operator,
           round(1 - avg(is_delayed), 4) AS service_reliability,
           count(*)                      AS total_trips
    FROM {rows}
    GROUP BY operator
    ORDER BY service_reliability DESC, operator
"""

ROUTES_BELOW_TARGET = """
    SELECT service_code,
           round(avg(CASE WHEN is_delayed = 0 THEN 1D ELSE 0D END) * 100, 2) AS pct_on_time,
           count(*) AS trips
    FROM {rows}
    GROUP BY service_code
    HAVING pct_on_time < :percent
    ORDER BY pct_on_time, service_code
"""

HOTSPOTS = """
    SELECT service_code, disruption_type, count(*) AS n
    FROM {rows}
    WHERE severity = 'High'
    GROUP BY service_code, disruption_type
    ORDER BY n DESC, service_code, disruption_type
    LIMIT :places
"""

VARIABLE_ROUTES = """
    SELECT service_code, round(avg(cv_travel_time), 4) AS mean_cv
    FROM {rows}
    GROUP BY service_code
    HAVING mean_cv > :limit
    ORDER BY mean_cv DESC, service_code
"""


def _query(frame: DataFrame, text: str, **parameters: object) -> DataFrame:
    """Runs a statement over ``{rows}``; no view of the caller is touched."""
    return frame.sparkSession.sql(text, args=parameters, rows=frame)


def route_delays(trips: DataFrame, routes: int = 10) -> DataFrame:
    """Routes with the highest mean delay."""
    return _query(trips, ROUTE_DELAYS, routes=routes)


def disruption_breakdown(disruptions: DataFrame) -> DataFrame:
    """Count, mean duration and high-severity count per disruption type."""
    return _query(disruptions, DISRUPTION_BREAKDOWN)


def count_by_label(trips: DataFrame, flag: int = 1) -> DataFrame:
    """Number of trips with the given label."""
    return _query(trips, COUNT_BY_LABEL, flag=flag)


def operator_reliability(trips: DataFrame) -> DataFrame:
    """On-time share per operator, best first."""
    return _query(trips, OPERATOR_RELIABILITY)


def routes_below_target(
    trips: DataFrame, percent: float = config.Targets().on_time_percent
) -> DataFrame:
    """Routes whose on-time percentage misses the target, worst first."""
    return _query(trips, ROUTES_BELOW_TARGET, percent=percent)


def disruption_hotspots(disruptions: DataFrame, places: int = 20) -> DataFrame:
    """Routes and types with the most high-severity disruptions."""
    return _query(disruptions, HOTSPOTS, places=places)


def variable_routes(trips: DataFrame, limit: float = config.Targets.travel_time_cv) -> DataFrame:
    """Routes whose travel-time variation exceeds the limit, highest first."""
    return _query(trips, VARIABLE_ROUTES, limit=limit)


def operator_profile(
    trips: DataFrame, percent: float = config.Targets().on_time_percent
) -> DataFrame:
    """On-time percentage, mean delay and trips per operator with its target state, worst first."""
    return (
        trips.groupBy("operator")
        .agg(
            ((1 - F.avg("is_delayed")) * 100).alias("pct_on_time"),
            F.avg("delay_minutes").alias("avg_delay"),
            F.count("trip_id").alias("trips"),
        )
        .withColumn("state", target_state(F.col("pct_on_time"), percent))
        .orderBy("pct_on_time", "operator")
    )


def kpi_row(
    trips: DataFrame, disruptions: DataFrame, percent: float = config.Targets().on_time_percent
) -> DataFrame:
    """One row: trips, on-time percentage and its gap to the target, mean delay, disruptions."""
    from_trips = trips.agg(
        F.count(F.lit(1)).alias("total_trips"),
        ((1 - F.avg("is_delayed")) * 100).alias("pct_on_time"),
        F.avg("delay_minutes").alias("avg_delay"),
    )
    from_disruptions = disruptions.agg(F.count(F.lit(1)).alias("disruptions"))
    parts = from_trips.unionByName(from_disruptions, allowMissingColumns=True)
    both = parts.agg(*[F.max(name).alias(name) for name in parts.columns])
    return both.withColumn("gap_to_target", F.col("pct_on_time") - F.lit(percent))


def overall_variability(trips: DataFrame) -> DataFrame:
    """One row: coefficient of variation of the travel time and on-time percentage."""
    time = F.col("actual_duration_min")
    return trips.agg(
        F.try_divide(F.stddev(time), F.mean(time)).alias("cv_travel_time"),
        (F.avg(F.when(F.col("is_delayed") == 0, 1.0).otherwise(0.0)) * 100).alias("pct_on_time"),
    )


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows."""
    counts = [
        frame.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, frame in frames.items()
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


def best_by(results: DataFrame, name: str = "model", score: str = "f1") -> DataFrame:
    """The row name with the highest score; the first name in order wins a tie."""
    best_first = F.struct(-F.col(score), F.col(name))
    return results.where(F.col(score).isNotNull()).agg(
        F.min_by(name, best_first).alias(name), F.max(score).alias(score)
    )


def headway_regularity(
    trips: DataFrame,
    limit: float = config.Targets.headway_ratio,
) -> DataFrame:
    """Per route: deviation of the actual headway over the mean scheduled headway.

    Departures of one second after the first have headway 0 and enter by their number, so
    the statistics need one row per used second and no per-trip headway.
    """

    def moments(depart: str) -> DataFrame:
        gap = F.coalesce("gap_min", F.lit(0.0))
        return slot_gaps(used_seconds(trips, depart)).groupBy("service_code").agg(
            (F.sum("rows") - 1).alias("n"), F.sum(gap).alias("total"),
            F.sum(gap * gap).alias("squares"),
        )

    actual = moments("actual_depart").select(
        "service_code",
        F.when(
            F.col("n") > 1,
            F.sqrt(F.greatest(F.lit(0.0), (
                F.col("squares") - F.col("total") * F.col("total") / F.col("n")
            ) / (F.col("n") - 1))),
        ).alias("headway_sd"),
    )
    planned = moments("scheduled_depart").select(
        "service_code", F.try_divide("total", "n").alias("scheduled_headway")
    )
    ratio = F.try_divide("headway_sd", "scheduled_headway")
    return (
        planned.join(actual, "service_code", "left")
        .withColumn("headway_ratio", ratio)
        .withColumn("irregular", F.col("headway_ratio") > F.lit(limit))
    )


def completion_rate(trips: DataFrame) -> DataFrame:
    """Per route: trips with an actual departure over all trips."""
    return trips.groupBy("service_code").agg(completed_share().alias("completion_rate"))


def completed_share() -> Column:
    return F.count("actual_depart") / F.count(F.lit(1))


def kpi_compliance(trips: DataFrame, targets: config.Targets = config.Targets()) -> DataFrame:
    """One row per route and KPI: value, target and whether the route meets it."""
    ratios = headway_regularity(trips).select("service_code", "headway_ratio")
    known = trips.where(F.col("service_code").isNotNull())
    wide = route_measures(known, completed_share().alias("completion_rate")).join(
        ratios, "service_code", "left"
    )

    def entry(kpi: str, column: str, target: float, at_least: bool):
        value = F.col(column)
        passed = value >= F.lit(target) if at_least else value <= F.lit(target)
        return F.struct(
            F.lit(kpi).alias("kpi"), value.alias("value"), F.lit(target).alias("target"),
            passed.alias("passed"),
        )

    entries = F.array(
        entry("service_reliability", "pct_on_time", targets.on_time_share, True),
        entry("headway_regularity", "headway_ratio", targets.headway_ratio, False),
        entry("travel_time_cv", "cv_travel_time", targets.travel_time_cv, False),
        entry("completion_rate", "completion_rate", targets.completion_rate, True),
    )
    return wide.select("service_code", F.explode(entries).alias("row")).select(
        "service_code", "row.*"
    )
