"""Time the headline work at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Single queries run over the given tables; the ``run_`` entries are whole stages over the
tables: ingestion, the joins of raw pings with raw trips, and the three full-size model fits.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua.ml import features, models
from punctua.operators import prepare
from punctua.operators.settle import fresh_path
from punctua.plans.ingest import Stored, ingest
from punctua.plans.modelling import arranged
from workload import adapters
from workload import queries as W

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "trips_cleaned", "headway_minutes", "route_features", "route_delay_top10",
    "disruption_breakdown", "operator_reliability", "routes_below_threshold",
    "disruption_hotspots", "routes_high_cv", "operator_profile", "kpi_row", "hour_profile",
    "describe_delay", "delay_shape", "correlation_long", "delay_histogram", "delay_boxplot",
    "route_scatter", "route_hour_pivot", "quality_report", "headway_regularity",
    "kpi_compliance", "locations_enriched", "stratified_split", "binary_metrics", "roc_points",
    "class_report",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.driver.memory", "20g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(work: Callable[[], object]) -> float:
    started = time.perf_counter()
    work()
    return round(time.perf_counter() - started, 3)


def fit_times(spark: SparkSession) -> dict[str, float]:
    """Seconds to fit each full-size model on 80 % of the trips."""
    trips = features.training_set(W.model_trips(spark, FOLDER), keep=["trip_id"])
    train = features.stratified_split(trips).where(~F.col("is_test"))
    train = features.add_class_weights(features.spread_for_fitting(train))
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    rows = train.count()
    zoo = models.model_zoo(rows, models.Sizes(tree_memory_mb=2048))
    # The first fit of a session loads its classes; that is no part of any model's time.
    models.model_zoo(rows, models.Sizes(lr_iterations=2))["Logistic Regression"].fit(train)
    names = {"Logistic Regression": "fit_logistic", "Random Forest": "fit_forest",
             "Gradient Boosting": "fit_boosting"}
    times = {
        names[name]: timed(lambda: pipeline.fit(arranged(name, train, rows)))
        for name, pipeline in zoo.items()
    }
    train.unpersist()
    return times


def main() -> None:
    spark = session()
    run(adapters.trips(spark, FOLDER))
    times = {}
    stored = Stored(fresh_path(spark, "bench"))
    times["run_ingest"] = timed(lambda: ingest(adapters.raw(spark, FOLDER), stored))
    pings, trips = adapters.pings(spark, FOLDER), adapters.trips(spark, FOLDER)
    times["run_match_pings"] = timed(lambda: run(prepare.match_pings(pings, trips)))
    times["run_enrich_pings"] = timed(lambda: run(prepare.enrich_pings(pings, trips)))
    W.stored_tables(spark, FOLDER)
    for name in HEADLINE:
        times[name] = timed(lambda: run(W.QUERIES[name](spark, FOLDER)))
        print(name, times[name], file=sys.stderr)
    times.update(fit_times(spark))
    print(json.dumps({
        "metric": "total wall clock of ingestion, queries and full-size model fits",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
