import datetime as dt
import statistics

import pytest

from punctua import config
from punctua.operators import kpi, quality
from punctua.sources.tables import register_views, run_sql


def delays(spark):
    rows = [(f"N{route}", float(route * 3 + i), int(i > 1)) for route in (1, 2, 3) for i in range(4)]
    return spark.createDataFrame(rows, "service_code string, delay_minutes double, is_delayed int")


def test_route_delays_keep_the_worst(spark):
    found = kpi.route_delays(delays(spark), 2).collect()
    assert [(r.service_code, r.avg_delay_min, r.pct_delayed) for r in found] == [
        ("N3", 10.5, 50.0), ("N2", 7.5, 50.0),
    ]


def test_tied_hotspots_are_ranked_by_name(spark):
    rows = [("N2", "Flood", "High"), ("N1", "Flood", "High"), ("N1", "Flood", "Low"), ("N3", "Flood", "High")]
    frame = spark.createDataFrame(rows, "service_code string, disruption_type string, severity string")
    assert [r.service_code for r in kpi.disruption_hotspots(frame, 2).collect()] == ["N1", "N2"]


def test_bound_values_are_not_sql(spark):
    register_views({"notes": spark.createDataFrame([("x' OR '1'='1",), ("y",)], "text string")})
    found = run_sql(spark, "SELECT * FROM notes WHERE text = :wanted", {"wanted": "x' OR '1'='1"})
    assert found.count() == 1


def test_routes_below_target_use_the_given_percent(spark):
    assert kpi.routes_below_target(delays(spark), 50.0).count() == 0
    assert kpi.routes_below_target(delays(spark), 50.1).count() == 3


def test_kpi_row_without_disruptions(spark):
    row = kpi.kpi_row(delays(spark), spark.createDataFrame([], "disruption_id string")).first()
    assert (row.total_trips, row.pct_on_time, row.gap_to_target, row.disruptions) == (12, 50.0, -35.0, 0)


def test_best_by_breaks_ties_by_name(spark):
    frame = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.1), ("d", None)], "model string, f1 double")
    assert tuple(kpi.best_by(frame).first()) == ("a", 0.5)


def trips(spark, times):
    rows = [
        (f"T{i}", route, dt.datetime(2024, 10, 1, 22, planned),
         None if actual is None else dt.datetime(2024, 10, 1, 22, actual), 30, 1)
        for i, (route, planned, actual) in enumerate(times)
    ]
    return spark.createDataFrame(
        rows, "trip_id string, service_code string, scheduled_depart timestamp_ntz,"
        " actual_depart timestamp_ntz, actual_duration_min int, service_reliability_flag int",
    )


TIMES = [("N1", 0, 1), ("N1", 10, 14), ("N1", 20, 20), ("N1", 30, 20), ("N2", 5, 6), ("N3", 1, None)]


def test_headway_regularity(spark):
    found = {r.service_code: r
             for r in kpi.headway_regularity(trips(spark, TIMES)).collect()}
    assert found["N1"].scheduled_headway == 10.0
    assert found["N1"].headway_sd == pytest.approx(statistics.stdev([13, 6, 0]))
    assert found["N1"].irregular
    assert found["N2"].headway_ratio is None and found["N3"].headway_sd is None


def test_compliance_lists_every_route_and_kpi(spark):
    found = {(r.service_code, r.kpi): r for r in kpi.kpi_compliance(trips(spark, TIMES)).collect()}
    assert len(found) == 12
    assert found["N3", "completion_rate"].value == 0.0 and not found["N3", "completion_rate"].passed
    assert found["N1", "travel_time_cv"].passed and found["N2", "travel_time_cv"].value is None
    assert found["N1", "service_reliability"].target == config.Targets().on_time_share


def test_quality_rules(spark):
    trip_rows = [("T1", "N1", "A", 1, 5.0), ("T1", "N1", None, 0, 99.0), ("T2", "N2", "A", None, -30.0),
                 (None, "N1", "A", 1, None), (None, "N1", "A", 1, 60.0)]
    trips = spark.createDataFrame(
        trip_rows, "trip_id string, service_code string, operator string, is_delayed int,"
        " delay_minutes_clipped double")
    disruptions = spark.createDataFrame(
        [("D1", "N1", "High"), ("D2", None, "Critical"), ("D3", "N1", None)],
        "disruption_id string, service_code string, severity string")
    pings = spark.createDataFrame(
        [("L1", "T1"), ("L2", "T9"), ("L2", "T9"), ("L2", None)], "location_id string, trip_id string")
    found = {r.rule: (r.checked, r.violations)
             for r in quality.quality_report(trips, disruptions, pings).collect()}
    assert found == {
        "trips_service_code_not_null": (5, 0), "trips_operator_not_null": (5, 1),
        "trips_is_delayed_not_null": (5, 1), "trips_delay_minutes_clipped_range": (5, 1),
        "disruptions_service_code_not_null": (3, 1), "disruptions_severity_domain": (3, 1),
        "trips_trip_id_unique": (3, 1), "disruptions_disruption_id_unique": (3, 0),
        "pings_location_id_unique": (4, 1), "pings_trip_id_known": (3, 2),
    }
