import datetime as dt
from pathlib import Path
from urllib.parse import urlparse

import pytest

from punctua import config, schemas
from punctua.operators import quality
from punctua.plans import dashboard
from punctua.plans.ingest import Stored, ingest, raw_csv
from punctua.sources import tables as io
from workload import queries as workload

TRIPS = """trip_id,service_code,operator,origin_stop,destination_stop,scheduled_depart,actual_depart,\
scheduled_duration_min,actual_duration_min,weather,day_of_week,hour_of_night,vehicle_age_years,\
passenger_count,capacity,driver_experience_yrs,delay_minutes,is_delayed,service_reliability_flag,load_factor
T0000000,N1,A,STOP_0001,STOP_0002,2024-10-01 22:05:00,2024-10-01 22:06:30.250000,30,33,Clear,Tuesday,22,3,30,75,5,1.504,0,1,0.4
T0000001,N1,B,STOP_0001,STOP_0002,2024-10-01 22:25:00,2024-10-01 22:30:00,30,36,Snow,Tuesday,22,3,30,75,5,5.0,1,0,0.4
T0000002,N2,B,STOP_0003,STOP_0002,2024-10-02 01:00:00,,40,,Hail,Wednesday,1,3,,75,5,,1,0,
"""
DISRUPTIONS = """disruption_id,service_code,operator,disruption_type,start_time,duration_min,severity,affected_stops,resolved
D000000,N1,A,Accident,2024-10-01 23:00:00,45,High,4,True
D000001,N1,A,Flooding,2024-10-03 23:00:00,20,Low,2,False
"""
LOCATIONS = """location_id,trip_id,timestamp,latitude,longitude,speed_kmh,heading_deg,signal_quality
L0000000,T0000000,2024-10-01 22:10:00,51.5,-0.1,30.5,90.0,Good
L0000001,T0000002,2024-10-01 22:10:00,51.5,-0.1,30.5,90.0,Poor
L0000002,T0000001,2024-10-01 22:10:00,not-a-number,-0.1,30.5,90.0,Fair
"""


def test_csv_to_stored_tables(spark, tmp_path):
    for name, text in (("timetables", TRIPS), ("disruptions", DISRUPTIONS), ("locations", LOCATIONS)):
        (tmp_path / f"{name}.csv").write_text(text)
    stored = Stored(str(tmp_path / "stored"))
    for _ in range(2):
        ingest(raw_csv(spark, str(tmp_path)), stored)
    trips = io.read_table(spark, stored.trips)
    assert trips.columns == config.TRIP_COLUMNS
    found = {r.trip_id: r for r in trips.collect()}
    assert set(found) == {"T0000000", "T0000001"}
    assert found["T0000000"].actual_depart == dt.datetime(2024, 10, 1, 22, 6, 30, 250000)
    assert found["T0000001"].headway_min == 20.0 and found["T0000001"].weather_code == 3
    assert found["T0000000"].disruption_count == 2 and found["T0000000"].pct_on_time == 0.5
    disruptions = io.read_table(spark, stored.disruptions).collect()
    assert [r.resolved for r in sorted(disruptions)] == [True, False]
    pings = io.read_table(spark, stored.pings)
    assert pings.columns == config.PING_COLUMNS
    assert {r.location_id: r.latitude for r in pings.collect()} == {"L0000000": 51.5, "L0000002": None}


def test_projected_scan_reads_only_its_columns(spark, tmp_path):
    path = str(tmp_path / "table")
    io.write_table(spark.createDataFrame([(1, 2.0, "x"), (2, None, "y")], "a int, b double, c string"), path)
    table = io.read_table(spark, path, ["a", "b"], drop_null=True)
    assert [tuple(r) for r in table.collect()] == [(1, 2.0)]
    assert "ReadSchema: struct<a:int,b:double>" in table._jdf.queryExecution().executedPlan().toString()


def test_partitioned_table_and_csv(spark, tmp_path):
    frame = spark.createDataFrame([(1, "x"), (2, "y")], "a int, c string")
    io.write_table(frame, str(tmp_path / "parts"), ["c"])
    assert io.read_table(spark, str(tmp_path / "parts")).where("c = 'y'").first().a == 2
    io.write_csv(frame, str(tmp_path / "csv"))
    assert io.read_csv(spark, str(tmp_path / "csv"), frame.schema).count() == 2


def test_clustered_table_pushes_filters(spark, tmp_path):
    frame = spark.createDataFrame([(i % 5, i) for i in range(100)], "a int, b int")
    io.write_table(frame, str(tmp_path / "t"), cluster_by=["a", "b"])
    one = io.read_table(spark, str(tmp_path / "t"), drop_null=True).where("a = 3")
    assert one.count() == 20
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(a,3)" in plan and "IsNotNull(b)" in plan


def test_dashboard_choice(spark):
    rows = [(f"N{i}", "A", i % 24, float(i), i % 2, f"T{i}") for i in range(1, 40)]
    trips = spark.createDataFrame(
        rows, "service_code string, operator string, hour_of_night int, delay_minutes double,"
        " is_delayed int, trip_id string")
    choice = dashboard.default_choice(trips)
    assert choice.routes == ["N1", "N10", "N11", "N12", "N13"]
    assert dashboard.operator_overview(trips, choice).first().trips == 5
    assert dashboard.delay_distribution(trips, choice).count() == dashboard.BINS
    night = dashboard.Choice(operators=["A"], hours=dashboard.DEFAULT_HOURS)
    assert sorted(r.service_code for r in dashboard.delay_heatmap(trips, night).collect())[:2] == ["N1", "N2"]


def test_broken_lines_are_kept_with_their_reason(spark, tmp_path):
    lines = LOCATIONS.splitlines()
    lines += ["L0000003,T0000001,at night,51.5,-0.1,30.5,90.0,Fair", "L0000004,T0000001",
              lines[1] + ",more", 'L0000005,"T,1",2024-10-01 22:10:00,,,,,']
    (tmp_path / "locations.csv").write_text("\n".join(lines) + "\n")
    found = io.read_csv_checked(spark, str(tmp_path / "locations.csv"), schemas.LOCATIONS)
    assert sorted(r.location_id for r in found.rows.collect()) == ["L0000000", "L0000001", "L0000005"]
    rejects = {r.line.split(",")[0] + r.line[-5:]: r.reason for r in found.rejects.collect()}
    assert rejects == {"L0000002,Fair": "latitude", "L0000003,Fair": "timestamp",
                       "L0000004 0001"[:8] + "00001": "columns", "L0000000,more": "columns"}
    report = quality.quality_report(
        spark.createDataFrame([], "trip_id string, service_code string, operator string, "
                              "is_delayed int, delay_minutes_clipped double"),
        spark.createDataFrame([], "disruption_id string, service_code string, severity string"),
        spark.createDataFrame([("L1", "T1"), ("L1", None), (None, "T2")], "location_id string, trip_id string"),
        {"pings": (found.rows, found.rejects)})
    rows = {r.rule: (r.checked, r.violations) for r in report.collect()}
    assert rows["pings_rejected_columns"] == (7, 2) and rows["pings_rejected_latitude"] == (7, 1)
    assert rows["pings_location_id_unique"] == (2, 1) and rows["pings_trip_id_known"] == (2, 2)


def raw_files(folder):
    for name, text in (("timetables", TRIPS), ("disruptions", DISRUPTIONS), ("locations", LOCATIONS)):
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_some_tables_are_stored_as_with_all(spark, tmp_path):
    raw = raw_csv(spark, raw_files(tmp_path))
    whole, part = Stored(str(tmp_path / "whole")), Stored(str(tmp_path / "part"))
    ingest(raw, whole)
    ingest(raw, part, tables=["trips"])
    assert {p.name for p in (tmp_path / "part").iterdir()} == {"timetables_clean"}
    ingest(raw, part, tables=["pings", "disruptions"])
    for one, other in ((whole.trips, part.trips), (whole.disruptions, part.disruptions),
                       (whole.pings, part.pings), (whole.trip_keys, part.trip_keys)):
        rows = [sorted(map(str, io.read_table(spark, path).collect())) for path in (one, other)]
        assert rows[0] == rows[1] != []
    with pytest.raises(ValueError, match="no such tables"):
        ingest(raw, part, tables=["trip"])


def test_queries_of_trips_store_no_pings(spark, tmp_path, monkeypatch):
    folder = raw_files(tmp_path)
    monkeypatch.setattr(workload, "_state", lambda spark, folder: ())
    monkeypatch.setattr(workload.adapters, "raw", raw_csv)
    assert workload.stored_trips(spark, folder).count() == 2
    stored, made = workload._stored[spark.sparkContext.applicationId, folder, ()]
    place = Path(urlparse(stored.folder).path)
    assert made == {"trips"} and {p.name for p in place.iterdir()} == {"timetables_clean"}
    assert workload.stored_tables(spark, folder) == stored
    assert made == {"trips", "disruptions", "pings"} and len(list(place.iterdir())) == 4
