import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from punctua.operators import headway, joins, prepare, quality
from punctua.operators.headway import add_headway


def moment(minute, second=0, micro=0, day=1):
    return dt.datetime(2024, 10, day, 22, minute, second, micro)


def trips_frame(spark, rows):
    return spark.createDataFrame(rows, "trip_id string, service_code string, scheduled_depart timestamp_ntz")


def plain_headway(trips):
    order = Window.partitionBy("service_code").orderBy("scheduled_depart", "trip_id")
    previous = F.lag("scheduled_depart").over(order)
    gap = (F.unix_timestamp("scheduled_depart") - F.unix_timestamp(previous)) / 60.0
    return trips.withColumn("headway_min", gap)


def rows_of(frame):
    return sorted(map(str, frame.select(*sorted(frame.columns)).collect()))


def test_headway_of_first_tied_and_single_trips(spark):
    trips = trips_frame(spark, [
        ("T2", "N1", moment(10)), ("T1", "N1", moment(10)), ("T3", "N1", moment(25)),
        ("T4", "N2", moment(5)), ("T5", "N1", moment(3, day=4)), ("T6", "N1", None),
    ])
    found = {r.trip_id: r.headway_min for r in add_headway(trips).collect()}
    days = 2 * 1440 + 1440 - 22
    assert found == {"T1": None, "T2": 0.0, "T3": 15.0, "T4": None, "T5": float(days), "T6": None}


def random_trips(spark, seed, copies=0):
    dice = random.Random(seed)
    rows = [
        (f"T{i}", dice.choice(["N1", "N1", "N1", "N2", "N3"]),
         moment(dice.randrange(60), dice.randrange(3), dice.randrange(2) * 500000, dice.randrange(1, 5)))
        for i in range(400)
    ]
    rows += [rows[i % 7] for i in range(copies)]
    return trips_frame(spark, rows).repartition(6)


@pytest.mark.parametrize("copies", [0, 200])
def test_headway_equals_plain_lag(spark, copies):
    trips = random_trips(spark, 3, copies)
    assert rows_of(add_headway(trips)) == rows_of(plain_headway(trips))


def test_headway_of_incomplete_trips(spark):
    trips = trips_frame(spark, [
        (None, "N1", moment(10)), ("T1", "N1", moment(19)), (None, None, moment(5)),
        ("T2", None, moment(9)), (None, "N1", moment(19)), ("T3", "N1", None),
    ])
    gaps = sorted((r.service_code or "", r.trip_id or "", r.headway_min or -1.0)
                  for r in add_headway(trips).collect())
    assert gaps == [("", "", -1.0), ("", "T2", -1.0), ("N1", "", -1.0), ("N1", "", 9.0),
                    ("N1", "T1", -1.0), ("N1", "T3", -1.0)]


def raw_trip(**changes):
    base = dict(
        trip_id="T1", service_code="N1", operator="A", scheduled_depart=moment(0),
        actual_depart=moment(1), scheduled_duration_min=30, actual_duration_min=32,
        weather="Clear", day_of_week="Tuesday", hour_of_night=22, vehicle_age_years=3,
        passenger_count=10, capacity=75, driver_experience_yrs=4, delay_minutes=1.0,
        is_delayed=0, service_reliability_flag=1, load_factor=0.1,
        origin_stop="S1", destination_stop="S2",
    )
    return {**base, **changes}


def raw_trips(spark, *rows):
    from punctua.schemas import TIMETABLES

    order = TIMETABLES.fieldNames()
    return spark.createDataFrame([tuple(row[name] for name in order) for row in rows], TIMETABLES)


def disruptions(spark, *rows):
    return spark.createDataFrame(rows, "service_code string, severity string")


def test_cleaning_drops_only_incomplete_trips(spark):
    trips = raw_trips(
        spark, raw_trip(), raw_trip(trip_id=None), raw_trip(service_code=None),
        raw_trip(delay_minutes=None), raw_trip(is_delayed=None),
        raw_trip(trip_id="T2", weather=None, load_factor=None, delay_minutes=80.0),
    )
    kept = {r.trip_id: r.delay_minutes_clipped for r in prepare.clean_trips(trips).collect()}
    assert kept == {"T1": 1.0, "T2": 60.0}


def test_cleaning_text_columns(spark):
    frame = spark.createDataFrame(
        [("T1", "N1", "3.5", "1", "0.2"), ("T2", "N1", "late", "1", "0.2"), ("T3", "N1", "1", "0", "x")],
        "trip_id string, service_code string, delay_minutes string, is_delayed string, load_factor string",
    )
    kept = {r.trip_id: (r.delay_minutes, r.is_delayed, r.load_factor)
            for r in prepare.clean_trips(frame).collect()}
    assert kept == {"T1": (3.5, 1, 0.2), "T3": (1.0, 0, None)}


def test_enrichment_fills_routes_without_disruptions(spark):
    trips = raw_trips(
        spark, raw_trip(), raw_trip(trip_id="T2", scheduled_depart=moment(9), actual_duration_min=40,
                                    service_reliability_flag=None),
        raw_trip(trip_id="T3", service_code="N2", weather="Hail"),
    )
    known = disruptions(spark, ("N1", "High"), ("N1", "Low"), ("N1", None), ("N9", "High"))
    found = {r.trip_id: r for r in prepare.build_trips(trips, known).collect()}
    assert (found["T1"].disruption_count, found["T1"].high_severity_count) == (3, 1)
    assert (found["T3"].disruption_count, found["T3"].high_severity_count) == (0, 0)
    assert found["T1"].pct_on_time == 0.5 and found["T1"].mean_dur == 36.0
    assert found["T3"].std_dur is None and found["T3"].cv_travel_time is None
    assert found["T3"].weather_code is None and found["T2"].headway_min == 9.0
    assert len(found) == 3


def pings(spark, *trip_ids):
    rows = [(f"L{i}", trip, None, 51.5, 0.1, 10.0, 90.0, "Good") for i, trip in enumerate(trip_ids)]
    from punctua.schemas import LOCATIONS

    return spark.createDataFrame(rows, LOCATIONS)


def test_pings_with_and_without_trip(spark):
    trips = raw_trips(spark, raw_trip(), raw_trip(trip_id="T2", service_code="N2"))
    sample = pings(spark, "T1", "T1", "T2", "T9", None)
    inner = prepare.enrich_pings(sample, trips)
    assert sorted(r.location_id for r in inner.collect()) == ["L0", "L1", "L2"]
    left = {r.location_id: r.service_code for r in prepare.match_pings(sample, trips).collect()}
    assert left == {"L0": "N1", "L1": "N1", "L2": "N2", "L3": None, "L4": None}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skewed_join_equals_plain_join(spark, how):
    left = spark.createDataFrame(
        [("hot", i) for i in range(300)] + [(f"k{i % 40}", i) for i in range(200)] + [(None, 1)] * 3,
        "key string, a int",
    ).repartition(5)
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("none", 3)] + [(f"k{i}", i) for i in range(30)], "key string, b int"
    )
    found = joins.join_skewed(left, right, "key", how, share=0.1, at_least=10)
    assert rows_of(found) == rows_of(left.join(right, "key", how))
    heavy = joins.heavy_keys(left.dropna(), "key", 0.1, 10)
    assert [row.key for row in heavy.collect()] == ["hot"]


@pytest.mark.parametrize("rows", [0, 100])
def test_lookup_join_above_and_below_the_broadcast_bound(spark, rows):
    facts = spark.createDataFrame([(i % 5, i) for i in range(50)] + [(9, 1)] * 2, "k int, a int")
    lookup = spark.createDataFrame([(i, i * 10) for i in range(5)], "k int, b int")
    found = joins.join_lookup(facts, lookup, ["k"], broadcast_rows=rows)
    assert rows_of(found) == rows_of(facts.join(lookup, "k", "left"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) or rows == 0


def test_train_only_share_leaves_out_other_rows(spark):
    trips = raw_trips(
        spark, raw_trip(), raw_trip(trip_id="T2", service_reliability_flag=0),
        raw_trip(trip_id="T3", service_code="N2"),
    )
    found = prepare.route_features(trips, disruptions(spark), F.col("trip_id") == "T2")
    shares = {r.service_code: r.pct_on_time for r in found.collect()}
    assert shares == {"N1": 0.0, "N2": None}


def test_rules_of_tables_that_refer_to_each_other(spark):
    """Brute force over a hot key, repeated, unknown and null keys, and two references to one table."""
    dice = random.Random(5)
    parents = [(i if i % 9 else None, dice.choice([1, None])) for i in range(40)] + [(5, 1), (5, None)]
    children = [(dice.choice([7, 7, 7, None, 3]) if i % 2 else i, dice.choice([7, 50, None, 11]),
                 dice.choice([2, 90])) for i in range(300)]
    tables = [
        quality.Checked(spark.createDataFrame(parents, "id int, v int"), "id", "parents_unique",
                        {"parents_v": F.col("v").isNull()}),
        quality.Checked(spark.createDataFrame(children, "id int, a int, b int").repartition(3), "id",
                        "children_unique", {"children_a": F.col("a") > 10, "children_never": F.col("b") < 0},
                        {"a_known": ("a", 0), "b_known": ("b", 0)}),
    ]
    known = {i for i, _ in parents if i is not None}

    def repeated(keys):
        return sum(n > 1 for n in Counter(k for k in keys if k is not None).values())

    def unknown(values):
        used = [v for v in values if v is not None]
        return len(used), sum(v not in known for v in used)

    wanted = {
        "parents_unique": (sum(i is not None for i, _ in parents), repeated(i for i, _ in parents)),
        "parents_v": (len(parents), sum(v is None for _, v in parents)),
        "children_unique": (sum(c[0] is not None for c in children), repeated(c[0] for c in children)),
        "children_a": (300, sum(c[1] is not None and c[1] > 10 for c in children)),
        "children_never": (300, 0),
        "a_known": unknown(c[1] for c in children), "b_known": unknown(c[2] for c in children),
    }
    report = quality.check_tables(tables)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert {r.rule: (r.checked, r.violations) for r in report.collect()} == wanted
    empty = [quality.Checked(t.frame.limit(0), t.key, t.unique, t.rules, t.uses) for t in tables]
    found = quality.check_tables(empty).collect()
    assert {r.rule for r in found} == set(wanted) and {(r.checked, r.violations) for r in found} == {(0, 0)}
