"""Declared schemas of the three raw tables; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _INT, _DOUBLE = T.StringType(), T.IntegerType(), T.DoubleType()
_TIME, _FLAG = T.TimestampNTZType(), T.BooleanType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TIMETABLES = _schema(
    trip_id=_STRING, service_code=_STRING, operator=_STRING,
    origin_stop=_STRING, destination_stop=_STRING,
    scheduled_depart=_TIME, actual_depart=_TIME,
    scheduled_duration_min=_INT, actual_duration_min=_INT,
    weather=_STRING, day_of_week=_STRING, hour_of_night=_INT,
    vehicle_age_years=_INT, passenger_count=_INT, capacity=_INT,
    driver_experience_yrs=_INT, delay_minutes=_DOUBLE, is_delayed=_INT,
    service_reliability_flag=_INT, load_factor=_DOUBLE,
)

DISRUPTIONS = _schema(
    disruption_id=_STRING, service_code=_STRING, operator=_STRING,
    disruption_type=_STRING, start_time=_TIME, duration_min=_INT,
    severity=_STRING, affected_stops=_INT, resolved=_FLAG,
)

LOCATIONS = _schema(
    location_id=_STRING, trip_id=_STRING, timestamp=_TIME,
    latitude=_DOUBLE, longitude=_DOUBLE, speed_kmh=_DOUBLE,
    heading_deg=_DOUBLE, signal_quality=_STRING,
)
