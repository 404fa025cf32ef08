"""Targets, column lists and code tables shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass

SEED = 42
TEST_SHARE = 0.2
FOLDS = 5
LABEL = "is_delayed"


@dataclass(frozen=True)
class Targets:
    """KPI targets; shares are fractions, the tolerance is in minutes."""

    on_time_share: float = 0.85
    headway_ratio: float = 0.20
    travel_time_cv: float = 0.15
    completion_rate: float = 0.95
    tolerance_minutes: float = 2.0

    @property
    def on_time_percent(self) -> float:
        return self.on_time_share * 100


# Clamps of the stored and of the plotted delay, in minutes.
STORED_DELAY_BOUNDS = (-30.0, 60.0)
PLOTTED_DELAY_BOUNDS = (-15.0, 30.0)

# Weather names and their codes.
WEATHER_CODES = {"Clear": 0, "Rain": 1, "Fog": 2, "Snow": 3, "Windy": 4}
WEATHER_LABELS = list(WEATHER_CODES)

# Class names of the label, by code.
CLASS_NAMES = ["On-Time", "Delayed"]

# Allowed disruption severities.
SEVERITIES = ["Low", "Medium", "High"]

# Columns a trip must have to be kept.
REQUIRED_TRIP_COLUMNS = ["trip_id", "service_code", "delay_minutes", "is_delayed"]

# Columns of the stored trip table, in order.
TRIP_COLUMNS = [
    "trip_id", "service_code", "operator", "scheduled_depart", "actual_depart",
    "delay_minutes", "delay_minutes_clipped", "is_delayed", "weather", "weather_code",
    "scheduled_duration_min", "actual_duration_min", "passenger_count", "capacity",
    "load_factor", "vehicle_age_years", "driver_experience_yrs", "hour_of_night",
    "day_of_week", "disruption_count", "high_severity_count",
    "mean_dur", "std_dur", "cv_travel_time", "pct_on_time", "headway_min",
]

# Columns of the stored ping table, in order.
PING_COLUMNS = [
    "location_id", "trip_id", "timestamp", "latitude", "longitude", "speed_kmh",
    "heading_deg", "signal_quality", "service_code", "operator", "is_delayed",
]

# Model features, in order.
FEATURES = [
    "weather_code", "hour_of_night", "load_factor", "vehicle_age_years",
    "driver_experience_yrs", "scheduled_duration_min", "disruption_count",
    "high_severity_count", "cv_travel_time", "pct_on_time", "passenger_count",
]

# Columns of the correlation matrix, in order.
CORRELATED_COLUMNS = [
    "delay_minutes", "load_factor", "vehicle_age_years", "driver_experience_yrs",
    "disruption_count", "weather_code", "hour_of_night", "scheduled_duration_min",
    "passenger_count",
]
