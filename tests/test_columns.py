import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from punctua import config
from punctua.functions import columns as C


def column(spark, values, kind, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [row[0] for row in frame.orderBy("i").select(expression).collect()]


def test_tolerance_is_two_sided_and_closed(spark):
    delays = [-2.0, 2.0, -2.0001, 2.0001, 0.0, None]
    assert column(spark, delays, "double", C.off_schedule(F.col("x"), 2.0)) == [0, 0, 1, 1, 0, None]


def test_clamp_keeps_null_and_nan(spark):
    found = column(spark, [-99.0, 5.0, 99.0, None, float("nan")], "double",
                   C.clamp(F.col("x"), -30.0, 60.0))
    assert found[:4] == [-30.0, 5.0, 60.0, None] and math.isnan(found[4])


def test_load_share_without_capacity_or_passengers(spark):
    frame = spark.createDataFrame([(30, 75), (99, 75), (5, 0), (None, 75)], "p int, c int")
    shares = [r[0] for r in frame.select(C.load_share(F.col("p"), F.col("c"))).collect()]
    assert shares == [0.4, 1.0, None, None]


def test_weather_codes(spark):
    encoded = C.encode(F.col("x"), config.WEATHER_CODES)
    values = ["Clear", "Rain", "Fog", "Snow", "Windy", "Hail", None]
    assert column(spark, values, "string", encoded) == [0, 1, 2, 3, 4, None, None]


def test_decode_outside_the_list(spark):
    decoded = C.decode(F.col("x"), config.CLASS_NAMES)
    assert column(spark, [0, 1, 2, -1, None], "int", decoded) == ["On-Time", "Delayed"] + [None] * 3


@pytest.mark.parametrize("first,last,wanted", [
    (22, 5, [22, 23, 0, 1, 4, 5]), (1, 4, [1, 4]), (3, 3, []), (0, 23, [22, 23, 0, 1, 4, 5, 6, 21]),
])
def test_hour_ranges(spark, first, last, wanted):
    hours = [22, 23, 0, 1, 4, 5, 6, 21]
    kept = column(spark, hours, "int", C.hour_in_range(F.col("x"), first, last))
    inside = [h for h, keep in zip(hours, kept) if keep]
    assert inside == wanted


def test_night_edges(spark):
    moments = [dt.datetime(2024, 10, 1, h, m) for h, m in [(21, 59), (22, 0), (5, 59), (6, 0)]]
    found = column(spark, moments, "timestamp_ntz", C.is_night(F.col("x")))
    assert found == [False, True, True, False]


def test_delay_is_fractional(spark):
    frame = spark.createDataFrame(
        [(dt.datetime(2024, 10, 1, 22), dt.datetime(2024, 10, 1, 22, 1, 30, 500000))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    delay = C.minutes_between(F.col("a"), F.col("b"))
    assert frame.select(delay).first()[0] == pytest.approx(90.5 / 60)


def test_lenient_timestamp(spark):
    parsed = C.lenient_timestamp(F.col("x"))
    texts = ["2024-10-01 22:05:00", "2024-10-01T22:05:00.5", "soon", "", None]
    assert column(spark, texts, "string", parsed) == [
        dt.datetime(2024, 10, 1, 22, 5), dt.datetime(2024, 10, 1, 22, 5, 0, 500000), None, None, None,
    ]


def test_padded_key_keeps_long_numbers(spark):
    keys = column(spark, [5, 1234567, 123456789], "bigint", C.padded_key("T", 7, F.col("x")))
    assert keys == ["T0000005", "T1234567", "T123456789"]


def test_calendar_iso_week(spark):
    parts = C.calendar(F.col("x"))
    moment = dt.datetime(2024, 12, 30, 23, 10)
    found = [column(spark, [moment], "timestamp_ntz", part)[0] for part in parts.values()]
    assert found == [12, 1, "Monday", 23]


def test_corrected_moments(spark):
    values = [1.0, 2.0, 4.0, 9.0, 3.5]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    n, mean = len(values), sum(values) / len(values)
    m2, m3, m4 = (sum((v - mean) ** k for v in values) / n for k in (2, 3, 4))
    skew = math.sqrt(n * (n - 1)) / (n - 2) * m3 / m2 ** 1.5
    kurt = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * (m4 / m2 ** 2 - 3) + 6)
    row = frame.select(C.corrected_skewness(F.col("x")), C.corrected_kurtosis(F.col("x"))).first()
    assert row[0] == pytest.approx(skew) and row[1] == pytest.approx(kurt)


@pytest.mark.parametrize("n,known", [(2, (False, False)), (3, (True, False)), (4, (True, True))])
def test_moments_of_few_values(spark, n, known):
    frame = spark.createDataFrame([(float(i * i),) for i in range(n)], "x double")
    row = frame.select(C.corrected_skewness(F.col("x")), C.corrected_kurtosis(F.col("x"))).first()
    assert tuple(value is not None for value in row) == known
