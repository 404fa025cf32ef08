"""Scalar column expressions for trips and disruptions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_MINUTE = 6e7


def clamp(value: Column, low: float, high: float) -> Column:
    """Limit ``value`` to [low, high]; null and NaN stay, which ``greatest`` would replace."""
    above = (value > F.lit(high)) & ~F.isnan(value)
    return F.when(value < F.lit(low), F.lit(low)).when(above, F.lit(high)).otherwise(value)


def number(name: str) -> Column:
    """A column as double with NaN as null, so that statistics miss the same rows."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def is_complete(frame: DataFrame, columns: Sequence[str]) -> Column:
    """No null and no NaN in ``columns``; unlike ``dropna`` the null checks reach the file scan."""
    known = [F.col(name).isNotNull() for name in columns]
    numbers = [
        ~F.isnan(name) for name in columns
        if isinstance(frame.schema[name].dataType, (T.DoubleType, T.FloatType))
    ]
    return reduce(and_, [*known, *numbers])


def minutes_between(start: Column, end: Column) -> Column:
    """Signed fractional minutes from ``start`` to ``end``."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(MICROS_PER_MINUTE)


def off_schedule(delay: Column, tolerance: float) -> Column:
    """1 when early or late by more than ``tolerance`` minutes, else 0; exactly on the edge is 0."""
    return (F.abs(delay) > F.lit(tolerance)).cast("int")


def complement(flag: Column) -> Column:
    """1 where ``flag`` is 0, else 0."""
    return (flag == F.lit(0)).cast("int")


def load_share(passengers: Column, capacity: Column) -> Column:
    """Passengers per place, limited to [0, 1]; null without a capacity."""
    return clamp(F.try_divide(passengers.cast("double"), capacity.cast("double")), 0.0, 1.0)


def encode(value: Column, codes: Mapping[str, int]) -> Column:
    """Code of ``value``; null for a value that has none."""
    pairs = [F.lit(part) for pair in codes.items() for part in pair]
    return F.create_map(*pairs)[value]


def decode(code: Column, labels: Sequence[str]) -> Column:
    """Label at position ``code`` counted from 0; null outside the list."""
    known = code.between(0, len(labels) - 1)
    return F.when(known, F.element_at(F.array(*map(F.lit, labels)), (code + 1).cast("int")))


def is_night(moment: Column) -> Column:
    """Hour 22 or later, or before 6."""
    return (F.hour(moment) >= 22) | (F.hour(moment) < 6)


def hour_in_range(hour: Column, first: int, last: int) -> Column:
    """Hour in [first, last]; a range such as (22, 5) runs over midnight."""
    if first <= last:
        return hour.between(first, last)
    return (hour >= first) | (hour <= last)


def target_state(value: Column, target: float) -> Column:
    """'breach' below the target, else 'ok'."""
    return F.when(value < F.lit(target), "breach").otherwise("ok")


def calendar(moment: Column) -> dict[str, Column]:
    """Month, ISO week, weekday name and hour of a timestamp."""
    return {
        "month": F.month(moment),
        "week": F.weekofyear(moment),
        "day_of_week": F.date_format(moment, "EEEE"),
        "hour_of_night": F.hour(moment),
    }


def lenient_timestamp(text: Column) -> Column:
    """Timestamp without zone; text that is none gives null instead of an error."""
    return text.try_cast("timestamp_ntz")


def padded_key(prefix: str, width: int, number: Column) -> Column:
    """Prefix and number, zero-padded to ``width``; longer numbers keep all digits."""
    digits = number.cast("string")
    padded = F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))
    return F.concat(F.lit(prefix), padded)


def corrected_skewness(value: Column) -> Column:
    """Bias-corrected sample skewness; null below 3 values."""
    n = F.count(value).cast("double")
    factor = F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    return F.when(F.count(value) >= 3, factor * F.skewness(value))


def corrected_kurtosis(value: Column) -> Column:
    """Bias-corrected excess kurtosis; null below 4 values."""
    n = F.count(value).cast("double")
    factor = F.try_divide(n - 1, (n - 2) * (n - 3))
    return F.when(F.count(value) >= 4, factor * ((n + 1) * F.kurtosis(value) + 6))
