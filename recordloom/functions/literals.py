"""Typed literals and timestamp normalization."""

from __future__ import annotations

from datetime import UTC, date, datetime
from decimal import Decimal
from typing import Any
from zoneinfo import ZoneInfo

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: list items are joined with this separator.
LIST_SEPARATOR = "; "

_TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)


def is_timestamp(dtype: T.DataType) -> bool:
    return isinstance(dtype, _TIMESTAMPS)


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.VarcharType, T.CharType))


def text_literal(value: Any) -> Column:
    """A value as Spark writes it when it casts a column of that kind to text; lists are joined."""
    if isinstance(value, str):
        return F.lit(value)
    if isinstance(value, (list, tuple)):
        return F.concat_ws(LIST_SEPARATOR, *[text_literal(item) for item in value])
    if isinstance(value, datetime):
        return F.lit(to_minute(value).isoformat(sep=" "))
    return F.lit(value).cast("string")


def to_minute(value: datetime) -> datetime:
    """Session-local wall-clock time, cut to the minute."""
    if value.tzinfo is not None:
        spark = SparkSession.getActiveSession()
        zone = spark.conf.get("spark.sql.session.timeZone") if spark else "UTC"
        value = value.astimezone(ZoneInfo(zone)).replace(tzinfo=None)
    return value.replace(second=0, microsecond=0)


_WHOLE_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def _number(value: Any, dtype: T.DataType) -> Column:
    """A numeric literal, of the column's type only where that does not change its value."""
    number = Decimal(str(int(value) if isinstance(value, bool) else value).strip())
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.lit(float(number)).cast(dtype)
    bits = _WHOLE_BITS.get(type(dtype))
    whole = number.is_finite() and number == number.to_integral_value()
    if bits and whole and -(2 ** (bits - 1)) <= number < 2 ** (bits - 1):
        return F.lit(int(number)).cast(dtype)
    return F.lit(float(number)) if bits else F.lit(number)


def typed(value: Any, dtype: T.DataType) -> Column:
    """A literal of the column's own type, so that comparisons reach the scan."""
    if isinstance(dtype, T.ArrayType):
        items = value if isinstance(value, (list, tuple)) else [value]
        return F.array(*[typed(item, dtype.elementType) for item in items]).cast(dtype)
    if is_timestamp(dtype):
        if isinstance(value, datetime):
            value = to_minute(value).isoformat(sep=" ")
        elif isinstance(value, date):
            value = f"{value.isoformat()} 00:00:00"
        return F.lit(value).cast(dtype)
    if isinstance(dtype, T.DateType):
        value = value.date() if isinstance(value, datetime) else value
        return F.lit(value.isoformat() if isinstance(value, date) else value).cast(dtype)
    if is_text(dtype):
        return text_literal(value)
    if isinstance(value, (list, tuple)):
        raise ValueError(f"a list cannot be compared with {dtype.simpleString()}")
    if isinstance(dtype, T.NumericType):
        return _number(value, dtype)
    return F.lit(value).cast(dtype)


def utc_second(value: datetime | str) -> datetime:
    """An aware timestamp in UTC, cut to the whole second."""
    if isinstance(value, str):
        try:
            value = datetime.fromisoformat(value.strip())
        except ValueError as error:
            raise ValueError("not a valid ISO-8601 timestamp") from error
    if value.utcoffset() is None:
        raise ValueError("the timestamp must include a timezone")
    return value.astimezone(UTC).replace(microsecond=0)


def utc_second_literal(value: datetime | str, dtype: T.DataType) -> Column:
    """``utc_second`` as a literal; zone-free columns are taken to hold UTC."""
    moment = utc_second(value).strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(moment).cast(dtype)
    return F.lit(f"{moment}Z").cast(T.TimestampType())


def utc_second_column(column: Column, zone: str) -> Column:
    """Wall-clock timestamps of one zone as UTC, cut to the whole second."""
    return F.date_trunc("second", F.to_utc_timestamp(column, zone))
