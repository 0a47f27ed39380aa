"""Lenient conversions of dates, numbers and flags, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def strip(c: Column) -> Column:
    """Without white space at both ends, line ends included."""
    return F.btrim(c, F.lit(" \t\n\x0b\f\r"))


def lenient_int(c: Column, kind: str = "bigint") -> Column:
    """Whole number of a text, or NULL; ``kind`` may name a narrower type."""
    return c.try_cast(kind)


def lenient_float(c: Column) -> Column:
    return c.try_cast("double")


def iso_text(ts: Column) -> Column:
    """UTC instant as ``yyyy-MM-ddTHH:mm:ssZ``."""
    return F.date_format(ts, ISO_SECONDS)


def utc(text: Column) -> Column:
    """ISO text to a UTC instant: no zone means UTC, other zones are converted, bad text is NULL."""
    return F.try_to_timestamp(text)


def lenient_date(text: Column) -> Column:
    """ISO text (has a ``T``) or epoch seconds to ISO text; bad values become NULL."""
    instant = F.when(text.contains("T"), F.try_to_timestamp(text)).otherwise(F.timestamp_seconds(text.try_cast("bigint")))
    return iso_text(instant)


def from_epoch_millis(c: Column) -> Column:
    return F.timestamp_millis(c)


def from_epoch_seconds(c: Column) -> Column:
    """Epoch seconds, a fraction allowed."""
    return F.timestamp_seconds(c)


def to_epoch_seconds(text: Column) -> Column:
    return F.unix_seconds(utc(text))


def to_epoch_millis(text: Column) -> Column:
    return F.unix_millis(utc(text))


def state_timestamp(text: Column, fallback: str = "1970-01-01T00:00:00Z") -> Column:
    """A stored mark; missing or bad text gives a fixed early instant."""
    return F.coalesce(utc(text), F.lit(fallback).cast("timestamp"))


def parse_formats(text: Column, formats: Sequence[str]) -> Column:
    """The first format that fits decides; none gives NULL."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def iso_or_text(text: Column, formats: Sequence[str]) -> Column:
    """ISO text when a format fits, else the text as it came; empty gives NULL."""
    return F.when(text != "", F.coalesce(iso_text(parse_formats(text, formats)), text))


def hours_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(3.6e9)


def seconds_between(start: Column, end: Column, otherwise: Column) -> Column:
    """Seconds from start to end, or the given value where one of them is missing."""
    return F.coalesce((F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(1e6), otherwise)


def date_windows(bounds: DataFrame, start: str, end: str, days: int) -> DataFrame:
    """Consecutive windows of ``days`` days, both ends inside, the last one cut at the end date."""
    starts = F.explode(F.sequence(F.col(start).cast("date"), F.col(end).cast("date"), F.expr(f"INTERVAL {days} DAYS")))
    return bounds.withColumn("window_start", starts).withColumn(
        "window_end", F.least(F.date_add("window_start", days - 1), F.col(end).cast("date")))


def day_list(bounds: DataFrame, start: str, end: str, name: str = "day") -> DataFrame:
    """All days between two instants as ``yyyyMMdd``."""
    days = F.sequence(F.col(start).cast("date"), F.col(end).cast("date"), F.expr("INTERVAL 1 DAY"))
    return bounds.select(F.explode(days).alias("_d")).select(F.date_format("_d", "yyyyMMdd").alias(name))


def number_from_text(text: Column) -> Column:
    """Currency signs and blanks removed, comma read as a point, the last point is the decimal one."""
    digits = F.regexp_replace(F.translate(text, ",", "."), r"[^0-9.\-]", "")
    return F.regexp_replace(digits, r"\.(?=.*\.)", "").try_cast("double")


def flag_from_text(text: Column, default: bool | None = False, strict: bool = True, yes_no: bool = False) -> Column:
    """``true``/``false`` of any case; blank or ``<...>`` gives the default; other text raises or gives NULL."""
    word = F.lower(strip(text))
    true, false = (["true", "yes"], ["false", "no"]) if yes_no else (["true"], ["false"])
    bad = F.raise_error(F.concat(F.lit("not a flag: "), text)).cast("boolean") if strict else F.lit(None).cast("boolean")
    placeholder = text.isNull() | (word == "") | (word.startswith("<") & word.endswith(">"))
    return F.when(placeholder, F.lit(default).cast("boolean")).when(word.isin(*true), F.lit(True)).when(
        word.isin(*false), F.lit(False)).otherwise(bad)


def money(c: Column, as_double: bool = False, precision: int = 18, scale: int = 2) -> Column:
    """Exact decimal, or a double on request; a value that the decimal would round or lose is an error."""
    exact = c.cast("string").try_cast(T.DecimalType(precision, scale))
    lost = c.isNotNull() & ~F.coalesce(exact.cast("double") == c.cast("double"), F.lit(False))
    problem = F.raise_error(F.concat(F.lit(f"does not fit DECIMAL({precision},{scale}): "), c.cast("string")))
    exact = F.when(lost, problem.cast(T.DecimalType(precision, scale))).otherwise(exact)
    return exact.cast("double") if as_double else exact


def typed_cell(value: Column, kind: Column, precision: int = 38, scale: int = 9) -> dict[str, Column]:
    """Typed columns of a text cell by its declared type; what does not fit stays readable as text.

    A number with more decimal places than ``scale`` does not fit.
    """
    stamp = F.when(kind.isin("DATE", "DATETIME"), utc(value).cast("timestamp_ntz"))
    check = F.when(kind == "CHECKBOX", F.lower(value).isin("true", "1"))
    places = F.length(F.regexp_extract(value, r"\.([0-9]*?)0*\s*$", 1))
    fits = (places <= scale) & ~value.rlike("[eE]")
    number = F.when(kind.isin("NUMBER", "CURRENCY", "PERCENT") & fits, value.try_cast(T.DecimalType(precision, scale)))
    text = F.when(value.isNotNull() & F.coalesce(stamp.cast("string"), check.cast("string"), number.cast("string")).isNull(), value)
    return {"stamp_value": stamp, "check_value": check, "number_value": number, "text_value": text}


def scalar_only(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, dates as ISO text, bytes as UTF-8 text, the rest as is."""

    def one(field: T.StructField) -> Column:
        c = F.col(field.name)
        kind = field.dataType
        if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(c, {"ignoreNullFields": "false"})
        if isinstance(kind, T.DateType):
            return F.date_format(c, "yyyy-MM-dd")
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        if isinstance(kind, T.BinaryType):
            return F.try_validate_utf8(c.cast("string"))
        return c

    return df.select(*[one(f).alias(f.name) for f in df.schema.fields])
