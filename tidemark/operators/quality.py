"""Row rules: the first broken rule is the reason, broken rows go to a reject frame."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.convert import strip

REASON = "reject_reason"


@dataclass(frozen=True)
class Rule:
    """A condition a row must meet; NULL counts as broken."""

    reason: str
    valid: Column


def whole_number(c: Column) -> Column:
    return strip(c).rlike(r"^[+-]?[0-9]+$")


def flag_word(c: Column) -> Column:
    return F.lower(c).isin("true", "false")


def not_blank(c: Column) -> Column:
    return strip(c) != ""


def json_text(c: Column) -> Column:
    return F.try_parse_json(c).isNotNull()


def date_text(c: Column, pattern: str = "yyyy-M-d") -> Column:
    return F.try_to_timestamp(strip(c), F.lit(pattern)).isNotNull()


def stamp_text(c: Column, pattern: str = "yyyy-M-d H:m:s") -> Column:
    return F.try_to_timestamp(strip(c), F.lit(pattern)).isNotNull()


def identifier(c: Column) -> Column:
    """A word that starts with a letter or underscore."""
    return c.rlike(r"^[A-Za-z_][A-Za-z0-9_]*$")


def required(*names: str) -> list[Rule]:
    return [Rule(f"missing {n}", F.col(n).isNotNull()) for n in names]


def with_reason(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The reason of the first broken rule, NULL for good rows: one projection, no Python."""
    broken = [F.when(~F.coalesce(r.valid, F.lit(False)), F.lit(r.reason)) for r in rules]
    return df.withColumn(REASON, F.coalesce(*broken, F.lit(None).cast("string")))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(checked: DataFrame) -> DataFrame:
    """The rows as JSON with their reason."""
    columns = [c for c in checked.columns if c != REASON]
    return checked.filter(F.col(REASON).isNotNull()).select(
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("row"), REASON)


def reject_counts(checked: DataFrame) -> DataFrame:
    """Rows per reason; good rows count as ``ok``."""
    return checked.groupBy(F.coalesce(REASON, F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"))


def stop_above(checked: DataFrame, most: int | None = None, share: float | None = None) -> DataFrame:
    """The accepted rows, or an error before any write when too many rows are broken (one aggregate row decides)."""
    row = checked.agg(F.count("*").alias("n"), F.count(REASON).alias("bad")).first()
    if most is not None and row["bad"] > most or share is not None and row["n"] and row["bad"] / row["n"] > share:
        raise ValueError(f"{row['bad']} of {row['n']} rows break a rule")
    return accepted(checked)
