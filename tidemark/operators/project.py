"""Projections and row filters built from settings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.convert import iso_or_text
from tidemark.operators.schema import declared_type


def include_exclude(df: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = (),
                    unwanted_types: Sequence[str] = ()) -> DataFrame:
    """Include list first, then exclude list, names in any case; neither means all columns."""
    wanted, refused = {c.lower() for c in include}, {c.lower() for c in exclude}
    keep = [f.name for f in df.schema.fields
            if (not wanted or f.name.lower() in wanted) and f.name.lower() not in refused
            and f.dataType.simpleString() not in unwanted_types]
    return df.select(*keep)


def allow_list(df: DataFrame, declared: Mapping[str, str], date_formats: Sequence[str]) -> DataFrame:
    """Declared columns only; UTC date-times become ISO text, or NULL when missing; others pass when present."""
    out = []
    for name, kind in declared.items():
        if kind == "UTC_DATETIME":
            out.append((iso_or_text(F.col(name).cast("string"), date_formats) if name in df.columns
                        else F.lit(None).cast("string")).alias(name))
        elif name in df.columns:
            out.append(F.col(name).cast(declared_type(kind)).alias(name))
    return df.select(*out)


def rename_by(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Known names renamed, unknown ones kept."""
    return df.withColumnsRenamed(dict(names))


def _without(c: Column, kind: T.DataType, marker: str) -> Column:
    if isinstance(kind, T.StructType):
        fields = [_without(c[f.name], f.dataType, marker).alias(f.name) for f in kind.fields if marker not in f.name]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        return F.transform(c, lambda e: _without(e, kind.elementType, marker))
    return c


def drop_marked(df: DataFrame, marker: str = "@odata") -> DataFrame:
    """Without the fields, at any level, whose name contains the marker."""
    return df.select(*[_without(F.col(f"`{f.name}`"), f.dataType, marker).alias(f.name)
                       for f in df.schema.fields if marker not in f.name])


def with_constants(df: DataFrame, **values) -> DataFrame:
    """Run constants on each row; a run time is passed in, never taken per row."""
    return df.withColumns({n: v if isinstance(v, Column) else F.lit(v) for n, v in values.items()})


def fill_by_class(df: DataFrame) -> DataFrame:
    """NULL to 0 for ``number_*``, to ``[]`` for ``*_problems`` and ``*_products``, else to empty text."""

    def fill(f: T.StructField) -> Column:
        c = F.col(f.name)
        if f.name.startswith("number_"):
            return F.coalesce(c, F.lit(0))
        if f.name.endswith(("_problems", "_products")):
            return F.coalesce(c, F.lit("[]"))
        return F.coalesce(c, F.lit("")) if isinstance(f.dataType, T.StringType) else c

    return df.select(*[fill(f).alias(f.name) for f in df.schema.fields])


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def present(c: Column) -> Column:
    """True where the value is there."""
    return c.isNotNull()


# -- row filters -----------------------------------------------------------------


def _items(listing: str | Sequence[str]) -> list[str]:
    parts = listing.split(",") if isinstance(listing, str) else listing
    return [p.strip() for p in parts if p.strip()]


def id_filter(c: Column, include: str | Sequence[str] = (), exclude: str | Sequence[str] = ()) -> Column:
    """Excluded ids drop, an include list restricts, a missing id drops."""
    keep = c.isNotNull()
    if _items(exclude):
        keep = keep & ~c.cast("string").isin(*_items(exclude))
    if _items(include):
        keep = keep & c.cast("string").isin(*_items(include))
    return keep


def member_filter(c: Column, listing: str | Sequence[str]) -> Column:
    """Values in a comma list; an empty list keeps everything."""
    return c.isin(*_items(listing)) if _items(listing) else F.lit(True)


def relevant(codes: Column, wanted: Sequence[str], text: Column, keyword: str) -> Column:
    """Kept unless the row has codes, none of them is wanted and the text lacks the keyword."""
    hit = F.arrays_overlap(codes, F.array(*map(F.lit, wanted)))
    return (F.coalesce(F.size(codes), F.lit(0)) == 0) | hit | F.lower(text).contains(keyword.lower())


_TESTS = {
    "equal": lambda c, a: c == a,
    "notEqual": lambda c, a: c != a,
    "greaterThan": lambda c, a: c > a,
    "greaterThanOrEqual": lambda c, a: c >= a,
    "lessThan": lambda c, a: c < a,
    "lessThanOrEqual": lambda c, a: c <= a,
    "contains": lambda c, a: c.contains(a),
    "notContains": lambda c, a: ~c.contains(a),
    "startsWith": lambda c, a: c.startswith(a),
    "endsWith": lambda c, a: c.endswith(a),
    "blank": lambda c, a: c.isNull(),
    "notBlank": lambda c, a: c.isNotNull(),
    "isIn": lambda c, a: c.isin(*a),
    "notIsIn": lambda c, a: ~c.isin(*a),
}


def filter_list(filters: Sequence[Mapping]) -> Column:
    """``[{field, function, argument}]`` as one predicate; Catalyst pushes it into the scan."""
    tests = [_TESTS[f["function"]](F.col(f["field"]), f.get("argument")) for f in filters]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def with_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is complete."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def missing_key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows with and without a complete key."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.agg(F.count_if(complete).alias("kept"), F.count_if(~complete).alias("dropped"))
