"""Hashes and generated keys with a text form that does not change between Spark versions."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _escaped(ch: Column) -> Column:
    """One character as it stands in ASCII JSON text."""
    code = F.regexp_replace(F.lower(F.hex(F.encode(ch, "UTF-16BE"))), "([0-9a-f]{4})", r"\\u$1")
    named = {'"': r"\"", "\\": r"\\", "\n": r"\n", "\r": r"\r", "\t": r"\t", "\b": r"\b", "\f": r"\f"}
    out = F.when(ch.rlike(r"^[ !#-\[\]-~]$"), ch)
    for raw, text in named.items():
        out = out.when(ch == F.lit(raw), F.lit(text))
    return out.otherwise(code)


def json_string(c: Column) -> Column:
    """A JSON string with every character outside printable ASCII escaped."""
    body = F.when(c.rlike(r"^[ !#-\[\]-~]*$"), c).otherwise(F.array_join(F.transform(F.split(c, ""), _escaped), ""))
    return F.concat(F.lit('"'), body, F.lit('"'))


def float_text(c: Column) -> Column:
    """Shortest text of a double: fixed notation from 1e-4 to below 1e16, else ``1.5e-05`` style."""
    plain, size = c.cast("string"), F.abs(c)

    def fixed(scale: int) -> Column:
        return F.regexp_replace(F.regexp_replace(c.cast(T.DecimalType(38, scale)).cast("string"), "0+$", ""), r"\.$", ".0")

    mantissa = F.regexp_replace(F.substring_index(plain, "E", 1), r"\.0$", "")
    power = F.substring_index(plain, "E", -1).try_cast("int")
    scientific = F.concat(mantissa, F.when(power < 0, "e-").otherwise("e+"),
                          F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0")))
    return (F.when(F.isnan(c), "NaN").when(size == F.lit(float("inf")), F.when(c > 0, "Infinity").otherwise("-Infinity"))
            .when((size == 0) | ((size >= 1e-3) & (size < 1e7)), plain)
            .when((size >= 1e7) & (size < 1e16), fixed(10))
            .when((size >= 1e-4) & (size < 1e-3), fixed(22))
            .otherwise(scientific))


def value_text(c: Column, kind: T.DataType) -> Column:
    """JSON text of a scalar by its type; NULL is ``null``."""
    if isinstance(kind, T.BooleanType):
        text = F.when(c, "true").otherwise("false")
        text = F.when(c.isNotNull(), text)
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        text = float_text(c.cast("double"))
    elif isinstance(kind, T.IntegralType):
        text = c.cast("string")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(c, "'\"'yyyy-MM-dd'T'HH:mm:ss.SSSSSS'\"'")
    elif isinstance(kind, T.DateType):
        text = F.concat(F.lit('"'), c.cast("string"), F.lit('"'))
    elif isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        text = F.to_json(c, {"ignoreNullFields": "false"})
    elif isinstance(kind, T.BinaryType):
        text = json_string(F.base64(c))
    else:
        text = json_string(c.cast("string"))
    return F.coalesce(text, F.lit("null"))


def row_json(schema: T.StructType, columns: Sequence[str], present: Mapping[str, Column] | None = None) -> Column:
    """Key-sorted JSON text of a row; ``present`` says per column where the key exists at all."""
    texts = {n: value_text(F.col(n), schema[n].dataType) for n in sorted(columns)}
    names = {n: F.lit(json.dumps(n) + ": ") for n in texts}
    if present:
        parts = [F.when(present.get(n, F.lit(True)), F.concat(names[n], texts[n])) for n in texts]
        return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
    pieces = [p for i, n in enumerate(texts) for p in (F.lit(", " if i else "{"), names[n], texts[n])]
    return F.concat(*pieces, F.lit("}"))


def row_hash(df: DataFrame, columns: Sequence[str] | None = None, present: Mapping[str, Column] | None = None) -> Column:
    """SHA-1 of the key-sorted JSON of a row; an absent key and a NULL differ."""
    return F.sha1(F.encode(row_json(df.schema, columns or df.columns, present), "UTF-8"))


def with_row_id(df: DataFrame, name: str = "_row_id") -> DataFrame:
    """An id from all column values, for tables without a key."""
    return df.withColumn(name, row_hash(df))


def document_id(df: DataFrame, candidates: Sequence[str]) -> Column:
    """The first id present, else SHA-256 of the sorted record."""
    have = [F.col(c).cast("string") for c in candidates if c in df.columns]
    return F.coalesce(*have, F.sha2(F.encode(row_json(df.schema, df.columns), "UTF-8"), 256))


def series_id(name: Column, labels: Column) -> Column:
    """MD5 of ``name{k=v,...}`` with the labels sorted by key."""
    pairs = F.transform(F.array_sort(F.map_entries(labels)), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.md5(F.concat(name, F.lit("{"), F.array_join(pairs, ","), F.lit("}")))


def change_hash(kind: Column, value: Column) -> Column:
    """MD5 of ``type:value``."""
    return F.md5(F.concat(kind, F.lit(":"), value))


def generated_key(key: Column, parts: Sequence[Column], prefix: str = "gen-") -> Column:
    """The key, or where it is missing a prefix and the MD5 of the parts joined by ``_`` (NULL as empty)."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.coalesce(key, F.concat(F.lit(prefix), F.md5(F.concat_ws("_", *texts))))


def short_digest(c: Column, length: int = 8) -> Column:
    """The first hex digits of an MD5, for display: at 8 digits some 77,000 values already collide at even odds, so it is no key."""
    return F.substring(F.md5(c), 1, length)


def message_key(source: Column, tag: Column, body: Column) -> Column:
    """``source_tag_digest`` from the source, its tag and the message body.

    16 hex digits tell messages of one source and tag apart, not of all; where a source sends billions, key by the full digest.
    """
    digest = F.sha2(F.concat_ws(":", source, tag.cast("string"), body), 256)
    return F.concat_ws("_", source, tag.cast("string"), F.substring(digest, 1, 16))


def positional_key(*parts: Column) -> Column:
    return F.concat_ws("_", *[p.cast("string") for p in parts])
