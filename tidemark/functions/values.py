"""Reading single values out of nested, JSON and message columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.convert import strip


def first_or(items: Column, default) -> Column:
    """First element of a list, else a default."""
    return F.coalesce(F.get(items, F.lit(0)), F.lit(default))


def first_with_prefix(lists: Column, prefix: str) -> Column:
    """First text with a prefix in a list of lists."""
    return F.get(F.filter(F.flatten(lists), lambda v: v.startswith(prefix)), F.lit(0))


def first_member(items: Column, member: str, default=None) -> Column:
    """A member of the first list item, else a default."""
    value = F.get(items, F.lit(0))[member]
    return value if default is None else F.coalesce(value, F.lit(default))


def json_cell(text: Column) -> Column:
    """The text as compact JSON where it looks like an object and parses, else NULL."""
    return F.when(text.rlike(r"(?s)^\{.*\}$"), F.to_json(F.try_parse_json(text)))


def json_inside(text: Column) -> Column:
    """From the first ``{`` to the last ``}`` as compact JSON; nothing or bad JSON gives NULL."""
    return F.to_json(F.try_parse_json(F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))))


def vector(text: Column) -> Column:
    """Vector text to doubles: JSON list or comma list with optional brackets; one bad part gives NULL."""
    inner = strip(F.regexp_replace(strip(text), r"^\[(.*)\]$", "$1"))
    parts = F.filter(F.split(inner, ","), lambda p: strip(p) != "")
    numbers = F.transform(parts, lambda p: strip(F.regexp_replace(strip(p), "^[\"']+|[\"']+$", "")).try_cast("double"))
    return F.when(text.isNotNull() & ~F.exists(numbers, lambda x: x.isNull()), numbers)


def payload(body: Column) -> Column:
    """Message bytes as JSON text: the JSON itself, else ``raw_data`` text, else ``raw_data_base64``."""
    text = F.try_validate_utf8(body.cast("string"))
    parsed = F.to_json(F.try_parse_json(text))
    return F.coalesce(parsed, F.when(text.isNotNull(), F.to_json(F.struct(text.alias("raw_data")))),
                      F.to_json(F.struct(F.base64(body).alias("raw_data_base64"))))


def rendered(kind: Column, value: Column, fields: Column, members: Column, scores: Column) -> dict[str, Column]:
    """Text and size of a typed key-value item: text as is, hash, list, set and sorted set as JSON."""
    pairs = F.transform(F.arrays_zip(members.alias("m"), scores.alias("s")),
                        lambda p: F.concat(F.lit('["'), p["m"], F.lit('",'), p["s"].cast("string"), F.lit("]")))
    text = (F.when(kind == "string", value).when(kind == "hash", F.to_json(fields))
            .when(kind.isin("list", "set"), F.to_json(members))
            .when(kind == "zset", F.concat(F.lit("["), F.array_join(pairs, ","), F.lit("]")))
            .otherwise(F.concat(F.lit("Unsupported type: "), kind)))
    size = (F.when(kind == "string", F.coalesce(F.length(value), F.lit(0))).when(kind == "hash", F.size(fields))
            .when(kind.isin("list", "set", "zset"), F.size(members)).otherwise(0))
    return {"value": text, "size": size}


def message_row(topic: Column, body: Column, publish_ms: Column, event_ms: Column, key: Column, producer: Column,
                sequence: Column, message_id: Column) -> dict[str, Column]:
    """Envelope of a message as columns; event time 0 and an empty key mean none."""
    return {
        "message_id": message_id,
        "topic": topic,
        "publish_time": F.timestamp_millis(publish_ms).cast("timestamp_ntz"),
        "event_time": F.when(event_ms > 0, F.timestamp_millis(event_ms).cast("timestamp_ntz")),
        "message_key": F.nullif(key, F.lit("")),
        "data": payload(body),
        "producer_name": producer,
        "sequence_id": sequence,
    }
