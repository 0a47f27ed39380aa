"""Text rules: names, patterns, sections, mappings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.convert import strip


def first_match(text: Column, patterns: Sequence[str]) -> Column:
    """First capture of the first pattern that matches, trimmed; no match gives NULL."""
    return F.coalesce(*[F.nullif(strip(F.regexp_extract(text, p, 1)), F.lit("")) for p in patterns])


def first_line_match(text: Column, pattern: str) -> Column:
    """Capture of the first line that matches: an array expression inside the row, no explode and no shuffle."""
    captures = F.transform(F.split(text, "\n"), lambda line: strip(F.regexp_extract(line, pattern, 1)))
    return F.get(F.filter(captures, lambda v: v != ""), F.lit(0))


# Fixed value: how a repaired version is written in a description.
FIXED_VERSION = r"(?i)fixed in\s+(?:version\s+)?([0-9.]+(?:\s*(?:or|and)\s*[0-9.]+)*)"


def cut(text: Column, longest: int | None) -> Column:
    """The first ``longest`` characters; all of them if None."""
    return text if longest is None else F.substring(text, 1, longest)


def fixed_version(text: Column, longest: int | None = None) -> Column:
    """Version text after ``fixed in [version]``, any case, cut to a length if one is given; none gives NULL."""
    found = F.regexp_extract(text, FIXED_VERSION, 1)
    return F.nullif(cut(strip(found), longest), F.lit(""))


def affected_products(criteria: Column, start: Column, end: Column, least_parts: int = 5) -> Column:
    """Language, product and version range of a ``:`` separated identifier of an application, else NULL."""
    parts = F.split(criteria, ":")
    vendor, product = F.lower(F.get(parts, F.lit(3))), F.lower(F.get(parts, F.lit(4)))
    python = vendor.contains("python") | product.contains("python")
    java = vendor.contains("java") | product.contains("java")
    wanted = (F.size(parts) >= least_parts) & (F.get(parts, F.lit(2)) == "a") & (python | java)
    versions = F.concat(F.coalesce(start, F.lit("")), F.lit("-"), F.coalesce(end, F.lit("")))
    return F.when(wanted, F.struct(F.when(python, "python").otherwise("java").alias("lang"),
                                   F.get(parts, F.lit(4)).alias("product"), versions.alias("versions")))


def mapping_rows(df: DataFrame, column: str, key: str = "key", values: str = "values") -> DataFrame:
    """``A:x,y|B:z`` to (key, list) rows; parts without ``:`` are dropped, the last of equal keys wins per text."""
    parts = F.transform(F.split(column, r"\|"), lambda p: F.struct(
        strip(F.substring_index(p, ":", 1)).alias("k"),
        F.when(p.contains(":"), strip(F.substring(p, F.instr(p, ":") + 1, F.length(p)))).alias("v")))
    last = F.filter(parts, lambda p, i: p["v"].isNotNull() & ~F.exists(
        F.slice(parts, i + 2, F.size(parts)), lambda q: q["v"].isNotNull() & (q["k"] == p["k"])))
    return (df.select("*", F.explode(last).alias("_part"))
            .select(*df.columns, F.col("_part.k").alias(key),
                    F.filter(F.transform(F.split("_part.v", ","), strip), lambda x: x != "").alias(values)))


def encode_base64(text: Column) -> Column:
    return F.base64(F.encode(text, "UTF-8"))


def decode_base64(text: Column) -> Column:
    return F.decode(F.unbase64(text), "UTF-8")


def padded_code(text: Column, width: int = 10) -> Column:
    """Left-padded with zeros; longer codes stay whole."""
    code = strip(text)
    return F.when(F.length(code) >= width, code).otherwise(F.lpad(code, width, "0"))


def section(text: Column, heading: str, following: str | None, otherwise: Column, open_length: int | None = None,
            longest: int | None = None, shortest: int = 0) -> Column:
    """Text between two headings (any case), or from the heading on where the following one does not come.

    ``open_length`` limits an open section, ``longest`` any; both are off by default. A body of ``shortest`` characters
    or fewer gives ``otherwise``. One pass finds the heading; the rest of the text is searched once.
    """
    rest = F.nullif(F.regexp_extract(text, rf"(?is){heading}:(.*)", 1), F.lit(""))
    parts = F.array(cut(rest, open_length)) if following is None else F.transform(
        F.array(F.split(rest, rf"(?is){following}:", 2)), lambda p: F.when(F.size(p) > 1, p[0]).otherwise(cut(p[0], open_length)))
    body = F.get(parts, F.lit(0))
    # through an array, so that the body is found once and not again for its length
    long_enough = F.filter(F.array(strip(body)), lambda b: F.length(b) > shortest)
    return F.coalesce(cut(F.get(long_enough, F.lit(0)), longest), otherwise)


def distinct_ids(text: Column, pattern: str) -> Column:
    """Distinct ids found by a pattern, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))))


def line_map(text: Column) -> Column:
    """``name: value`` lines to (name, first word) pairs; list marks before the name are removed."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.contains(":"))
    pairs = F.transform(lines, lambda x: F.struct(
        F.regexp_replace(strip(F.substring_index(x, ":", 1)), r"^[-*• ]+", "").alias("name"),
        F.get(F.split(strip(F.substring(x, F.instr(x, ":") + 1, F.length(x))), r"\s+"), F.lit(0)).alias("value")))
    return F.filter(pairs, lambda p: (p["name"] != "") & (p["value"] != ""))


def clean_cut(text: Column, longest: int | None = None) -> Column:
    """Cut to a length if one is given; empty becomes NULL."""
    return F.nullif(cut(text, longest), F.lit(""))


def clean_id(text: Column, prefix: str) -> Column:
    """Without the prefix, points as underscores."""
    return F.translate(F.regexp_replace(text, f"^{prefix}", ""), ".", "_")


# -- names held as data or used for columns -----------------------------------

# Names that clash with SQL keywords and what they become.
RENAMED_KEYWORDS = {"by": "submitted_by", "order": "order_value", "group": "group_value", "select": "select_value"}


def normal_name(c: Column) -> Column:
    """Non-word characters to underscores, lower case."""
    return F.lower(F.regexp_replace(c, r"[^\w]", "_"))


def table_name_of_file(c: Column) -> Column:
    """File name without extension and date prefix, hyphens as underscores, lower case."""
    bare = F.regexp_replace(F.regexp_replace(c, r"\.[^.]*$", ""), r"^\d{4}-\d{2}-\d{2}-", "")
    return F.regexp_replace(F.lower(F.translate(bare, "-", "_")), r"_+$", "")


def labelled_name(label: Column, identifier: Column) -> Column:
    """``label__id`` with only letters, digits and underscores; never starts with a digit."""
    words = F.regexp_replace(F.translate(F.lower(strip(label)), " -", "__"), r"[^a-z0-9_]", "")
    words = F.regexp_replace(F.regexp_replace(words, r"_+", "_"), r"^_+|_+$", "")
    words = F.when(words.rlike(r"^[0-9]"), F.concat(F.lit("field_"), words)).otherwise(words)
    words = F.when(F.coalesce(words, F.lit("")) == "", F.lower(identifier)).otherwise(words)
    name = F.concat(words, F.lit("__"), F.regexp_replace(F.lower(identifier), r"[^a-z0-9_]", ""))
    return F.when(name.rlike(r"^[0-9]"), F.concat(F.lit("field_"), name)).otherwise(name)


def keyword_safe(c: Column) -> Column:
    """Names that are SQL keywords get their replacement."""
    pairs = F.create_map(*[x for k, v in RENAMED_KEYWORDS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(pairs[F.lower(c)], c)
