"""Nested records to flat columns, child tables, trees, edges: column expressions and explodes only."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

JSON_OPTIONS = {"ignoreNullFields": "false"}


@dataclass(frozen=True)
class FlattenOptions:
    """How nested members become columns.

    ``empty_list``: ``null`` or ``[]``. ``lists``: ``json``, ``comma`` (text lists comma-joined, others JSON),
    ``semicolon`` or ``drop``. ``structs``: ``flatten``, ``json`` or ``drop``. ``max_depth``: deeper structs become
    JSON. ``exclude``: top-level fields left out. ``only``: top-level structs that are flattened, others become JSON.
    ``prefix``: parent names in front of child names. ``overwrite``: on equal names the later column wins instead of
    an error. ``name``: applied to each column name. ``index_lists``: width per list of structs that is spread to
    ``name_0_x`` columns.
    """

    separator: str = "_"
    empty_list: str = "null"
    lists: str = "json"
    structs: str = "flatten"
    empty_struct_null: bool = False
    max_depth: int | None = None
    exclude: Sequence[str] = ()
    only: Sequence[str] | None = None
    prefix: bool = True
    overwrite: bool = False
    name: Callable[[str], str] = field(default=lambda n: n)
    index_lists: Mapping[str, int] = field(default_factory=dict)


def _list_column(c: Column, kind: T.ArrayType, o: FlattenOptions) -> Column:
    if o.lists == "semicolon":
        text = F.array_join(c if isinstance(kind.elementType, T.StringType) else c.cast("array<string>"), "; ")
    elif o.lists == "comma" and isinstance(kind.elementType, T.StringType):
        text = F.array_join(c, ",")
    else:
        text = F.to_json(c, JSON_OPTIONS)
    if o.empty_list == "null":
        return F.when(F.size(c) > 0, text)
    return F.when(F.coalesce(F.size(c), F.lit(0)) > 0, text).otherwise("" if o.lists == "semicolon" else "[]")


def _struct_json(c: Column, kind: T.StructType, o: FlattenOptions) -> Column:
    text = F.to_json(c, JSON_OPTIONS)
    if not o.empty_struct_null:
        return text
    filled = F.coalesce(*[F.when(c[f.name].isNotNull(), F.lit(True)) for f in kind.fields], F.lit(False))
    return F.when(filled, text)


def _walk(c: Column, kind: T.DataType, path: str, depth: int, top: str, o: FlattenOptions):
    def child(name: str) -> str:
        return f"{path}{o.separator}{name}" if o.prefix and path else name

    if isinstance(kind, T.StructType):
        deep = o.max_depth is not None and depth > o.max_depth
        chosen = o.only is None or top in o.only
        if depth > 0 and o.structs == "drop":
            return
        if depth > 0 and (o.structs == "json" or deep or not chosen):
            yield path, _struct_json(c, kind, o)
            return
        for f in kind.fields:
            if depth == 0 and f.name in o.exclude:
                continue
            inner = F.col(f"`{f.name}`") if depth == 0 else c[f.name]
            yield from _walk(inner, f.dataType, child(f.name), depth + 1, f.name if depth == 0 else top, o)
    elif isinstance(kind, T.ArrayType):
        width = o.index_lists.get(path)
        if width is not None and isinstance(kind.elementType, T.StructType):
            too_long = F.raise_error(F.concat(F.lit(f"{path} has more than {width} elements: "), F.size(c)))
            c = F.when(F.size(c) > width, too_long.cast(kind)).otherwise(c)
            for i in range(width):
                yield from _walk(F.get(c, F.lit(i)), kind.elementType, f"{path}{o.separator}{i}", depth + 1, top, o)
        elif o.lists != "drop":
            yield path, _list_column(c, kind, o)
    elif isinstance(kind, T.MapType):
        yield path, F.to_json(c, JSON_OPTIONS)
    else:
        yield path, c


def flatten(df: DataFrame, options: FlattenOptions | None = None, **settings) -> DataFrame:
    """One flat projection of a nested frame; equal result names raise unless ``overwrite``."""
    o = options or FlattenOptions(**settings)
    columns: dict[str, Column] = {}
    for path, c in _walk(F.lit(None), df.schema, "", 0, "", o):
        name = o.name(path)
        if name in columns and not o.overwrite:
            raise ValueError(f"two members flatten to the column {name}")
        columns[name] = c
    return df.select(*[c.alias(n) for n, c in columns.items()])


def repeat_parent(df: DataFrame, items: str, parent: Sequence[str]) -> DataFrame:
    """One row per list element with the parent's columns; parents without elements give none."""
    return df.select(*parent, F.inline(items))


def parent_table(df: DataFrame, items: str) -> DataFrame:
    """The parent without its list."""
    return df.drop(items)


def child_table(df: DataFrame, keys: Sequence[str], items: str, position: str | None = None) -> DataFrame:
    """The list elements with the parent key and, when named, the position in the list.

    Scalar elements come under ``value``.
    """
    element = df.schema[items].dataType.elementType
    out = df.select(*keys, F.posexplode(items).alias(position or "_pos", "_item"))
    if not position:
        out = out.drop("_pos")
    lead = [*keys, position] if position else list(keys)
    return out.select(*lead, "_item.*") if isinstance(element, T.StructType) else out.select(*lead, F.col("_item").alias("value"))


def element_rows(df: DataFrame, keys: Sequence[str], lists: Sequence[str], position: str = "pos", name: str = "tbl") -> DataFrame:
    """The elements of several lists in one pass: keys, the list's name, the position, and a column for each list."""
    types = {c: df.schema[c].dataType.elementType for c in lists}

    def listed(column: str) -> Column:
        return F.transform(column, lambda e, i: F.struct(
            F.lit(column).alias(name), i.alias(position), *[(e if c == column else F.lit(None).cast(kind)).alias(c) for c, kind in types.items()]))

    none = T.ArrayType(T.StructType([T.StructField(name, T.StringType()), T.StructField(position, T.IntegerType()), *[T.StructField(c, k) for c, k in types.items()]]))
    return df.select(*keys, F.inline(F.concat(*[F.coalesce(listed(c), F.array().cast(none)) for c in lists])))


def child_count(items: str) -> Column:
    """Number of children; a missing list counts as 0."""
    return F.coalesce(F.size(items), F.lit(0))


def json_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Named nested columns as JSON text."""
    return df.withColumns({c: F.to_json(c, JSON_OPTIONS) for c in columns})


def child_tree(df: DataFrame, root: str, tree: Mapping[str, Sequence[tuple[str, str]]], key: str = "id",
               flat: Mapping[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
    """All tables of a nested record by a declared tree ``{table: [(list field, child table), ...]}``.

    Each child row gets ``<parent table>_<key>``; lists are left out of the tables; named structs are flattened.
    """
    out: dict[str, DataFrame] = {}

    def visit(rows: DataFrame, table: str):
        for name, child in tree.get(table, ()):
            if name not in rows.columns:
                raise ValueError(f"{table} has no list {name}")
            items = rows.select(F.col(key).alias(f"{table}_{key}"), F.explode(name).alias("_item"))
            visit(items.select(f"{table}_{key}", "_item.*"), child)
        plain = rows.drop(*[f.name for f in rows.schema.fields if isinstance(f.dataType, T.ArrayType)])
        out[table] = flatten(plain, only=(flat or {}).get(table, ()))

    visit(df, root)
    return out


def tree_rows(df: DataFrame, root: str, tree: Mapping[str, Sequence[tuple[str, str]]], key: str = "id",
              flat: Mapping[str, Sequence[str]] | None = None, name: str = "tbl") -> DataFrame:
    """The rows of all tables of :func:`child_tree` in one pass over the records: the table's name, and a struct for each
    table, of which only that table's is set. ``table_of`` takes one table out.

    List after list, the rows of the table that holds it are followed by the list's elements, so no list is built and
    none outgrows what the record holds.
    """
    kinds, tables = {root: df.schema}, [root]

    def only(holds: Column, column: str) -> Column:
        return F.when(holds, F.col(column)).alias(column)

    # _tbl: the table of a row; _r_<table>: its record; _k_<table>: the key of the record above
    rows = df.select(F.lit(root).alias("_tbl"), F.struct(*df.columns).alias(f"_r_{root}"))
    for table in tables:
        for field, child in tree.get(table, ()):
            element = kinds[child] = kinds[table][field].dataType.elementType
            own, none = F.col("_tbl") == table, F.array(F.lit(None).cast(element))
            listed = F.when(own, F.coalesce(F.concat(none, F.col(f"_r_{table}")[field]), none)).otherwise(none)
            before = [c for c in rows.columns if c != "_tbl"]
            spread = rows.select("*", F.posexplode(listed).alias("_p", "_e"))
            rows = spread.select(F.when(F.col("_p") > 0, child).otherwise(F.col("_tbl")).alias("_tbl"), *[only(F.col("_p") == 0, c) for c in before],
                                 F.when(F.col("_p") > 0, F.col("_e")).alias(f"_r_{child}"), F.when(F.col("_p") > 0, F.col(f"_r_{table}")[key]).alias(f"_k_{child}"))
            tables.append(child)

    parents = {child: t for t in tables for _, child in tree.get(t, ())}
    out = [F.col("_tbl").alias(name)]
    for table in tables:
        options = FlattenOptions(only=(flat or {}).get(table, ()))
        members = [c.alias(options.name(p)) for f in kinds[table].fields if not isinstance(f.dataType, T.ArrayType)
                   for p, c in _walk(F.col(f"_r_{table}")[f.name], f.dataType, f.name, 1, f.name, options)]
        if table != root:
            members = [F.col(f"_k_{table}").alias(f"{parents[table]}_{key}"), *members]
        out.append(F.when(F.col("_tbl") == table, F.struct(*members)).alias(table))
    return rows.select(*out)


def table_of(rows: DataFrame, table: str, name: str = "tbl") -> DataFrame:
    """One table of :func:`tree_rows`."""
    return rows.filter(F.col(name) == table).select(f"{table}.*")


def expand(df: DataFrame, table: str, navigation: str) -> tuple[str, DataFrame]:
    """Rows of an expanded list or object with every scalar of the parent; the parent wins on equal names."""
    kind = df.schema[navigation].dataType
    items = F.explode(navigation) if isinstance(kind, T.ArrayType) else F.col(navigation)
    element = kind.elementType if isinstance(kind, T.ArrayType) else kind
    scalars = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
    rows = df.select(*scalars, items.alias("_item")).filter(F.col("_item").isNotNull())
    own = [f.name for f in element.fields if f.name not in scalars]
    return f"{table}.{navigation}", rows.select(*scalars, *[F.col("_item")[n].alias(n) for n in own])


def map_rows(df: DataFrame, keys: Sequence[str], column: str, key: str = "key", value: str = "value") -> DataFrame:
    """A map of lists to (key, value) rows."""
    return df.select(*keys, F.explode(column).alias(key, "_values")).select(*keys, key, F.explode("_values").alias(value))


def named_values(items: Column, names: Sequence[str], name: str = "name", value: str = "value") -> list[Column]:
    """Columns from a list of (name, value) pairs, names compared in lower case."""

    def pick(wanted: str) -> Column:
        return F.get(F.filter(items, lambda e: F.lower(e[name]) == wanted), F.lit(0))[value].alias(wanted)

    return [pick(n) for n in names]


def wide_to_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Columns to rows; NULL values give no row; a wanted column the frame lacks is skipped."""
    have = [c for c in columns if c in df.columns]
    return df.unpivot(list(ids), have, name, value).filter(F.col(value).isNotNull())


def series_rows(df: DataFrame, keys: Sequence[str], points: str, time: str = "ts", value: str = "value") -> DataFrame:
    """A list of (time, value text) pairs to rows, the value as double."""
    rows = df.select(*keys, F.explode(points).alias("_p"))
    return rows.select(*keys, F.col("_p.t").alias(time), F.col("_p.v").try_cast("double").alias(value))


def bridge(df: DataFrame, key: str, links: str, linked: str) -> DataFrame:
    """(parent key, linked id) pairs of a link list, each pair once."""
    return df.select(key, F.explode(links).alias(linked)).filter(F.col(linked).isNotNull()).distinct()


def edges(df: DataFrame, source: Column, source_type: str, target: Column, target_type: str, relation: str,
          many: bool = False, distinct: bool = False) -> DataFrame:
    """Typed edges from a reference column, single or list; repeated references give one edge when ``distinct``."""
    ends = df.select(source.alias("_from"), (F.explode(target) if many else target).alias("_to")).filter(F.col("_to").isNotNull())
    if distinct:
        ends = ends.distinct()  # on the narrow reference pair, before any text is built
    ends = ends.select(F.col("_from").cast("string").alias("from_id"), F.col("_to").cast("string").alias("to_id"))
    return ends.select(F.concat_ws("_", "from_id", F.lit(relation), "to_id").alias("edge_id"), "from_id",
                       F.lit(source_type).alias("from_type"), "to_id", F.lit(target_type).alias("to_type"),
                       F.lit(relation).alias("relation"))
