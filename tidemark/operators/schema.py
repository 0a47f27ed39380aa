"""Types and schemas: declared, inferred, widened, grown, mapped from source catalogues."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The type names a table spec may use, and the Spark types that hold them.
DECLARED_TYPES: dict[str, T.DataType] = {
    "BOOLEAN": T.BooleanType(),
    "SHORT": T.ShortType(),
    "INT": T.IntegerType(),
    "LONG": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "NAIVE_DATE": T.DateType(),
    "NAIVE_TIME": T.StringType(),
    "NAIVE_DATETIME": T.TimestampNTZType(),
    "UTC_DATETIME": T.TimestampType(),
    "BINARY": T.BinaryType(),
    "XML": T.StringType(),
    "STRING": T.StringType(),
    "JSON": T.StringType(),
}

# Source type names per source family and the declared type each becomes.
# Decimals take precision and scale from the type text where it has them; those here are for bare names.
SOURCE_TYPES: dict[str, dict[str, str]] = {
    "sqlserver": {
        "bit": "BOOLEAN", "tinyint": "SHORT", "smallint": "SHORT", "int": "INT", "integer": "INT",
        "bigint": "LONG", "float": "FLOAT", "real": "FLOAT", "decimal": "DECIMAL(38,9)", "numeric": "DECIMAL(38,9)",
        "money": "DECIMAL(19,4)", "smallmoney": "DECIMAL(10,4)", "date": "NAIVE_DATE",
        "datetime": "NAIVE_DATETIME", "datetime2": "NAIVE_DATETIME", "smalldatetime": "NAIVE_DATETIME",
        "datetimeoffset": "UTC_DATETIME", "binary": "BINARY", "varbinary": "BINARY", "image": "BINARY", "xml": "XML",
    },
    "sybase": {
        "int": "INT", "integer": "INT", "smallint": "SHORT", "tinyint": "SHORT", "bigint": "LONG",
        "float": "DOUBLE", "real": "FLOAT", "decimal": "DECIMAL(18,0)", "numeric": "DECIMAL(18,0)",
        "money": "DECIMAL(19,4)", "smallmoney": "DECIMAL(10,4)", "date": "NAIVE_DATE", "time": "NAIVE_TIME",
        "datetime": "NAIVE_DATETIME", "smalldatetime": "NAIVE_DATETIME", "bigdatetime": "NAIVE_DATETIME",
        "bigtime": "NAIVE_TIME", "binary": "BINARY", "varbinary": "BINARY", "image": "BINARY", "bit": "BOOLEAN",
    },
    "snowflake": {
        "string": "STRING", "number": "DECIMAL(38,9)", "float": "FLOAT", "integer": "INT", "boolean": "BOOLEAN",
        "varchar": "STRING", "char": "STRING", "text": "STRING", "date": "NAIVE_DATE", "decimal": "DECIMAL(38,9)",
    },
    "redshift": {
        "date": "NAIVE_DATE", "timestamp": "NAIVE_DATETIME", "timestamp without time zone": "NAIVE_DATETIME",
        "timestamptz": "UTC_DATETIME", "timestamp with time zone": "UTC_DATETIME", "super": "JSON",
    },
    "app": {
        "string": "STRING", "integer": "INT", "float": "DOUBLE", "boolean": "BOOLEAN", "timestamp": "UTC_DATETIME",
        "datetime": "UTC_DATETIME", "interval": "INT", "color": "STRING", "user": "STRING", "imageurl": "STRING",
        "fileurl": "STRING", "machine": "STRING", "station": "STRING",
    },
    "spark": {
        "boolean": "BOOLEAN", "tinyint": "SHORT", "smallint": "SHORT", "int": "INT", "bigint": "LONG",
        "float": "FLOAT", "double": "DOUBLE", "date": "NAIVE_DATE", "timestamp_ntz": "NAIVE_DATETIME",
        "timestamp": "UTC_DATETIME", "binary": "BINARY", "string": "STRING", "variant": "JSON",
        "decimal": "DECIMAL(38,9)", "array": "JSON", "map": "JSON", "struct": "JSON",
    },
}


def declared_type(name) -> T.DataType:
    """Spark type of a declared type: a name, ``DECIMAL(p,s)`` or ``{type, precision, scale}``."""
    if isinstance(name, dict):
        return T.DecimalType(int(name.get("precision", 38)), int(name.get("scale", 9)))
    text = name.strip().upper()
    if text.startswith("DECIMAL"):
        digits = text[len("DECIMAL"):].strip("() ")
        precision, scale = (int(p) for p in digits.split(",")) if digits else (38, 9)
        return T.DecimalType(precision, scale)
    return DECLARED_TYPES[text]


def as_declared(column: Column, name, source: T.DataType) -> Column:
    """Cast to a declared type; text that does not fit becomes NULL, nested values become JSON."""
    target = declared_type(name)
    if isinstance(source, (T.StructType, T.ArrayType, T.MapType)):
        column = F.to_json(column, {"ignoreNullFields": "false"})
    elif isinstance(source, T.VariantType):
        column = F.to_json(column)
    if isinstance(target, T.BinaryType) and isinstance(source, T.StringType):
        return F.encode(column, "UTF-8")
    return column.try_cast(target) if not isinstance(target, T.StringType) else column.cast("string")


def with_declared_types(df: DataFrame, declared: dict) -> DataFrame:
    """Declared columns take their type, the others keep what the reader inferred."""
    return df.select(*[as_declared(F.col(f.name), declared[f.name], f.dataType).alias(f.name)
                       if f.name in declared else F.col(f.name) for f in df.schema.fields])


# -- widening ---------------------------------------------------------------

_NUMBERS = ["smallint", "int", "bigint", "float", "double"]


def wider(left: T.DataType, right: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both."""
    if left == right or isinstance(right, T.NullType):
        return left
    if isinstance(left, T.NullType):
        return right
    a, b = left.simpleString(), right.simpleString()
    if isinstance(left, T.DecimalType) and isinstance(right, T.DecimalType):
        scale = max(left.scale, right.scale)
        whole = max(left.precision - left.scale, right.precision - right.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    if a in _NUMBERS and b in _NUMBERS:
        pair = {a, b}
        if "float" in pair and pair & {"int", "bigint"}:
            return T.DoubleType()
        return left if _NUMBERS.index(a) > _NUMBERS.index(b) else right
    whole_digits = {"smallint": 5, "int": 10, "bigint": 19}
    for x, y in ((left, right), (right, left)):
        if isinstance(x, T.DecimalType):
            if y.simpleString() in whole_digits:
                need = max(x.precision - x.scale, whole_digits[y.simpleString()])
                return T.DecimalType(need + x.scale, x.scale) if need + x.scale <= 38 else T.StringType()
            if y.simpleString() in ("float", "double"):
                return T.DoubleType()
    if {a, b} == {"date", "timestamp_ntz"}:
        return T.TimestampNTZType()
    if {a, b} == {"date", "timestamp"} or {a, b} == {"timestamp_ntz", "timestamp"}:
        return T.TimestampType()
    return T.StringType()


def merged_schema(stored: T.StructType, incoming: T.StructType) -> tuple[T.StructType, bool]:
    """Stored columns widened, new ones appended; says whether a stored type changed."""
    widened, fields, names = False, [], set(stored.fieldNames())
    for field in stored.fields:
        kind = wider(field.dataType, incoming[field.name].dataType) if field.name in incoming.fieldNames() else field.dataType
        widened = widened or kind != field.dataType
        fields.append(T.StructField(field.name, kind, True))
    fields += [T.StructField(f.name, f.dataType, True) for f in incoming.fields if f.name not in names]
    return T.StructType(fields), widened


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame with the columns of the schema (missing ones NULL) and any further columns as they are."""
    have = set(df.columns)
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    return df.select(*[(F.col(f.name) if have and f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields], *extra)


def union_widened(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two batches of a table under the merged schema."""
    schema, _ = merged_schema(left.schema, right.schema)
    return cast_to(left, schema).unionByName(cast_to(right, schema))


def inexact_as_double(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, rows) whose whole numbers lose digits when a column widens to double, from one aggregate."""
    counts = df.agg(*[F.count_if(F.abs(F.col(c)) > F.lit(2**53)).alias(c) for c in columns])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("inexact")) for c in columns])))


def loses_as_double(c: Column, kind: T.DataType) -> Column:
    """Whether a whole or decimal number is another one after a trip through double."""
    return F.coalesce(c.cast("double").cast(kind) != c, F.lit(False))


def narrowest_type(text: Column) -> Column:
    """Name of the narrowest type that holds a text: int, bigint, double or string; NULL for NULL."""
    return (F.when(text.isNull(), F.lit(None))
            .when(text.try_cast("int").isNotNull(), F.lit("int"))
            .when(text.try_cast("bigint").isNotNull(), F.lit("bigint"))
            .when(text.try_cast("double").isNotNull(), F.lit("double"))
            .otherwise(F.lit("string")))


def inferred_types(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, type) of text columns from all their values: one aggregate row over the table, then turned."""
    names = ["int", "bigint", "double", "string"]
    rank = F.create_map(*[x for i, k in enumerate(names) for x in (F.lit(k), F.lit(i))])
    widest = df.agg(*[F.max(rank[narrowest_type(F.col(c).cast("string"))]).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.get(F.array(*map(F.lit, names)), F.col(c)).alias("type_name"))
                     for c in columns])
    return widest.select(F.inline(rows))


def infer_json(df: DataFrame, column: str) -> str:
    """Schema of all JSON texts of a column as Spark names it for variants: one aggregate, one row to the driver."""
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("s")).first()["s"]


def json_ddl(df: DataFrame, column: str) -> str:
    """The same schema as DDL, at any depth; columns without a type are text."""
    found = infer_json(df, column)
    return re.sub(r"\bVOID\b", "STRING", re.sub(r"\bOBJECT<", "STRUCT<", found))


def drop_undeclared_nulls(df: DataFrame, declared: Sequence[str]) -> DataFrame:
    """Leave out columns that are NULL in all rows unless they are declared (one aggregate row decides)."""
    open_columns = [c for c in df.columns if c not in declared]
    if not open_columns:
        return df
    counts = df.agg(*[F.max(F.col(c).isNotNull()).alias(c) for c in open_columns]).first()
    return df.select(*[c for c in df.columns if c in declared or counts[c]])


def source_type_table(spark: SparkSession) -> DataFrame:
    """The source type names as rows (family, source_type, declared_type)."""
    rows = [(family, name, kind) for family, names in SOURCE_TYPES.items() for name, kind in names.items()]
    return spark.createDataFrame(rows, "family string, source_type string, declared_type string")


def map_source_types(catalogue: DataFrame, family: str, type_column: str = "data_type") -> DataFrame:
    """Catalogue rows with the declared type of their source type; unknown types are STRING, nested ones JSON."""
    types = source_type_table(catalogue.sparkSession).filter(F.col("family") == family).drop("family")
    base = F.lower(F.trim(F.regexp_replace(F.col(type_column), r"\(.*\)|<.*>", "")))
    digits = F.regexp_extract(F.col(type_column), r"^[^<(]*\(\s*(\d+\s*(,\s*\d+)?)\s*\)", 1)
    digits = F.when(digits.contains(","), F.regexp_replace(digits, r"\s", "")).otherwise(F.concat(digits, F.lit(",0")))
    exact = F.col("source_type").isin("decimal", "numeric", "number", "dec") & F.col(type_column).rlike(r"\(\s*\d+")
    return (catalogue.withColumn("source_type", base)
            .join(types, "source_type", "left")
            .withColumn("declared_type", F.when(exact, F.concat(F.lit("DECIMAL("), digits, F.lit(")"))).otherwise(F.coalesce("declared_type", F.lit("STRING"))))
            .drop("source_type"))


def schema_json(schema: T.StructType) -> str:
    return json.dumps(schema.jsonValue(), sort_keys=True)
