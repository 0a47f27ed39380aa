"""Run registered queries next to their SQL and report differences.

    python -m tests.oracle --sf 0.01 [--only prefix ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import time
import traceback

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

TYPE_GROUPS = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT", "double": "DOUBLE",
    "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "binary": "BLOB",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "NaN" if value != value else repr(value)
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((repr([plain(row[i]) for i in order]) for row in rows))


def compare(df, con, sql):
    """A list of differences, empty when rows, names and types agree."""
    result = con.execute(sql)
    duck_names = [d[0] for d in result.description]
    duck_types = {d[0]: str(d[1]) for d in result.description}
    duck = result.fetchall()
    rows = [tuple(r) for r in df.collect()]
    problems = []
    if sorted(df.columns) != sorted(duck_names):
        return [f"columns {sorted(df.columns)} != {sorted(duck_names)}"]
    for field in df.schema.fields:
        want = TYPE_GROUPS.get(field.dataType.simpleString())
        if want and duck_types[field.name] != want:
            problems.append(f"type {field.name}: {field.dataType.simpleString()} != {duck_types[field.name]}")
    if len(rows) != len(duck):
        problems.append(f"rows {len(rows)} != {len(duck)}")
    left, right = rows_of(df.columns, rows), rows_of(duck_names, duck)
    if left != right:
        a, b = set(left), set(right)
        problems.append(f"only spark ({len(a - b)}): {sorted(a - b)[:2]}")
        problems.append(f"only sql   ({len(b - a)}): {sorted(b - a)[:2]}")
    return problems


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--only", nargs="*", default=[])
    parser.add_argument("--trace", action="store_true")
    args = parser.parse_args()
    from tidemark.queries import ORACLES, QUERIES
    from tidemark.session import build_session

    spark = build_session("oracle", cores="8")
    sf_dir = f"/root/testdata/sf{args.sf}"
    con = connect(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if args.only and not any(name.startswith(p) for p in args.only):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in ORACLES:
                problems = compare(df, con, ORACLES[name])
                note = "ok"
            else:
                problems, note = [], f"rows only {df.count()}"
        except Exception as error:  # noqa: BLE001 - a report, not a handler
            problems = [f"{type(error).__name__}: {str(error)[:700]}"]
            if args.trace:
                traceback.print_exc()
        bad += bool(problems)
        print(f"{name:42s} {time.time() - start:6.2f}s  {'; '.join(problems)[:1500] if problems else note}", flush=True)
    print(f"queries {len(QUERIES)}, with SQL {len(ORACLES)}, failed {bad}")


if __name__ == "__main__":
    main()
