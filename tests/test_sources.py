"""Files, archives, page documents, segments, schemas, rules, streams."""

import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark.operators import enrich as E
from tidemark.operators import quality as Q
from tidemark.operators import schema as S
from tidemark.operators.changes import upserts
from tidemark.plans.run import TableSpec, plan_tables, run_specs
from tidemark.plans.store import KeyedTable
from tidemark.sources import files, tables
from tidemark.session import work_dir
from tidemark.streaming import drain as D


def test_delimited_text_stays_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n01,"x, ""y"""\n2,\n')
    df = files.read_delimited(spark, str(tmp_path))
    assert df.schema.simpleString() == "struct<id:string,note:string>"
    assert rows(df) == [("01", 'x, "y"'), ("2", None)]


def test_typed_scan_reads_only_its_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c\n1,x,2.5\n2,y,3.5\n")
    df = files.read_typed(spark, str(tmp_path), "a int, b string, c double", ["a", "c"])
    assert rows(df) == [(1, 2.5), (2, 3.5)]
    assert "ReadSchema: struct<a:int,c:double>" in df._jdf.queryExecution().executedPlan().toString()


def test_folder_gives_one_table_per_file(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a\n1\n")
    (tmp_path / "two.csv").write_text("x,y\n1,2\n3,4\n")
    (tmp_path / "skip.txt").write_text("no")
    found = files.read_folder(spark, str(tmp_path))
    assert list(found) == ["one", "two"] and found["two"].columns == ["x", "y"] and found["two"].count() == 2


def test_archives(spark, tmp_path):
    for n in (1, 2):
        with zipfile.ZipFile(tmp_path / f"e{n}.zip", "w") as z:
            z.writestr("r.csv", f' User ID ,Text\n{n},"line one\nline two"\n')
            z.writestr("note.txt", "skip")
    got = files.read_archives(spark, str(tmp_path))
    assert [(os.path.basename(r["tag"]), r["member"], r["fields"]) for r in got.orderBy("tag").collect()] == [
        (f"e{n}.zip", "r.csv", {"user_id": str(n), "text": "line one\nline two"}) for n in (1, 2)]


@pytest.mark.parametrize("document,expected", [
    ({"data": [{"a": 1}, {"a": 2}], "other": [{"b": 1}]}, [(1,), (2,)]), ({"results": [{"a": 1}], "n": 1}, [(1,)]), ({"a": 5}, [(5,)])])
def test_envelopes(spark, tmp_path, document, expected):
    (tmp_path / "p.json").write_text(json.dumps(document))
    assert rows(files.read_pages(spark, str(tmp_path), multi_line=True)) == expected


def test_each_page_chooses_its_list(spark, tmp_path):
    for i, page in enumerate(({"data": [{"a": 1}]}, {"results": [{"a": 2}, {"a": 3}], "errors": [{"e": 1}]}, {"rows": [{"a": 4, "b": 5}], "errors": []}, {"n": 1})):
        (tmp_path / f"p{i}.json").write_text(json.dumps(page))
    pages = spark.read.json(str(tmp_path))
    assert rows(files.envelope_rows(pages).select("a", "b")) == [(1, None), (2, None), (3, None), (4, 5)]
    assert files.pages_without_rows(pages).select("n").collect()[0][0] == 1


def test_surplus_cells_and_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n1,"two\nlines"\n2,b,surplus\n3,c\n')
    good, rejects = files.read_delimited_checked(spark, str(tmp_path))
    assert rows(good) == [("1", "two\nlines"), ("3", "c")] and rows(rejects) == [("2", "b", "2,b,surplus")]


def test_stream_needs_an_order_for_repeated_keys(spark, tmp_path):
    spark.createDataFrame([(1, "a-last"), (1, "z-first")], "k int, v string").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = D.file_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    table = KeyedTable(spark, work_dir(spark, "t"), ["k"], buckets=2)
    with pytest.raises(Exception, match="an order is needed"):
        D.drain(stream, table, str(tmp_path / "cp"), "s")


def test_envelope_with_named_list(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"content": [1, 2]}))
    assert rows(files.read_pages(spark, str(tmp_path), rows="content")) == [(1,), (2,)]
    with pytest.raises(ValueError, match="no list"):
        files.read_pages(spark, str(tmp_path), rows="data")


@pytest.mark.parametrize("segments", [1, 3, 4, 7])
def test_segments_are_disjoint_and_complete(spark, segments):
    df = spark.range(-5, 100).select(F.when(F.col("id") != 7, F.col("id")).alias("k"))
    parts = tables.read_segments(df, "k", 0, 90, segments)
    got = [r for p in parts for r in rows(p)]
    assert len(parts) == segments and sorted(got, key=repr) == rows(df)


def test_jdbc_options():
    o = tables.jdbc_options("jdbc:x:y", "t", fetch=500, user="u", split=("id", 0, 99, 4))
    assert o["fetchsize"] == "500" and o["numPartitions"] == "4" and o["partitionColumn"] == "id" and "password" not in o


# -- schemas -------------------------------------------------------------------


@pytest.mark.parametrize("left,right,expected", [
    ("int", "int", "int"), ("smallint", "int", "int"), ("int", "bigint", "bigint"), ("int", "float", "double"), ("bigint", "double", "double"),
    ("float", "double", "double"), ("double", "string", "string"), ("string", "double", "string"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("boolean", "int", "string"), ("int", "decimal(10,2)", "decimal(12,2)"), ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
    ("decimal(10,2)", "double", "double"), ("void", "int", "int"), ("bigint", "decimal(38,9)", "decimal(38,9)"), ("bigint", "decimal(38,25)", "string")])
def test_widening_lattice(left, right, expected):
    a, b = T._parse_datatype_string(f"c {left}")["c"].dataType, T._parse_datatype_string(f"c {right}")["c"].dataType
    assert S.wider(a, b).simpleString() == expected
    assert S.wider(b, a).simpleString() == expected


def test_declared_type_names():
    assert S.declared_type("decimal(12,3)") == T.DecimalType(12, 3)
    assert S.declared_type({"type": "DECIMAL", "precision": 9, "scale": 1}) == T.DecimalType(9, 1)
    with pytest.raises(KeyError):
        S.declared_type("NO_SUCH")


def test_source_types(spark):
    names = spark.createDataFrame([("MONEY",), ("varchar(20)",), ("weird",), (" bit ",)], "data_type string")
    got = rows(S.map_source_types(names, "sybase").select("data_type", "declared_type"))
    assert got == [(" bit ", "BOOLEAN"), ("MONEY", "DECIMAL(19,4)"), ("varchar(20)", "STRING"), ("weird", "STRING")]


def test_int_then_float_then_text(spark):
    table = KeyedTable(spark, work_dir(spark, "w"), ["id"], buckets=2)
    kinds = []
    for kind, value in (("int", 7), ("float", 7.5), ("string", "seven and a bit"), ("float", 7.25)):
        table.commit(upserts(spark.createDataFrame([(1 + len(kinds), value)], f"id int, v {kind}"), 1))
        kinds.append(table.schema()["v"].dataType.simpleString())
    assert kinds == ["int", "double", "string", "string"]
    assert rows(table.read().select("id", "v")) == [(1, "7.0"), (2, "7.5"), (3, "seven and a bit"), (4, "7.25")]


def test_plans_and_runs(spark):
    a = spark.createDataFrame([(1, "2024-01-01", "x"), (2, "2024-01-02", "y")], "id int, updated_at string, secret string").withColumn(
        "updated_at", F.col("updated_at").cast("timestamp_ntz"))
    b = spark.createDataFrame([(1,)], "n int")
    specs = [TableSpec("a", a, ["id"], exclude=["SECRET"]), TableSpec("b", b, ["n"])]
    plans = {r["table_name"]: r.asDict() for r in plan_tables(spark, specs).collect()}
    assert plans["a"] == {"table_name": "a", "columns": "id INT, updated_at NAIVE_DATETIME", "primary_key": "id", "strategy": "INCREMENTAL", "replication_key": "updated_at"}
    assert plans["b"]["strategy"] == "FULL" and plans["b"]["replication_key"] is None
    root = work_dir(spark, "runs")
    run_specs(spark, specs, root)
    later = a.withColumn("updated_at", F.when(F.col("id") == 2, F.lit("2024-02-01").cast("timestamp_ntz")).otherwise(F.col("updated_at")))
    out = run_specs(spark, [TableSpec("a", later, ["id"], exclude=["secret"])], root)
    assert out["a"].state()["mark"] == "2024-02-01 00:00:00" and out["a"].read().count() == 2
    run_specs(spark, [TableSpec("a", later.limit(0), ["id"], exclude=["secret"])], root)
    assert out["a"].state()["mark"] == "2024-02-01 00:00:00"


# -- rules -----------------------------------------------------------------------


def test_planted_errors(spark):
    good = ("17", "word", "90000000001", '{"k": [1]}', "true", "1999-12-31", "1999-12-31 23:59:58")
    spoiled = [("17x", 0, "int"), ("\t", 1, "string"), ("9e", 2, "long"), ('{"k": ', 3, "json"), ("perhaps", 4, "bool"),
               ("1999-12-3x", 5, "date"), ("1999-12-31 25h", 6, "datetime")]
    data = [(0, *good)] + [(i, *good[:at], bad, *good[at + 1:]) for i, (bad, at, _) in enumerate(spoiled, 1)]
    df = spark.createDataFrame(data, "n int, i string, s string, l string, j string, b string, d string, t string")
    c = F.col
    rules = [Q.Rule("int", Q.whole_number(c("i"))), Q.Rule("long", Q.whole_number(c("l"))), Q.Rule("bool", Q.flag_word(c("b"))),
             Q.Rule("string", Q.not_blank(c("s"))), Q.Rule("json", Q.json_text(c("j"))), Q.Rule("date", Q.date_text(c("d"))),
             Q.Rule("datetime", Q.stamp_text(c("t")))]
    checked = Q.with_reason(df, rules)
    assert rows(checked.select("n", Q.REASON)) == sorted([(0, None)] + [(i, r) for i, (_, _, r) in enumerate(spoiled, 1)], key=repr)
    assert Q.accepted(checked).count() == 1 and Q.rejected(checked).count() == 7
    with pytest.raises(ValueError, match="7 of 8"):
        Q.stop_above(checked, most=5)
    assert Q.stop_above(checked, most=7).count() == 1


# -- scoring ------------------------------------------------------------------------


@pytest.mark.parametrize("budget,expected", [(0, 0), (3, 3), (100, 8)])
def test_budget_bounds_the_scored_rows(spark, budget, expected):
    df = spark.createDataFrame([(i, "t" if i % 5 else None) for i in range(10)], "id int, text string")
    out = E.budgeted_score(df, "id", "text", lambda c: F.length(c), "score", budget)
    assert out.count() == 10 and out.filter("score is not null").count() == expected


def test_assessment_rows_skip_empty(spark):
    df = spark.createDataFrame([(1, '{"risk": "HIGH"}'), (2, "{}"), (3, "bad"), (4, None)], "id int, answer string")
    assert rows(E.assessment_rows(df, "id", "answer", "risk string", "primary")) == [(1, "primary", "HIGH")]


# -- streams -------------------------------------------------------------------------


def test_stream_picks_up_new_files_only(spark):
    path, checkpoint = work_dir(spark, "landed"), work_dir(spark, "checkpoint")
    table = KeyedTable(spark, work_dir(spark, "t"), ["k"], buckets=2)
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    for n in range(3):
        spark.createDataFrame([(n, "new"), (99, f"at {n}")], schema).write.mode("append").parquet(path)
        D.drain(D.file_stream(spark, path, schema), table, checkpoint, "s")
    assert rows(table.read()) == sorted([(0, "new", False), (1, "new", False), (2, "new", False), (99, "at 2", False)], key=repr)
    assert table.state() == {"batch": 2}


def test_last_message_of_a_key_wins_inside_a_batch(spark):
    path = work_dir(spark, "landed")
    rows_in = spark.createDataFrame([(1, 3, "c"), (1, 9, "z"), (1, 5, "x"), (2, 1, "only")], "k int, at bigint, v string").repartition(3)
    rows_in.write.parquet(path)
    table = KeyedTable(spark, work_dir(spark, "t"), ["k"], buckets=2)
    D.drain(D.file_stream(spark, path, rows_in.schema), table, work_dir(spark, "checkpoint"), "s", order=F.col("at"))
    assert rows(table.read()) == [(1, 9, "z", False), (2, 1, "only", False)]


def test_latest_row_of_a_key_wins_inside_a_run(spark):
    source = spark.createDataFrame([(1, "2024-01-02", "new"), (1, "2024-01-01", "old")], "id int, updated_at string, v string").withColumn(
        "updated_at", F.col("updated_at").cast("timestamp_ntz"))
    out = run_specs(spark, [TableSpec("s", source, ["id"])], work_dir(spark, "latest"))
    assert rows(out["s"].read().select("id", "v")) == [(1, "new")]


def test_scan_pushes_filter_and_columns(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = tables.scan(df, ["o_orderkey"], F.col("o_totalprice") > 1000)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,1000.0)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
