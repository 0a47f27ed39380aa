"""Flattening, child tables, trees and edges."""

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import nested as S
from tidemark.operators import project

USERS = "user_id string, name string, orders array<struct<order_id: string, amount: double>>"


@pytest.fixture
def users(spark):
    return spark.createDataFrame([("u1", "Ann", [("o1", 1.5), ("o2", 2.0)]), ("u2", "Bob", [("o3", 3.0)]), ("u3", "Cy", []), ("u4", "Di", None)], USERS)


def test_flattened_users(users):
    flat = S.repeat_parent(users, "orders", ["user_id", "name"])
    assert flat.columns == ["user_id", "name", "order_id", "amount"]
    assert rows(flat) == [("u1", "Ann", "o1", 1.5), ("u1", "Ann", "o2", 2.0), ("u2", "Bob", "o3", 3.0)]


def test_parent_child_and_json(users):
    assert S.parent_table(users, "orders").columns == ["user_id", "name"]
    child = S.child_table(users, ["user_id"], "orders")
    assert rows(child) == [("u1", "o1", 1.5), ("u1", "o2", 2.0), ("u2", "o3", 3.0)]
    blob = {r["user_id"]: r["orders"] for r in S.json_columns(users, ["orders"]).collect()}
    assert json.loads(blob["u1"]) == [{"order_id": "o1", "amount": 1.5}, {"order_id": "o2", "amount": 2.0}]
    assert blob["u3"] == "[]" and blob["u4"] is None
    counts = rows(users.select("user_id", S.child_count("orders").alias("n")))
    assert counts == [("u1", 2), ("u2", 1), ("u3", 0), ("u4", 0)]


def test_flatten_cases(spark):
    df = spark.createDataFrame([(1, ("x", (2, None)), ["p", "q"], [])], "a int, b struct<c: string, d: struct<e: int, f: int>>, g array<string>, h array<int>")
    flat = S.flatten(df)
    assert flat.columns == ["a", "b_c", "b_d_e", "b_d_f", "g", "h"]
    assert rows(flat) == [(1, "x", 2, None, '["p","q"]', None)]
    assert rows(S.flatten(df, empty_list="[]").select("h")) == [("[]",)]
    assert rows(S.flatten(df, lists="comma").select("g")) == [("p,q",)]
    assert S.flatten(df, max_depth=1).columns == ["a", "b_c", "b_d", "g", "h"]
    assert S.flatten(df, structs="drop", lists="drop").columns == ["a"]
    assert S.flatten(df, separator=".").columns[1] == "b.c"


def test_flatten_name_clash(spark):
    df = spark.createDataFrame([(1, (2,))], "a_b int, a struct<b: int>")
    with pytest.raises(ValueError, match="a_b"):
        S.flatten(df)
    assert rows(S.flatten(df, overwrite=True)) == [(2,)]


def test_tree_keys_and_depth(spark):
    df = spark.createDataFrame(
        [(1, [(10, [(100, "s"), (101, "t")]), (11, [])]), (2, None)],
        "id int, checks array<struct<id: int, selections: array<struct<id: int, name: string>>>>")
    out = S.child_tree(df, "orders", {"orders": [("checks", "orders_check")], "orders_check": [("selections", "orders_check_selection")]})
    assert rows(out["orders"]) == [(1,), (2,)]
    assert rows(out["orders_check"].select("orders_id", "id")) == [(1, 10), (1, 11)]
    assert rows(out["orders_check_selection"].select("orders_check_id", "id", "name")) == [(10, 100, "s"), (10, 101, "t")]


def test_tree_rows_equal_the_tables_in_one_scan(spark, tmp_path):
    spark.createDataFrame(
        [(1, "a", [(10, [(100, "s"), (101, "t")]), (11, None), (12, [])]), (2, None, None), (3, "c", [])],
        "id int, name string, checks array<struct<id: int, selections: array<struct<id: int, name: string>>>>").write.parquet(str(tmp_path / "r"))
    df = spark.read.parquet(str(tmp_path / "r"))
    tree = {"orders": [("checks", "orders_check")], "orders_check": [("selections", "orders_check_selection")]}
    together = S.tree_rows(df, "orders", tree)
    for name, table in S.child_tree(df, "orders", tree).items():
        assert rows(S.table_of(together, name).select(*table.columns)) == rows(table)
    assert together._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_elements_of_several_lists(spark):
    df = spark.createDataFrame([(1, ["a", None], [(5,)]), (2, None, []), (3, [], None)], "id int, tags array<string>, marks array<struct<n: int>>")
    got = rows(S.element_rows(df, ["id"], ["tags", "marks"]).select("id", "tbl", "pos", "tags", "marks.n"))
    assert got == sorted([(1, "tags", 0, "a", None), (1, "tags", 1, None, None), (1, "marks", 0, None, 5)], key=repr)


def test_expand_parent_wins(spark):
    df = spark.createDataFrame([(1, "p", [("child", 5)]), (2, "q", None)], "id int, name string, items array<struct<name: string, n: int>>")
    name, out = S.expand(df, "orders", "items")
    assert name == "orders.items" and rows(out.select("id", "name", "n")) == [(1, "p", 5)]


def test_marked_fields_are_dropped_at_every_level(spark):
    df = spark.sql("""SELECT 1 AS id, 'e' AS `@odata.etag`, named_struct('x', 1, 'x@odata.type', 't') AS s,
                      array(named_struct('y', 2, '@odata.id', 'u', 'z', array(named_struct('w', 3, '@odata.k', 4)))) AS a""")
    out = project.drop_marked(df)
    assert out.schema.simpleString() == "struct<id:int,s:struct<x:int>,a:array<struct<y:int,z:array<struct<w:int>>>>>"


def test_edges_single_list_self(spark):
    df = spark.createDataFrame([("p1", "c1", ["a1", "a2"], "p0"), ("p2", None, None, None)], "id string, cat string, attrs array<string>, prev string")
    single = S.edges(df, F.col("id"), "product", F.col("cat"), "category", "in")
    many = S.edges(df, F.col("id"), "product", F.col("attrs"), "attribute", "has", many=True)
    own = S.edges(df, F.col("id"), "product", F.col("prev"), "product", "after")
    assert [r[0] for r in rows(single.unionByName(many).unionByName(own).select("edge_id"))] == ["p1_after_p0", "p1_has_a1", "p1_has_a2", "p1_in_c1"]


def test_flatten_stays_in_columns(users):
    plan = S.flatten(users)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
