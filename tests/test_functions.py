"""Conversions, text rules, keys and values on small rows."""

import hashlib
import json
import random
import struct

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import convert as V
from tidemark.functions import keys as K
from tidemark.functions import text as X
from tidemark.functions import values as N


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(fn(F.col("c")).alias("r")).first()["r"]


def test_golden_row_hashes(spark):
    """Published hashes of five rows; in the last one the email key is absent."""
    golden = {
        1: "9507eb591ddb60eb68452d06cf70696d8d5e8140", 2: "7d09ec9c2cfa02549a329a36fcd0221b1ea020ab", 3: "f01ca16d545bf1af5a8bbce87acc622101e1a992",
        4: "a211fe507efd31c94e30e91fc8883b4a68605d3d", 5: "aa1f248cbe6e71e1f36db2f09c5b68a2fbe3febb"}
    df = spark.createDataFrame([
        (1, "John", "Doe", "john.doe@example.com", "2007-12-03T10:15:30Z"), (2, "John", "Doe", "john.doe@example.com", "2008-02-13T03:30:50Z"),
        (3, "John", "Doe", None, "2008-02-13T03:30:50Z"), (4, "Joe", "Smith", None, "2014-05-10T00:00:30Z"), (5, "Jane", "Dalton", None, None)],
        "n int, first_name string, last_name string, email string, updated_at string")
    columns = ["first_name", "last_name", "email", "updated_at"]
    got = df.select("n", K.row_hash(df, columns, {"email": F.col("n") != 5}).alias("h"))
    assert {r["n"]: r["h"] for r in got.collect()} == golden


def test_row_json_equals_python(spark):
    texts = ["plain", 'quo"te', "back\\slash", "line\nend\ttab\r", "ümläut ß", "emoji 😀 end", "\x01\x1f\x7f", "", "日本語", "a/b"]
    df = spark.createDataFrame([(i, s, i % 2 == 0, None) for i, s in enumerate(texts)], "n bigint, s string, b boolean, z string")
    got = df.select("n", K.row_json(df.schema, ["n", "s", "b", "z"]).alias("j")).collect()
    for r in got:
        expected = {"n": r["n"], "s": texts[r["n"]], "b": r["n"] % 2 == 0, "z": None}
        assert r["j"] == json.dumps(expected, sort_keys=True)


def test_float_text_equals_python(spark):
    rng = random.Random(2)
    values = [0.0, 1.0, -2.5, 100.0, 1e7, 12345678.25, 1e15, 1e16, 1.5e16, 1e-3, 1e-4, 1.5e-5, 1e22, 1e100, 0.1, 1234567.891, 98765432.1]
    values += [round(rng.uniform(-1e6, 1e6), 2) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", K.float_text(F.col("v")).alias("t")).collect():
        assert r["t"] == repr(r["v"])
    assert one(spark, float("nan"), K.float_text, "double") == "NaN"


@pytest.mark.parametrize("text,expected", [
    ("[1,2]", [1.0, 2.0]), ("1, 2", [1.0, 2.0]), ('["1","2"]', [1.0, 2.0]), ("['1.5', '2']", [1.5, 2.0]), ("", []), ("[]", []),
    ("[1,x]", None), (None, None), (" [ 1 , 2 ] ", [1.0, 2.0]), ("1,,2", [1.0, 2.0])])
def test_vector_text(spark, text, expected):
    assert one(spark, text, N.vector) == expected


@pytest.mark.parametrize("text,expected", [
    ("$1,234.50", 1234.5), ("1,234", 1.234), ("EUR -12.00", -12.0), ("1.000.000,25", 1000000.25), ("none", None), (None, None)])
def test_number_from_text(spark, text, expected):
    assert one(spark, text, V.number_from_text) == expected


@pytest.mark.parametrize("text,expected", [("304b", None), (" 12 ", 12), ("4.0", None), ("", None), (None, None), ("-7", -7)])
def test_lenient_int(spark, text, expected):
    assert one(spark, text, V.lenient_int) == expected


def test_flag_text_is_strict_by_default(spark):
    assert one(spark, " True ", V.flag_from_text) is True
    assert one(spark, "<YOUR_FLAG>", V.flag_from_text) is False
    assert one(spark, None, lambda c: V.flag_from_text(c, default=True)) is True
    with pytest.raises(PySparkException, match="not a flag"):
        one(spark, "maybe", V.flag_from_text)


@pytest.mark.parametrize("text,expected", [
    ("2024-01-01T10:00:00Z", "2024-01-01T10:00:00Z"), ("2024-01-01T10:00:00+02:00", "2024-01-01T08:00:00Z"),
    ("1704103200", "2024-01-01T10:00:00Z"), ("bad", None), ("Tbad", None), (None, None)])
def test_lenient_date(spark, text, expected):
    assert one(spark, text, V.lenient_date) == expected


def test_sections_and_defaults(spark):
    report = "start\nWeather note: Frost in the north.\nStations: ST-07, ST-02, ST-07\nLevels by place:\n- Valley: LOW (wet)\n"
    got = one(spark, report, lambda c: X.section(c, "WEATHER NOTE", "STATIONS", F.lit("none")))
    assert got == "Frost in the north."
    assert one(spark, report, lambda c: X.section(c, "ADVICE", "END", F.lit("none"))) == "none"
    assert one(spark, report, lambda c: X.distinct_ids(c, r"ST-\d{2}")) == ["ST-02", "ST-07"]
    levels = one(spark, report, lambda c: X.line_map(X.section(c, "LEVELS BY PLACE", "ADVICE", F.lit(""), 300)))
    assert [tuple(p) for p in levels] == [("Valley", "LOW")]
    long = "Weather note: " + "x" * 2000
    assert one(spark, long, lambda c: X.section(c, "weather note", "stations", F.lit(""))) == "x" * 2000
    assert one(spark, long, lambda c: X.section(c, "weather note", "stations", F.lit(""), open_length=500)) == "x" * 499
    assert one(spark, long, lambda c: X.section(c, "weather note", None, F.lit(""), longest=10)) == "x" * 10


def test_money_that_does_not_fit(spark):
    assert str(one(spark, "12.50", lambda c: V.money(c))) == "12.50"
    with pytest.raises(Exception, match="does not fit"):
        one(spark, "12.505", lambda c: V.money(c))


def test_mapping_last_duplicate_wins(spark):
    df = spark.createDataFrame([("50001:F1,F2|bad|60001:F3|50001:F9",)], "m string")
    assert rows(X.mapping_rows(df, "m").select("key", "values")) == [("50001", ["F9"]), ("60001", ["F3"])]


@pytest.mark.parametrize("label,ident,expected", [
    ("Customer Name", "rqoqm", "customer_name__rqoqm"), ("2nd unit", "Ab", "field_2nd_unit__ab"), ("", "x1", "x1__x1"), (None, "9z", "field_9z__9z"),
    ("--!!--", "q", "q__q"), ("a  -- b", "k-1", "a_b__k1")])
def test_labelled_names(spark, label, ident, expected):
    df = spark.createDataFrame([(label, ident)], "l string, i string")
    assert df.select(X.labelled_name(F.col("l"), F.col("i"))).first()[0] == expected


def test_payload_kinds(spark):
    assert json.loads(one(spark, bytearray(b'{"a": 1}'), N.payload, "binary")) == {"a": 1}
    assert json.loads(one(spark, bytearray("grüße".encode()), N.payload, "binary")) == {"raw_data": "grüße"}
    assert json.loads(one(spark, bytearray(b"\xff\xfe"), N.payload, "binary")) == {"raw_data_base64": "//4="}


def test_json_in_text(spark):
    assert json.loads(one(spark, 'Sure:\n```json\n{"a": {"b": 1}}\n```', N.json_inside)) == {"a": {"b": 1}}
    assert one(spark, "no json", N.json_inside) is None
    assert one(spark, "{bad}", N.json_inside) is None


def test_series_id_ignores_label_order(spark):
    df = spark.createDataFrame([(1,)], "n int")
    a = F.create_map(F.lit("job"), F.lit("x"), F.lit("az"), F.lit("y"))
    b = F.create_map(F.lit("az"), F.lit("y"), F.lit("job"), F.lit("x"))
    got = df.select(K.series_id(F.lit("up"), a).alias("a"), K.series_id(F.lit("up"), b).alias("b")).first()
    assert got["a"] == got["b"] == hashlib.md5(b"up{az=y,job=x}").hexdigest()


def test_double_bits_survive_json_of_floats(spark):
    value = struct.unpack(">d", bytes.fromhex("3fb999999999999a"))[0]
    assert float(one(spark, value, K.float_text, "double")) == value
