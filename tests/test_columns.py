from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import measures as m
from ledgerloom.functions import nested as n
from ledgerloom.functions import text as t


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", function("x").alias("y")).orderBy("i").collect()]


def test_blank_to_null_trims_spaces_only(spark):
    assert apply(spark, t.blank_to_null, [" a ", "", "   ", None, "\t"]) == ["a", None, None, None, "\t"]


def test_restrict_domain(spark):
    grades = apply(spark, lambda c: t.restrict_domain(c, "abcde"), [" A", "e", "unknown", "f", None])
    assert grades == ["a", "e", None, None, None]


def test_first_label(spark):
    given = ["Foo, Bar", ", Foo", " Big\t \n Co ,x", "", None, "  "]
    assert apply(spark, t.first_label, given) == ["Foo", None, "Big Co", None, None, None]
    assert apply(spark, t.label_key, given) == ["foo", "unknown", "big co", "unknown", "unknown", "unknown"]


def test_pattern_rejects_final_newline(spark):
    codes = ["12345678", "12345678\n", "1234567", "123456789012345", "1234567a", None]
    assert apply(spark, t.matches, codes) == [True, False, False, False, False, None]


def test_unit_label(spark):
    assert apply(spark, t.unit_label, ["KJ", "kj", "MG", None]) == ["kJ", "kJ", "MG", None]


def test_missing_list(spark):
    assert apply(spark, n.is_missing_list, [None, [], ["a"]], "array<string>") == [True, True, False]


@pytest.mark.parametrize(
    "names, expected",
    [
        ([("en", "E"), ("nl", "N")], "N"),
        ([("fr", "F"), ("en", "E")], "E"),
        ([("fr", "F"), ("de", "D")], "F"),
        ([("nl", ""), ("en", "E")], ""),  # an empty text does not fall through
        ([("nl", None), ("en", "E")], "E"),
        ([], None),
        (None, None),
    ],
)
def test_pick_by_preference(spark, names, expected):
    kind = "array<struct<lang:string,text:string>>"
    assert apply(spark, lambda c: n.pick_by_preference(c, ("nl", "en")), [names], kind) == [expected]


def test_json_text_keeps_nulls(spark):
    kind = "struct<a:string,b:int>"
    assert apply(spark, n.json_text, [("x", None)], kind) == ['{"a":"x","b":null}']


def test_amounts_are_exact(spark):
    texts = ["0.30000001192092896", "1e3", "abc", "", None, "1e15"]
    expected = [Decimal("0.30000001192092896"), Decimal(1000), None, None, None, None]
    assert apply(spark, m.to_amount, texts) == expected
    assert apply(spark, m.to_amount, [0.1, 0.30000001192092896], "double") == [
        Decimal("0.1"), Decimal("0.30000001192092896"),
    ]


def test_energy_conversion_is_exact_and_case_sensitive_on_the_name(spark):
    rows = [("energy", "kcal", 10), ("energy", "KCAL", 1), ("Energy", "kcal", 10), ("energy", "kJ", 10)]
    df = spark.createDataFrame(rows, "n string, u string, v int").withColumn("v", m.to_amount("v"))
    out = df.select(m.energy_in_kj("n", "u", "v").alias("y"))
    assert out.schema["y"].dataType == m.CONVERTED
    assert [r.y for r in out.collect()] == [Decimal("41.84"), Decimal("4.184"), 10, 10]


def test_basis(spark):
    rows = [("100ml", "g"), ("100g", "ml"), (None, "CL"), ("serving", "l"), (None, None), ("serving", "g")]
    df = spark.createDataFrame(rows, "s string, u string")
    got = [r.y for r in df.select(m.nutrition_basis("s", "u").alias("y")).collect()]
    assert got == ["100ml", "100g", "100ml", "100ml", "100g", "100g"]


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    key = df.select(m.surrogate_key("a", "b")).first()[0]
    assert key == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()


def test_tolerance(spark):
    rows = [("1.0", "0.4"), ("1.0", "0.46"), ("1.0", "0.4601"), ("0.01", "0"), ("0.03", "0")]
    df = spark.createDataFrame(rows, "a string, b string").select(
        m.to_amount("a").alias("a"), m.to_amount("b").alias("b")
    )
    outside = m.outside_tolerance("a", "b", "2.5", "0.15", "0.02")
    # 1.15 is exactly on the limit of 15 %: still inside.
    assert [r.y for r in df.select(outside.alias("y")).collect()] == [False, False, True, False, True]


def test_older_than_uses_the_given_time(spark):
    as_of = dt.datetime(2024, 1, 2, 8, tzinfo=dt.timezone.utc)
    times = ["2024-01-01 06:00:00", "2024-01-01 05:59:59", None]
    old = apply(spark, lambda c: m.older_than(F.col(c).cast("timestamp"), as_of, 26), times)
    assert old == [False, True, None]


def test_epoch(spark):
    df = spark.range(1).select(m.epoch_to_timestamp(F.lit(1700000000)).cast("string"))
    assert df.first()[0] == "2023-11-14 22:13:20"
