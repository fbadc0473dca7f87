from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerloom.operators.matching import best_tag, small_rows, with_parent, without_parent

MAPPING = [("en:A", "one", 2), ("en:b", "two", 2), ("en:c", "three", 1), ("en:d", "four", None)]


def resolve(spark, rows, cap, mapping=MAPPING):
    products = spark.createDataFrame(rows, "k string, tags array<string>")
    table = spark.createDataFrame(mapping, "tag string, target string, priority int")
    out = best_tag(products, "k", "tags", table, tag="tag", target="target", cap=cap)
    return {r.k: (r.matched_tag, r.matched_target) for r in out.collect()}


@pytest.mark.parametrize("cap", [100, 0])
def test_lowest_priority_then_first_tag(spark, cap):
    rows = [
        ("tie", ["en:b", "EN:a"]),
        ("priority", ["en:a", "en:c", "en:b"]),
        ("case", ["EN:B"]),
        ("no_priority", ["en:d"]),
        ("no_priority_last", ["en:d", "en:b"]),
        ("none", ["x"]),
        ("empty", []),
        ("null", None),
        ("null_tag", [None, "en:b"]),
        (None, ["en:c"]),
    ]
    assert resolve(spark, rows, cap) == {
        "tie": ("en:a", "one"),
        "priority": ("en:c", "three"),
        "case": ("en:b", "two"),
        "no_priority": ("en:d", "four"),
        "no_priority_last": ("en:b", "two"),
        "none": (None, None),
        "empty": (None, None),
        "null": (None, None),
        "null_tag": ("en:b", "two"),
        None: (None, None),
    }


tags = st.lists(st.sampled_from(["a", "B", "b", "c", "d", "e"]), max_size=4)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(tags, min_size=1, max_size=6),
    st.lists(st.tuples(st.sampled_from("abcd"), st.sampled_from("xyz"), st.integers(1, 3)), max_size=6),
)
def test_both_ways_agree_with_brute_force(spark, lists, mapping):
    rows = [(str(i), t) for i, t in enumerate(lists)]
    expected = {}
    for key, given_tags in rows:
        found = [(p, t, target) for t, target, p in mapping if t in {g.lower() for g in given_tags}]
        best = min(found, default=None)
        expected[key] = (best[1], best[2]) if best else (None, None)
    assert resolve(spark, rows, 100, mapping) == expected
    assert resolve(spark, rows, 0, mapping) == expected


def test_small_rows_gives_up_above_the_cap(spark):
    assert len(small_rows(spark.range(5), 5)) == 5
    assert small_rows(spark.range(6), 5) is None


def test_resolving_in_the_plan_needs_no_shuffle(spark):
    products = spark.createDataFrame([("a", ["en:b"])], "k string, tags array<string>")
    table = spark.createDataFrame(MAPPING, "tag string, target string, priority int")
    out = best_tag(products, "k", "tags", table, tag="tag", target="target")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_parents(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "c int")
    parent = spark.createDataFrame([(1,), (1,)], "p int")
    assert with_parent(child, parent, "c", "p").collect() == [(1,)]
    assert without_parent(child, parent, "c", "p").collect() == [(2,)]
    assert without_parent(child, parent, "c", "p", null_is_orphan=True).count() == 2


def test_rows_of_one_key_keep_their_own_winner_either_way(spark):
    products = spark.createDataFrame([(1, ["a"]), (1, ["b"]), (None, ["a"])], "k int, tags array<string>")
    table = spark.createDataFrame([("a", "A", 1), ("b", "B", 2)], "tag string, target string, priority int")
    for cap in (500, 0):
        out = best_tag(products, "k", "tags", table, tag="tag", target="target", cap=cap)
        assert {(r.k, r.matched_target) for r in out.collect()} == {(1, "A"), (1, "B"), (None, None)}
