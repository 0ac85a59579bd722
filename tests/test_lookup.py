from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from lotwise.operators.lookup import fetch, hot_keys, key_digest, lookup, salted, salts, salts_of
from lotwise.operators.first_row import first_per_key, most_common

# A third of the rows has one key, another third none.
ROWS = [(i, 7 if i % 3 == 0 else None if i % 3 == 1 else i) for i in range(3000)]


@pytest.fixture
def left(spark):
    return spark.createDataFrame(ROWS, "id int, k bigint").repartition(4)


def plain(left_rows, right_rows):
    out = Counter()
    for i, k in left_rows:
        matches = [v for key, v in right_rows if k is not None and key == k]
        out.update((i, k, v) for v in matches or [None])
    return out


@pytest.mark.parametrize("hot", [[], [7], [7, 8, 11, 999999]])
def test_unique_lookup_is_a_left_join_for_any_set_of_hot_keys(shuffled_joins, left, hot):
    right_rows = [(k, f"v{k}") for k in range(0, 3000, 2)] + [(7, "v7"), (None, "nobody")]
    right = shuffled_joins.createDataFrame(right_rows, "k bigint, v string")
    got = lookup(left, right, ["k"], ["id"], hot)
    assert got.columns == ["id", "k", "v"]
    assert Counter(map(tuple, got.collect())) == plain(ROWS, right_rows)


@pytest.mark.parametrize("repeated", [[], [7], [7, 8]])
@pytest.mark.parametrize("hot", [[], [7]])
def test_repeated_right_rows_all_come_through(shuffled_joins, hot, repeated):
    rows = [(1, 7), (2, 7), (3, 8), (4, None), (5, 9), (6, 8)]
    right_rows = [(7, f"v{i}") for i in range(20)] + [(7, "same")] * 30 + [(8, "x"), (8, "x"), (None, "y"), (7, None)]
    left = shuffled_joins.createDataFrame(rows, "id int, k bigint")
    right = shuffled_joins.createDataFrame(right_rows, "k bigint, v string")
    got = lookup(left, right, ["k"], ["id"], hot, repeated)
    assert got.columns == ["id", "k", "v"]
    assert Counter(map(tuple, got.collect())) == plain(rows, right_rows)


def test_hot_and_missing_keys_are_spread(shuffled_joins, left):
    right = shuffled_joins.createDataFrame([(7, "v"), (8, "w")], "k bigint, v string")
    hot = hot_keys(left, {"k": ["k"]})["k"]
    assert hot == [7]

    def largest(df):
        return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())

    assert largest(left.join(right, "k", "left")) >= 1000
    assert largest(lookup(left, right, ["k"], ["id"], hot)) < 700


def test_several_columns_need_all_their_values(shuffled_joins):
    left = shuffled_joins.createDataFrame([(1, "a", "x"), (2, "a", None), (3, None, None)], "id int, p string, q string")
    right = shuffled_joins.createDataFrame([("a", "x", 10), ("a", None, 11)], "p string, q string, v int")
    digest = left.select(key_digest(["p", "q"]).alias("d")).filter("d is not null").first()["d"]
    for hot in ([], [digest]):
        got = {r.id: r.v for r in lookup(left, right, ["p", "q"], ["id"], hot).collect()}
        assert got == {1: 10, 2: None, 3: None}


def test_no_hot_keys_where_keys_are_even(spark):
    df = spark.range(1000).selectExpr("id as k", "cast(id % 100 as string) as s")
    assert hot_keys(df, {"k": ["k"], "s": ["s"]}) == {"k": [], "s": []}
    assert hot_keys(df.filter("k < 0"), {"k": ["k"]}) == {"k": []}


def test_first_per_key_limits_each_key_before_the_shuffle(spark):
    df = spark.range(0, 4000, 1, 4).selectExpr("case when id % 3 = 0 then 1 else id end as k", "id as v")
    first = first_per_key(df, ["k"], [F.desc("v")])
    assert first.filter("k = 1").collect()[0]["v"] == 3999
    assert first.count() == df.select("k").distinct().count()
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit", plan.index("Exchange")) > 0


def test_most_common_value_breaks_ties_by_name(spark):
    rows = [("a", "x"), ("a", "y"), ("b", "z"), ("b", "y"), ("b", "z"), (None, "q")]
    for parts in (1, 8):
        df = spark.createDataFrame(rows, "k string, v string").repartition(parts)
        got = {r.k: r.v for r in most_common(df, ["k"], "v").collect()}
        assert got == {"a": "x", "b": "z", None: "q"}


@pytest.mark.parametrize("hot", [{7: 1}, {7: 3}, {7: 16, 9: 2, 2996: 5}, {123456: 4}])
@pytest.mark.parametrize("repeated", [{}, {9: 2, 8: 7}])
def test_any_number_of_salts_gives_the_same_rows(shuffled_joins, left, hot, repeated):
    right_rows = [(k, f"v{k}") for k in range(0, 3000, 2)] + [(7, "v7")] + [(9, f"x{i % 3}") for i in range(9)]
    right = shuffled_joins.createDataFrame(right_rows, "k bigint, v string")
    got = lookup(left, right, ["k"], ["id"], hot, repeated)
    assert Counter(map(tuple, got.collect())) == plain(ROWS, right_rows)


def test_a_hot_key_is_repeated_as_often_as_it_fills_shares(shuffled_joins):
    # 8 partitions of two shares: 1/16 of 3249 rows is a share.
    keys = [1] * 1000 + [2] * 400 + [3] * 250 + [4] * 200 + list(range(100, 1499))
    df = shuffled_joins.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, k bigint")
    found = salts(df, {"k": ["k"]})["k"]
    assert found == {1: 5, 2: 2, 3: 2}
    right = shuffled_joins.createDataFrame([(k, f"v{k}") for k in range(1500)], "k bigint, v string")
    number = salts_of(F.col("k"), found)
    copies = salted(right, F.col("k"), number, F.lit(False), F.lit(1)).groupBy("k").count().filter("count > 1")
    assert {r["k"]: r["count"] for r in copies.collect()} == found
    # One salt per partition for each of the three keys would be 24 rows.
    assert salted(right, F.col("k"), number, F.lit(False), F.lit(1)).count() == 1500 + 4 + 1 + 1


def test_fetched_rows_are_the_same_for_any_salts(shuffled_joins):
    left = shuffled_joins.createDataFrame([(i, None if i % 5 == 0 else i % 7) for i in range(500)], "id int, at bigint")
    right = shuffled_joins.createDataFrame([(k, f"v{k}") for k in range(6)], "at bigint, v string")
    for n, m in ((1, 1), (3, 3), (2, 5)):
        got = fetch(left, right, "at", ["id"], F.when(F.col("at") == 3, n).otherwise(1), F.when(F.col("at") == 3, m).otherwise(1))
        assert Counter(map(tuple, got.collect())) == Counter(
            (i, k, f"v{k}" if k is not None and k < 6 else None) for i, k in ((i, None if i % 5 == 0 else i % 7) for i in range(500))
        )
