import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.operators import columns, joins
from indicata.operators import rows as ops


def test_level_filter_is_case_sensitive_and_skips_null(spark):
    df = spark.createDataFrame([(1, "Municípios"), (2, "municípios"), (3, None)], "id int, level string")
    assert rows(ops.at_level(df, "level", "Municípios").select("id")) == [(1,)]


def test_level_and_date_filter(spark):
    midnight = dt.datetime(2010, 1, 1)
    given = [(1, "M", midnight), (2, "M", midnight.replace(hour=12)), (3, "M", dt.datetime(2009, 12, 31)), (4, "S", midnight)]
    df = spark.createDataFrame(given, "id int, level string, day timestamp_ntz")
    assert rows(ops.at_level_and_date(df, "level", "M", "day", dt.date(2010, 1, 1)).select("id")) == [(1,)]


def test_first_per_key_takes_the_smallest_ordinal(spark):
    df = spark.createDataFrame([("1", "6", 1), ("1", "5", 0), ("2", None, 0), ("2", "9", 4)], "code string, v string, ord int")
    assert rows(ops.first_per_key(df, "code", "ord")) == [("1", "5"), ("2", None)]


def test_first_per_key_agrees_with_pandas(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    data = pd.DataFrame({"code": rng.integers(0, 40, 800).astype(str), "v": rng.normal(size=800), "ord": range(800)})
    data.loc[:300, "code"] = "hot"
    wanted = data.drop_duplicates(subset=["code"])[["code", "v"]]
    found = ops.first_per_key(spark.createDataFrame(data.sample(frac=1, random_state=1)), "code", "ord")
    assert rows(found) == sorted(map(tuple, wanted.itertuples(index=False)), key=repr)


def test_drop_incomplete(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, None, "a"), (3, float("nan"), "a"), (4, 1.0, None)], "id int, v double, s string")
    assert rows(ops.drop_incomplete(df).select("id")) == [(1,)]


def test_trim_keeps_the_bound_itself(spark):
    df = spark.createDataFrame([(float(i),) for i in range(21)], "v double")
    assert ops.trim_upper(df, "v", 0.95).count() == 20
    assert ops.trim_upper(df.where("v < 0"), "v").count() == 0


def test_sort_puts_missing_last_and_uses_text_order(spark):
    df = spark.createDataFrame([("10", 1), (None, 2), ("9", 3), ("1", 4)], "code string, v int")
    assert [r[0] for r in ops.sorted_by_key(df, "code").collect()] == ["1", "10", "9", None]


def test_strict_drop_and_rename(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert columns.drop_strict(df, "a").columns == ["b"]
    with pytest.raises(columns.MissingColumns):
        columns.drop_strict(df, "c")
    assert columns.rename(df, {"a": "x", "c": "y"}).columns == ["x", "b"]


def test_reindex_adds_null_and_drops_extra(spark):
    schema = T.StructType([T.StructField("b", T.LongType()), T.StructField("z", T.DoubleType())])
    found = columns.reindex(spark.createDataFrame([(1, 2)], "a int, b int"), schema)
    assert found.schema == schema
    assert rows(found) == [(2, None)]


def test_null_keys_never_match_and_go_to_the_rejects(spark):
    left = spark.createDataFrame([("1", 1), (None, 2)], "code string, l int")
    right = spark.createDataFrame([("1", 3), (None, 4)], "code string, r int")
    assert rows(joins.fold_left([left, right], "code")) == [("1", 1, 3), (None, 2, None)]
    clean, rejects = joins.split_null_keys(left, "code")
    assert rows(clean) == [("1", 1)] and rows(rejects) == [(None, 2)]


def test_fold_multiplies_repeated_keys(spark):
    base = spark.createDataFrame([("1", 1), ("2", 1)], "code string, a int")
    twice = spark.createDataFrame([("1", 5), ("1", 6)], "code string, b int")
    assert rows(joins.fold_left([base, twice], "code")) == [("1", 1, 5), ("1", 1, 6), ("2", 1, None)]


@pytest.mark.parametrize("hot_left,hot_right", [(300, 0), (0, 300), (70, 60), (300, 1), (0, 0)])
def test_spread_join_equals_the_plain_join(spark, hot_left, hot_right):
    """Hot keys on either side or both, copies of one row, lone hot keys, null keys."""
    left = [("hot", i % 7) for i in range(hot_left)] + [("hot", 99)] + [("lone", 1)] * 80
    left += [(str(i % 50), i) for i in range(200)] + [(None, 1)] * 90
    right = [("hot", "same")] * hot_right + [(str(i), "r") for i in range(0, 100, 2)] + [(None, "n")]
    l = spark.createDataFrame(left, "code string, a int")
    r = spark.createDataFrame(right, "code string, b string")
    found = joins.left_join_spread(l, r, "code", rows_per_task=40)
    assert found.columns == ["code", "a", "b"]
    assert rows(found) == rows(l.join(r, "code", "left"))


def test_spread_join_cuts_a_hot_key_into_many_join_keys(spark):
    l = spark.range(2000).selectExpr("'hot' AS code", "id AS a")
    r = spark.createDataFrame([("hot", 1)], "code string, b int")
    dealt = joins._dealt(l.withColumn("_ls", F.lit(16)), "code", "_l", "_left_copies", "_ls", ["code", "a"])
    per_slot = [n for _, n in dealt.groupBy("_l").agg(F.sum("_left_copies")).collect()]
    assert len(per_slot) == 16 and max(per_slot) < 250
    same = spark.range(2000).selectExpr("'hot' AS code", "1 AS a")
    dealt = joins._dealt(same.withColumn("_ls", F.lit(16)), "code", "_l", "_left_copies", "_ls", ["code", "a"])
    assert [n for _, n in dealt.groupBy("_l").agg(F.sum("_left_copies")).collect()] == [125] * 16
    assert joins.left_join_spread(same, r, "code", rows_per_task=10).count() == 2000


def test_only_the_side_without_the_hot_key_is_copied(spark):
    l = spark.createDataFrame([("hot", 1)], "code string, a int")
    r = spark.range(2000).selectExpr("'hot' AS code", "id AS b")
    slots = {"_ls": F.lit(1), "_rs": F.lit(16)}
    assert joins._copied(joins._dealt(r.withColumns(slots), "code", "_r", "_n", "_rs", ["code", "b"]), "_l", "_ls").count() == 2000
    assert joins._copied(joins._dealt(l.withColumns(slots), "code", "_l", "_n", "_ls", ["code", "a"]), "_r", "_rs").count() == 16


def test_slots_follow_from_the_rows_of_a_key(spark):
    keys = [(str(k),) for k in range(300) for _ in range(5)] + [("hot",)] * 95
    hot = joins.hot_slots([spark.createDataFrame(keys, "code string"), spark.createDataFrame([("7",)] * 12, "code string")], "code", 4)
    found = {r["code"]: (r["s0"], r["s1"]) for r in hot.collect()}
    assert len(found) == 301 and found["hot"] == (24, 1) and found["7"] == (2, 3) and found["8"] == (2, 1)
    assert joins.hot_slots([spark.createDataFrame(keys, "code string")], "code", 95) is None


def test_spread_fold_of_several_tables(spark):
    tables = [
        spark.createDataFrame([("h", i) for i in range(60)] + [("g", 1), ("x", 2), (None, 3)], "code string, a int"),
        spark.createDataFrame([("h", 1), ("y", 1), ("x", 5)], "code string, b int"),
        spark.createDataFrame([("g", i % 3) for i in range(70)] + [("h", 1)], "code string, c int"),
        spark.createDataFrame([("q", 1)], "code string, d int"),
    ]
    found = joins.fold_left_spread(tables, "code", rows_per_task=40)
    assert rows(found) == rows(joins.fold_left(tables, "code"))


def test_sketches_report_every_frequent_key(spark):
    """More distinct keys than a sketch keeps: the counts are off by no more than the bound, and no frequent key is missing."""
    n = 400_000
    df = spark.range(n).selectExpr("cast(case when id % 10 < 3 then id % 30 else id end as string) AS code").repartition(5)
    (found,) = joins.key_counts([df], "code")
    off = 2.7 * n / joins.TRACKED
    wanted = {str(k): n // 30 for k in range(30) if k % 10 < 3}
    assert found.rows == n and set(wanted) <= set(found.often) and len(found.often) <= joins.OFTEN
    assert all(abs(found.often[k] - w) <= off for k, w in wanted.items())
    assert all(c <= 1 + off for k, c in found.often.items() if k not in wanted)
    assert joins.key_counts([spark.createDataFrame([(None,)], "code string"), df.where("false")], "code") == [joins.KeyCounts(0, {})] * 2
