import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from indicata import functions as fn
from indicata.functions import tails

PAIRS = [(1, 1.0, 2.0), (2, None, 3.0), (3, None, None), (4, 0.0, 0.0), (5, 5.0, None), (6, 5.0, 0.0), (7, -5.0, 0.0)]


def ratio(spark, function):
    df = spark.createDataFrame(PAIRS, "id int, a double, b double")
    return [r[0] for r in df.orderBy("id").select(function(F.col("a"), F.col("b"))).collect()]


def test_ratio_with_one_missing_side_as_zero(spark):
    assert ratio(spark, fn.ratio_fill_zero) == [0.5, 0.0, None, None, math.inf, math.inf, -math.inf]


def test_plain_ratio(spark):
    assert ratio(spark, fn.ratio_plain) == [0.5, None, None, None, None, math.inf, -math.inf]


def test_ratio_agrees_with_pandas(spark):
    import pandas as pd

    a = pd.Series([p[1] for p in PAIRS], dtype=float)
    b = pd.Series([p[2] for p in PAIRS], dtype=float)
    wanted = [None if math.isnan(v) else v for v in a.div(b, fill_value=0)]
    assert ratio(spark, fn.ratio_fill_zero) == wanted


def test_completeness(spark):
    df = spark.createDataFrame(
        [(1, 0.5, 1.0, 2.0), (2, None, 1.0, 2.0), (3, 0.5, 0.0, 2.0)], "id int, a double, b double, c double"
    )
    found = df.orderBy("id").select(fn.completeness(F.col("a"), F.col("b"), F.col("c"))).collect()
    assert [r[0] for r in found] == ["complete", "incomplete", "incomplete"]


def test_rounding_of_ties(spark):
    df = spark.createDataFrame([(0.125, 2.5)], "a double, b double")
    even = df.select(fn.round_scaled(F.col("a"), 2), fn.round_scaled(F.col("b"), 0)).first()
    up = df.select(fn.round_scaled(F.col("a"), 2, half_up=True), fn.round_scaled(F.col("b"), 0, half_up=True)).first()
    assert tuple(even) == (0.12, 2.0)
    assert tuple(up) == (0.13, 3.0)


def test_rounding_agrees_with_numpy(spark):
    import numpy as np

    values = [float(v) for v in np.random.default_rng(1).normal(size=500) * 1e4] + [2.675, 1.005, -0.125]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = [r[0] for r in df.select(fn.round_scaled(F.col("v"), 2)).collect()]
    assert found == list(np.round(values, 2))


def test_finite_or_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (math.nan,), (math.inf,), (-math.inf,), (None,)], "v double")
    assert [r[0] for r in df.select(fn.finite_or_null(F.col("v"))).collect()] == [1.0, None, None, None, None]
    assert [r[0] for r in fn.nan_to_null(df).collect()] == [1.0, None, math.inf, -math.inf, None]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_days_to_timestamp_whatever_the_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(14610.0,), (14610.5,), (None,)], "date double")
        found = [r[0] for r in fn.days_to_timestamp(df, "date").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == [dt.datetime(2010, 1, 1), dt.datetime(2010, 1, 1, 12), None]


def test_days_to_timestamp_leaves_other_columns(spark):
    df = spark.createDataFrame([(1, "x")], "date int, other string")
    assert fn.days_to_timestamp(df, "date").schema == df.schema
    assert fn.days_to_timestamp(df, "absent").schema == df.schema


def test_cast_modes(spark):
    df = spark.createDataFrame([("1.5",), ("abc",)], "v string")
    with pytest.raises(Exception, match="cannot cast to double: abc"):
        fn.cast_strict(df, "v", "double").collect()
    assert [r[0] for r in fn.cast_coerce(df, "v", "double").collect()] == [1.5, None]
    assert [r[0] for r in fn.cast_ignore(df, "v", "double").collect()] == ["1.5", "abc"]
    good = spark.createDataFrame([("1.5",), (None,)], "v string")
    assert [r[0] for r in fn.cast_strict(good, "v", "double").collect()] == [1.5, None]
    assert [r[0] for r in fn.cast_ignore(good, "v", "double").collect()] == [1.5, None]


def test_strict_cast_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = spark.createDataFrame([("abc",)], "v string")
        with pytest.raises(Exception, match="cannot cast"):
            fn.cast_strict(df, "v", "double").collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_tails_against_known_values():
    # Textbook points of the distributions.
    assert tails.student_two_sided(2.228138851964939, 10) == pytest.approx(0.05, rel=1e-10)
    assert tails.student_quantile(10) == pytest.approx(2.2281388520, rel=1e-10)
    assert tails.student_quantile(1e9) == pytest.approx(1.959963984540054, rel=1e-8)
    assert tails.f_upper(4.102821, 2, 10) == pytest.approx(0.05, rel=1e-6)
    assert tails.student_two_sided(1.0, 1) == pytest.approx(0.5, rel=1e-12)


@pytest.mark.parametrize("df2", [5.0, 1356.0, 1e6, 1e10])
@pytest.mark.parametrize("f", [0.01, 1.0, 3.7, 40.0])
def test_f_tail_against_its_closed_form_for_two_degrees(f, df2):
    closed = math.exp(-df2 / 2.0 * math.log1p(2.0 * f / df2))
    assert tails.f_upper(f, 2.0, df2) == pytest.approx(closed, rel=1e-8 if df2 < 1e7 else 1e-6)
