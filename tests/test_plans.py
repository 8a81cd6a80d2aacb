"""What the physical plans must look like for tables that no task can hold."""

import re

import pytest
from conftest import SF

from indicata import names
from indicata.operators.regression import ols
from indicata.plans.gold import finished, gold, joined
from indicata.plans.run import Run, run_sources
from indicata.plans.silver import silver_and_rejects, silver_states
from indicata.standins.queries import REGISTRY
from indicata.standins.tables import StandIns, gold_table, silvers, sources


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_reuse_the_partitioning_of_the_aggregates(spark, no_broadcast):
    text = plan(finished(joined(silvers(spark, SF))))
    exchanges = re.findall(r"Exchange (\w+)\(([^,]*)", text)
    # lineitem and orders by order; gdp, revenue and population by code; names and index by code.
    assert len(exchanges) == 7 and all(kind == "hashpartitioning" for kind, _ in exchanges)
    assert text.count("SortMergeJoin") == 5
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_strict_mode_adds_no_shuffle(spark, no_broadcast):
    text = plan(finished(joined(silvers(spark, SF, "strict"), "strict"), "strict"))
    assert len(re.findall(r"Exchange hashpartitioning", text)) <= 7
    assert "SinglePartition" not in text


def test_year_and_columns_reach_the_scan(spark):
    text = plan(silvers(spark, SF)[names.GDP])
    scan = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    assert "GreaterThanOrEqual(l_shipdate" in scan and "LessThan(l_shipdate" in scan
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in scan


def test_sums_are_combined_before_the_shuffle(spark):
    text = plan(silvers(spark, SF)[names.REVENUE])
    assert text.index("HashAggregate") < text.index("Exchange") < text.rindex("HashAggregate")
    assert "partial_sum" in text


def test_durbin_watson_sorts_ranges_not_one_partition(spark):
    from indicata.operators.residuals import durbin_watson

    table = gold_table(spark, SF)
    text = plan(durbin_watson(table, ols(table, "idhm", ["burden", "gdp"]), names.CODE))
    below = text[text.index("MapInArrow"):]
    assert "rangepartitioning" in below and "SinglePartition" not in below


def test_no_registered_query_forces_a_broadcast_of_a_table(spark, no_broadcast):
    for name in ("gold", "gold_strict", "geo_left_join", "join_key_cast", "serving"):
        assert "Broadcast" not in plan(REGISTRY[name](spark, SF)), name


def test_stored_silver_joins_without_a_shuffle(spark, no_broadcast, tmp_path):
    run = Run()
    stored = run_sources(StandIns(spark, SF), sources(), str(tmp_path), run=run)
    text = plan(gold(stored, ordered=False, counts=run.counts))
    assert "Exchange" not in text and text.count("SortMergeJoin") == 4
    ordered = plan(gold(stored, counts=run.counts))
    assert len(re.findall("Exchange", ordered)) == 1 and "Exchange rangepartitioning" in ordered


def test_silver_and_rejects_read_bronze_once(spark, tmp_path):
    """The write of the joint table scans the raw rows in one place."""
    zone = StandIns(spark, SF).landed_all(strays=names.REVENUE)
    revenue = next(s for s in sources() if s.name == names.REVENUE)
    for mode in ("label", "strict"):
        assert plan(silver_states(zone.read(revenue), revenue, mode)).count("FileScan") == 1
        states = {r["state"]: r["count"] for r in silver_states(zone.read(revenue), revenue, mode).groupBy("state").count().collect()}
        clean, rejects = silver_and_rejects(zone.read(revenue), revenue, mode)
        assert states == {"clean": clean.count(), "reject": rejects.count()} and states["reject"] == 5


def test_polygons_are_simplified_below_the_join(spark, no_broadcast):
    text = plan(REGISTRY["serving"](spark, SF))
    assert text.index("SortMergeJoin") < text.index("ArrowEvalPython")


def test_standin_polygons_are_closed(spark):
    ring = StandIns(spark, SF).polygons().selectExpr("geometry[0][0] AS r")
    assert ring.where("r[0] <> r[64] or size(r) <> 65").count() == 0
