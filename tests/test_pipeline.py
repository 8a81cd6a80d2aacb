import dataclasses
import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from indicata import names, storage
from indicata.operators import geometry
from indicata.plans import run as runs
from indicata.plans.analysis import analyze
from indicata.plans.charts import chart_data
from indicata.plans.gold import gold
from indicata.plans.silver import silver, silver_and_rejects
from indicata.sources.catalogue import (
    INDEX_SCHEMA,
    POLYGON_SCHEMA,
    TERRITORY_SCHEMA,
    default_sources,
    observation_schema,
)
from indicata.sources.landing import LandingZone

M = names.LEVEL_MUNICIPALITY
CODES = [str(1100 + i) for i in range(40)]


def observations(source, values, level=M):
    """Two years of a series; the other year and the other levels must not get through."""
    out = []
    for code, value in values:
        out.append((source.series, "2010-01-01", 2010, code, level, value))
        out.append((source.series, "2009-01-01", 2009, code, level, -1.0))
    out.append((source.series, "2010-01-01", 2010, "11", "Estados", -2.0))
    return out


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    """Five raw tables as they would land, once as Parquet and once as CSV."""
    root = tmp_path_factory.mktemp("landing")
    specs = {s.name: s for s in default_sources(2010)}
    gdp = [(c, 100.0 + i * 7.1234567) for i, c in enumerate(CODES)]
    revenue = [(c, 1000.0 + (i * 37) % 91 + 0.126) for i, c in enumerate(CODES[:35])]
    population = [(c, 5000.0 + i) for i, c in enumerate(CODES)]
    frames = {}
    for name, values in ((names.GDP, gdp), (names.REVENUE, revenue), (names.POPULATION, population)):
        spec = specs[name]
        given = observations(spec, values)
        if name == names.REVENUE:
            given.append((spec.series, "2010-01-01", 2010, None, M, 9.0))
        frames[name] = spark.createDataFrame(given, spec.schema).coalesce(1)
    territories = [(f"Town {c}", c, M, 1.0, "0") for c in CODES] + [("State", "11", "Estados", 1.0, "0")]
    frames[names.NAME] = spark.createDataFrame(territories, TERRITORY_SCHEMA)
    day = float((dt.date(2010, 1, 1) - dt.date(1970, 1, 1)).days)
    index = [("X", "Municipality", day, c, 0.5 + (i % 13) / 100) for i, c in enumerate(CODES[2:])]
    index += [("X", "Municipality", day - 3652, c, 0.1) for c in CODES] + [("X", "State", day, "11", 0.9)]
    index.append(("X", "Municipality", day, CODES[0], float("nan")))
    frames[names.INDEX] = spark.createDataFrame(index, INDEX_SCHEMA)
    for name, df in frames.items():
        writer = df.write.partitionBy("YEAR") if "YEAR" in df.columns else df.write
        writer.parquet(f"{root}/parquet/{specs[name].series}")
        writer = df.write.partitionBy("YEAR") if "YEAR" in df.columns else df.write
        writer.option("header", True).csv(f"{root}/csv/{specs[name].series}")
    square = [(0.0, 0.0), (0.5, 0.001), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    shape = spark.createDataFrame([([[square]],)], f"g {geometry.GEOMETRY.simpleString()}")
    shape = shape.select(geometry.to_wkb("g").alias("geometry"))
    polygons = spark.createDataFrame(
        [(float(c), f"Town {c}", "11", "RO") for c in CODES[:30]], "code_muni double, name_muni string, code_state string, abbrev_state string"
    )
    polygons.withColumn("geometry", F.lit(bytearray(shape.first()[0]))).select(POLYGON_SCHEMA.names).write.parquet(f"{root}/parquet/polygons")
    return str(root)


def test_whole_run(spark, landing, tmp_path):
    run = runs.run_all(spark, f"{landing}/parquet", str(tmp_path), table="gold_run", polygons="polygons")
    assert run.failures == {}
    table = {r["code"]: r for r in run.gold.collect()}
    assert sorted(table) == CODES
    last, first = table[CODES[-1]], table[CODES[0]]
    assert first["gdp"] == 100000.0 and first["revenue"] == 1000.13 and first["population"] == 5000
    assert first["idhm"] is None and first["data_status"] == "incomplete"
    assert first["burden"] == 1000.13 / 100000.0
    assert last["revenue"] is None and last["burden"] == 0.0 and last["name"] == f"Town {CODES[-1]}"
    assert table[CODES[5]]["data_status"] == "complete"

    stored = spark.read.parquet(f"{tmp_path}/gold")
    assert stored.columns == list(names.display_names(2010).values())
    assert [r[0] for r in spark.table("gold_run").select("CodMunIBGE").collect()] == CODES
    assert len(run.tables) == 5 and not {t.name for t in spark.catalog.listTables()} & set(run.tables)
    assert spark.read.parquet(f"{tmp_path}/silver/revenue").groupBy("state").count().count() == 2
    rejects = spark.read.parquet(f"{tmp_path}/rejects/revenue")
    assert rows(rejects) == [(None, 9.0)]
    bronze = spark.read.parquet(f"{tmp_path}/bronze/RECORRM")
    assert bronze.count() == 37 and set(bronze.columns) == {*default_sources(2010)[1].schema.names, "_ord"}

    metrics = {r["stage"]: r for r in spark.read.parquet(f"{tmp_path}/statistics/stage_metrics").collect()}
    assert metrics["silver revenue"]["rows"] == 35 and metrics["gold"]["rows"] == 40
    assert metrics["silver idhm"]["missing"] == 1 and metrics["gold"]["seconds"] > 0
    for result in ("summary", "report_correlation", "report_anova", "report_model", "chart_data"):
        assert spark.read.parquet(f"{tmp_path}/statistics/{result}").count() > 0
    served = spark.read.parquet(f"{tmp_path}/serving")
    assert served.count() == 40 and served.where("UF = 'RO'").count() == 30
    ring = served.where("UF = 'RO'").select(geometry.from_wkb("geometry")).first()[0][0][0]
    assert len(ring) == 4


def test_whole_run_of_the_first_kind(spark, landing, tmp_path):
    """CSV layers, population as base, first rows, complete rows only."""
    runs.main(["--landing", f"{landing}/csv", "--out", str(tmp_path), "--mode", "strict", "--format", "csv"])
    header = spark.read.text(f"{tmp_path}/gold").first()[0]
    assert header == ",".join(list(names.display_names(2010).values())[:-1])
    summary = spark.read.option("header", True).csv(f"{tmp_path}/statistics/summary")
    assert summary.where("variable = 'gdp' and stat = 'count'").first()["value"] == "33.0"


def test_formats_give_the_same_gold(spark, landing, tmp_path):
    found = []
    for fmt in ("parquet", "csv"):
        run = runs.Run()
        zone = LandingZone(spark, f"{landing}/{fmt}", fmt)
        silvers = runs.run_sources(zone, default_sources(2010), f"{tmp_path}/{fmt}", "label", fmt, run)
        assert run.failures == {}
        found.append(rows(gold(silvers)))
    assert found[0] == found[1]


def test_both_modes_agree_on_clean_rows(spark, landing):
    zone = LandingZone(spark, f"{landing}/parquet")
    label, strict = (
        gold({s.name: silver(zone.read(s), s, mode) for s in default_sources(2010)}, mode) for mode in ("label", "strict")
    )
    assert strict.columns == label.columns[:-1]
    complete = label.where("data_status = 'complete' and name is not null and population is not null")
    assert rows(complete.drop("data_status")) == rows(strict)
    assert strict.count() == 33


def test_asking_for_a_year_lists_one_partition(spark, landing):
    revenue = default_sources(2010)[1]
    files = LandingZone(spark, f"{landing}/parquet").read(revenue).select("_ord.file_path").distinct().collect()
    assert files and all("YEAR=2010" in r[0] for r in files)


def test_first_row_in_landing_order_wins(spark, tmp_path):
    revenue = default_sources(2010)[1]
    given = [("R", "d", 2010, "1", M, 5.0), ("R", "d", 2010, "1", M, 6.0), ("R", "d", 2010, "2", M, 7.0)]
    spark.createDataFrame(given, revenue.schema).coalesce(1).write.partitionBy("YEAR").parquet(f"{tmp_path}/RECORRM")
    raw = LandingZone(spark, str(tmp_path)).read(revenue)
    assert rows(silver(raw, revenue, "strict")) == [("1", 5.0), ("2", 7.0)]
    assert rows(silver(raw, revenue, "label")) == [("1", 5.0), ("1", 6.0), ("2", 7.0)]


def test_failing_sources_are_left_out(spark, landing, tmp_path):
    zone = LandingZone(spark, f"{landing}/parquet")
    sources = default_sources(2010)
    moved = [dataclasses.replace(s, series="absent") if s.name == names.GDP else s for s in sources]
    run = runs.Run()
    silvers = runs.run_sources(zone, moved, str(tmp_path), run=run)
    assert list(run.failures) == [names.GDP] and "absent" in run.failures[names.GDP]
    table = gold(silvers)
    # The next source is the base, and its rows are all there.
    assert table.count() == 35 and table.where("gdp is not null").count() == 0
    with pytest.raises(ValueError, match="strict mode needs every source"):
        gold(silvers, "strict")
    with pytest.raises(RuntimeError, match="no gold table"):
        runs.run_all(spark, f"{landing}/nothing_here", str(tmp_path))


def test_failure_at_run_time_is_contained_too(spark, tmp_path):
    """The value does not convert, which only shows when the rows are read."""
    spec = default_sources(2010)[1]
    text = dataclasses.replace(spec, schema=observation_schema(spec.value, StringType()))
    spark.createDataFrame([("R", "d", 2010, "1", M, "abc")], text.schema).write.partitionBy("YEAR").parquet(f"{tmp_path}/RECORRM")
    run = runs.Run()
    assert runs.run_sources(LandingZone(spark, str(tmp_path)), [text], f"{tmp_path}/out", run=run) == {}
    assert "revenue" in run.failures


def test_missing_column_is_an_error(spark):
    spec = default_sources(2010)[1]
    raw = spark.createDataFrame([("1", M, 5.0, 0)], ["TERCODIGO", "NIVNOME", "VALUE (R$)", "_ord"])
    with pytest.raises(Exception, match="missing columns"):
        silver(raw, spec)


def test_rejects_hold_the_rows_without_key(spark):
    spec = default_sources(2010)[1]
    raw = spark.createDataFrame(
        [("R", "d", 2010, None, M, 5.0, 0), ("R", "d", 2010, "1", M, 6.0, 1)],
        "CODE string, `RAW DATE` string, YEAR int, TERCODIGO string, NIVNOME string, `VALUE (R$)` double, _ord int",
    )
    clean, rejects = silver_and_rejects(raw, spec)
    assert rows(clean) == [("1", 6.0)] and rows(rejects) == [(None, 5.0)]


def test_repeated_keys_multiply_in_label_mode_only(spark, landing):
    zone = LandingZone(spark, f"{landing}/parquet")
    silvers = {s.name: silver(zone.read(s), s) for s in default_sources(2010)}
    silvers[names.REVENUE] = silvers[names.REVENUE].unionAll(silvers[names.REVENUE])
    assert gold(silvers).count() == 40 + 35
    spread = gold({n: storage.staged(t) for n, t in silvers.items()}, repeated_keys=True)
    assert rows(spread) == rows(gold(silvers))


def test_measured_write_counts_empty_and_shuffled_tables(spark, tmp_path):
    some = spark.range(100).selectExpr("if(id % 4 = 0, null, id) AS v", "id").repartition(5).orderBy("id")
    for name, df, rows_, missing in (("some", some, 100, 25), ("none", some.where("id > 1000"), 0, 0)):
        stored, metric = storage.measured_write(df, f"{tmp_path}/{name}", name)
        assert (metric.rows, metric.missing, stored.count()) == (rows_, missing, rows_)


def test_create_if_absent_keeps_the_first_rows(spark, tmp_path):
    first, second = (spark.createDataFrame([(v,)], "v int") for v in (1, 2))
    storage.create_if_absent(first, "kept", f"{tmp_path}/kept")
    assert rows(storage.create_if_absent(second, "kept", f"{tmp_path}/kept")) == [(1,)]
    assert rows(storage.overwrite_table(second, "kept", f"{tmp_path}/kept")) == [(2,)]


def test_csv_keeps_text_keys(spark, tmp_path):
    given = [("0012", None, 1.5), ("13", "Ñandú, \"x\"", None), ("14", "y", float("inf")), ("15", "z", float("-inf"))]
    df = spark.createDataFrame(given, "code string, name string, v double")
    storage.write_layer(df, f"{tmp_path}/csv", "csv")
    assert rows(storage.read_layer(spark, f"{tmp_path}/csv", df.schema, "csv")) == rows(df)
    with pytest.raises(ValueError):
        storage.write_layer(df, f"{tmp_path}/x", "orc")


def test_shared_folder_comes_from_the_session(spark):
    assert storage.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_report_and_charts_hold_together(spark, landing):
    zone = LandingZone(spark, f"{landing}/parquet")
    table = storage.staged(gold({s.name: silver(zone.read(s), s) for s in default_sources(2010)}))
    report = analyze(table)
    assert report.correlation.count() == 9 and report.anova.count() == 3
    items = {(r["item"], r["stat"]): r["value"] for r in report.model.collect()}
    assert items["model", "n"] == 38 and {t for t, _ in items} == {"Intercept", "burden", "gdp", "model"}
    assert 0 < items["model", "durbin_watson"] < 4
    with_revenue = analyze(table, predictors=("burden", "gdp", "revenue"), correlated=("idhm", "burden", "gdp", "revenue"))
    assert with_revenue.correlation.count() == 16 and with_revenue.anova.count() == 4

    charts = chart_data(table)
    sizes = {(r["chart"], r["series"]): r["n"] for r in charts.groupBy("chart", "series").agg(F.count("*").alias("n")).collect()}
    assert sizes["scatter", "idhm~burden"] == 38 and sizes["trend", "idhm~burden"] == 100
    totals = {r["series"]: r["n"] for r in charts.where("chart = 'histogram'").groupBy("series").agg(F.sum("y").alias("n")).collect()}
    assert totals == {"idhm": 38, "burden": 40, "gdp": 38, "revenue": 33}


def revenue_source():
    return next(s for s in default_sources(2010) if s.series == "RECORRM")


def failure_of(spark, folder, out, fmt="parquet"):
    run = runs.Run()
    runs.run_sources(LandingZone(spark, str(folder), fmt), [revenue_source()], str(out), fmt=fmt, run=run)
    return run.failures.get("revenue")


def observed(spark, rows_, types="CODE string, `RAW DATE` string, YEAR int, TERCODIGO string, NIVNOME string, `VALUE (R$)` double"):
    return spark.createDataFrame(rows_, types)


def test_a_missing_column_fails_the_source(spark, tmp_path):
    rows_ = observed(spark, [("R", "d", 2010, "1", M, 1.0)]).drop("VALUE (R$)")
    rows_.write.partitionBy("YEAR").parquet(f"{tmp_path}/RECORRM")
    assert "VALUE (R$)" in failure_of(spark, tmp_path, tmp_path / "out")


def test_wide_types_are_taken_as_they_come(spark, tmp_path):
    types = "CODE string, `RAW DATE` string, YEAR bigint, TERCODIGO bigint, NIVNOME string, `VALUE (R$)` bigint"
    observed(spark, [("R", "d", 2010, 7, M, 3), ("R", "d", 2009, 8, M, 4)], types).write.parquet(f"{tmp_path}/RECORRM")
    raw_rows = LandingZone(spark, str(tmp_path)).read(revenue_source())
    assert [tuple(r) for r in silver(raw_rows, revenue_source()).collect()] == [("7", 3.0)]


def test_exchanged_csv_columns_are_found_by_name(spark, tmp_path):
    folder = tmp_path / "RECORRM" / "YEAR=2010"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text(f"CODE,RAW DATE,NIVNOME,TERCODIGO,VALUE (R$)\nR,d,{M},7,2.5\n")
    raw_rows = LandingZone(spark, str(tmp_path), "csv").read(revenue_source())
    assert [tuple(r) for r in silver(raw_rows, revenue_source()).collect()] == [("7", 2.5)]


def test_a_bad_csv_number_fails_the_source_with_a_readable_cause(spark, tmp_path):
    folder = tmp_path / "RECORRM" / "YEAR=2010"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text(f"CODE,RAW DATE,TERCODIGO,NIVNOME,VALUE (R$)\nR,d,7,{M},n/a\n")
    assert "n/a" in failure_of(spark, tmp_path, tmp_path / "out", "csv")


def test_csv_layers_keep_text(spark, tmp_path):
    texts = [" x ", "a\nb", "a\r\nb", 'q"u\\n,', "", "\\", "\\s\\e", None, "\\e"]
    df = spark.createDataFrame(list(enumerate(texts)), "k bigint, t string")
    storage.write_layer(df, f"{tmp_path}/csv", "csv")
    assert rows(storage.read_layer(spark, f"{tmp_path}/csv", df.schema, "csv")) == rows(df)


def test_a_run_without_a_source_reports_what_it_can(spark, landing, tmp_path, monkeypatch):
    kept = [s for s in default_sources(2010) if s.series != "RECORRM"]
    gone = [dataclasses.replace(s, series="nowhere") for s in default_sources(2010) if s.series == "RECORRM"]
    monkeypatch.setattr(runs, "default_sources", lambda year: sorted(kept + gone, key=lambda s: s.name))
    run = runs.run_all(spark, f"{landing}/parquet", str(tmp_path))
    assert set(run.failures) == {"revenue"} and run.gold is not None
    assert run.steps["gold"] == run.steps["summary"] == "done"
    assert "o7" not in run.failures["revenue"]
    status = {(r["kind"], r["name"]) for r in spark.read.parquet(f"{tmp_path}/statistics/run_status").collect()}
    assert ("source", "revenue") in status and ("step", "analysis") in status
    assert spark.read.parquet(f"{tmp_path}/statistics/stage_metrics").count() > 0
