"""The whole run: landing zone to layers, statistics, chart data and serving table.

    spark-submit --py-files indicata.zip indicata/plans/run.py --landing <path> --out <path>
"""

from __future__ import annotations

import argparse
import logging
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata import names, storage
from indicata.operators.describe import describe
from indicata.operators.joins import KeyCounts, key_columns
from indicata.plans.analysis import CORRELATED, PREDICTORS, Report, analyze
from indicata.plans.charts import chart_data
from indicata.plans.gold import gold as build_gold
from indicata.plans.serving import serving_wkb
from indicata.plans.silver import CLEAN, GIVEN, STATE, silver_and_rejects, silver_states
from indicata.sources.catalogue import Source, default_sources
from indicata.sources.landing import ORDINAL, LandingZone

log = logging.getLogger(__name__)


@dataclass
class Run:
    """What a run leaves behind."""

    gold: DataFrame | None = None
    report: Report | None = None
    failures: dict[str, str] = field(default_factory=dict)  # of sources
    steps: dict[str, str] = field(default_factory=dict)  # "done", or what went wrong
    metrics: list[storage.StageMetric] = field(default_factory=list)
    counts: dict[str, KeyCounts] = field(default_factory=dict)  # of the codes of every silver table
    tables: list[str] = field(default_factory=list)  # the catalogue's names for stored silver


#: Points of the published scatter chart.
SCATTER = 10_000
#: What the data can cause; anything else is a fault of the program and ends the run.
FAILURES = (PySparkException, Py4JJavaError, ValueError, ArithmeticError)


def cause(problem: Exception) -> str:
    """The first line of what went wrong, from the innermost Java exception if there is one."""
    if isinstance(problem, Py4JJavaError):
        inner = problem.java_exception
        while inner.getCause() is not None:
            inner = inner.getCause()
        text = inner.getMessage() or inner.toString()
    else:
        text = str(problem)
    return next((line.strip() for line in text.splitlines() if line.strip()), type(problem).__name__)


def run_source(
    zone: LandingZone, source: Source, out: str, mode: str = "label", fmt: str = "parquet", tables: list[str] | None = None
) -> tuple[DataFrame, KeyCounts, list[storage.StageMetric]]:
    """Bronze, silver and rejects of one source, written; the stored silver table comes back with the counts of its codes.

    ``tables`` gets the name of the catalogue's entry that was made for it.

    A Parquet bronze layer keeps the landing position of every row, so silver
    reads that; CSV cannot hold it, and silver reads the landing files again. Clean and rejected rows are made in
    one pass and stored as parts of one table, in buckets of the code; the rejects layer is a copy of its part.
    """
    raw = zone.read(source)
    bronze = raw if fmt == "parquet" else raw.drop(ORDINAL)
    stored, bronze_metric = storage.measured_write(bronze, f"{out}/bronze/{source.series}", f"bronze {source.name}", fmt)
    raw = stored if fmt == "parquet" else raw
    if fmt != "parquet":  # text files have no buckets
        clean, rejects = silver_and_rejects(raw, source, mode)
        counts = key_columns(names.CODE)
        stored, silver_metric, seen = storage.observed_write(clean, f"{out}/silver/{source.name}", f"silver {source.name}", counts, fmt)
        _, reject_metric = storage.measured_write(rejects, f"{out}/rejects/{source.name}", f"rejects {source.name}", fmt)
        return stored, KeyCounts.of(seen), [bronze_metric, silver_metric, reject_metric]
    is_clean, value = F.col(STATE) == CLEAN, F.col(source.name)
    observed = [
        F.count_if(is_clean).alias("clean"),
        F.count_if(is_clean & value.isNull()).alias("clean_missing"),
        F.count_if(~is_clean).alias("rejects"),
        (F.count_if(~is_clean) + F.count_if(~is_clean & F.col(GIVEN).isNull())).alias("rejects_missing"),
        *key_columns(names.CODE),
    ]
    table, name, seen, seconds = storage.clustered_write(silver_states(raw, source, mode), f"{out}/silver/{source.name}", names.CODE, STATE, observed)
    if tables is not None:
        tables.append(name)
    started = time.monotonic()
    storage.write_layer(table.where(~is_clean).select(names.CODE, F.col(GIVEN).alias(source.name)), f"{out}/rejects/{source.name}")
    metrics = [
        bronze_metric,
        storage.StageMetric(f"silver {source.name}", seen["clean"], seen["clean_missing"], seconds),
        storage.StageMetric(f"rejects {source.name}", seen["rejects"], seen["rejects_missing"], time.monotonic() - started),
    ]
    return table.where(is_clean).select(names.CODE, source.name), KeyCounts.of(seen), metrics


def side_by_side(spark: SparkSession, work: Callable, items: Sequence) -> list:
    """Results of ``work`` per item, with the items' jobs submitted at the same time."""
    with ThreadPoolExecutor(max_workers=max(len(items), 1)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))


def run_sources(
    zone: LandingZone, sources: list[Source], out: str, mode: str = "label", fmt: str = "parquet", run: Run | None = None
) -> dict[str, DataFrame]:
    """Every source that could be processed; a failing one is logged and left out.

    The sources are independent, so their jobs are submitted side by side and
    share the cluster. Spark is lazy: the guard is around the writes.
    """
    run = run if run is not None else Run()
    spark = zone.spark

    def attempt(source: Source):
        try:
            return run_source(zone, source, out, mode, fmt, run.tables)
        except FAILURES as problem:
            log.error("source %s failed: %s", source.name, cause(problem))
            return problem

    silvers = {}
    for source, outcome in zip(sources, side_by_side(spark, attempt, sources)):
        if isinstance(outcome, Exception):
            run.failures[source.name] = cause(outcome)
        else:
            silvers[source.name], run.counts[source.name], metrics = outcome
            run.metrics += metrics
    return silvers


def run_all(
    spark: SparkSession,
    landing: str,
    out: str,
    year: int = 2010,
    mode: str = "label",
    fmt: str = "parquet",
    table: str | None = None,
    polygons: str | None = None,
    predictors: Sequence[str] = PREDICTORS,
    correlated: Sequence[str] = CORRELATED,
    scatter: int | None = SCATTER,
) -> Run:
    """Process everything; a step that fails is named in ``steps`` and the others go on.

    The step status and the stage metrics are written in any case. Without a gold table the run fails after that.
    """
    run = Run()
    zone = LandingZone(spark, landing, fmt)
    silvers = run_sources(zone, default_sources(year), out, mode, fmt, run)
    results = f"{out}/statistics"

    def make_gold() -> None:
        shown = names.to_display(build_gold(silvers, mode, counts=run.counts), year)
        stored, metric = storage.measured_write(shown, f"{out}/gold", "gold", fmt)
        run.metrics.append(metric)
        run.gold = names.from_display(stored, year)
        if table is not None:
            storage.create_if_absent(stored, table, f"{out}/tables/{table}")

    def make_report() -> None:
        run.report = analyze(run.gold, predictors=predictors, correlated=correlated)
        for name, result in run.report.tables().items():
            storage.write_layer(result, f"{results}/{name}")

    def make_serving() -> None:
        run.metrics.append(serve(run.gold, zone, polygons, f"{out}/serving", year))

    try:
        attempt(run, "gold", make_gold)
        if run.gold is None:
            raise RuntimeError(f"no gold table: {run.steps['gold']}; failed sources: {run.failures}")
        attempt(run, "summary", lambda: storage.write_layer(describe(run.gold, names.MEASURES), f"{results}/summary", fmt))
        attempt(run, "analysis", make_report)
        attempt(run, "charts", lambda: storage.write_layer(chart_data(run.gold, scatter=scatter), f"{results}/chart_data"))
        if polygons is not None:
            attempt(run, "serving", make_serving)
    finally:
        storage.write_layer(storage.metrics_table(spark, run.metrics), f"{results}/stage_metrics")
        storage.write_layer(status_table(spark, run), f"{results}/run_status")
        for name in run.tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return run


def attempt(run: Run, step: str, work: Callable[[], None]) -> None:
    try:
        work()
        run.steps[step] = "done"
    except FAILURES as problem:
        run.steps[step] = cause(problem)
        log.error("step %s failed: %s", step, run.steps[step])


def status_table(spark: SparkSession, run: Run) -> DataFrame:
    """``kind, name, status`` of every failed source and every step."""
    rows = [("source", n, t) for n, t in run.failures.items()] + [("step", n, t) for n, t in run.steps.items()]
    return spark.createDataFrame(rows, "kind string, name string, status string")


def serve(gold: DataFrame, zone: LandingZone, polygons: str, path: str, year: int) -> storage.StageMetric:
    """Write the serving table of a gold table; also a step of its own, from a table in the catalogue."""
    served = serving_wkb(gold, zone.polygons(polygons))
    return storage.measured_write(names.to_display(served, year), path, "serving")[1]


def main(argv: list[str] | None = None) -> None:
    arguments = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    arguments.add_argument("--landing", required=True)
    arguments.add_argument("--out", required=True)
    arguments.add_argument("--year", type=int, default=2010)
    arguments.add_argument("--mode", choices=("label", "strict"), default="label")
    arguments.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    arguments.add_argument("--table", help="also save gold as this table unless it exists")
    arguments.add_argument("--polygons", help="series of the territory polygons")
    arguments.add_argument("--serve", action="store_true", help="only make the serving table, from --table and --polygons")
    arguments.add_argument("--predictors", nargs="+", default=list(PREDICTORS), choices=names.MEASURES)
    arguments.add_argument("--correlated", nargs="+", default=list(CORRELATED), choices=names.MEASURES)
    arguments.add_argument("--scatter", type=int, default=SCATTER, help="points of the scatter chart; 0 for all")
    given = arguments.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("indicata").getOrCreate()
    if given.serve:
        if not (given.table and given.polygons):
            arguments.error("--serve needs --table and --polygons")
        gold = names.from_display(spark.table(given.table), given.year)
        serve(gold, LandingZone(spark, given.landing, given.format), given.polygons, f"{given.out}/serving", given.year)
        return
    run = run_all(
        spark, given.landing, given.out, given.year, given.mode, given.format, given.table, given.polygons,
        given.predictors, given.correlated, given.scatter or None,
    )
    for name, problem in run.failures.items():
        log.warning("left out: %s (%s)", name, problem)
    if any(status != "done" for status in run.steps.values()):
        raise SystemExit(1)


if __name__ == "__main__":
    main()
