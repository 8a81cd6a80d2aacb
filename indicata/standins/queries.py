"""Registered queries: every operator run over the whole test tables.

Floating results that depend on the order of summation are published to a fixed
number of significant digits; a ratio that may be infinite is published as a
class and its finite value.
"""

from __future__ import annotations

import datetime as dt
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata import names, storage
from indicata.functions import (
    cast_coerce,
    cast_ignore,
    completeness,
    days_to_timestamp,
    finite_or_null,
    ratio_fill_zero,
    ratio_plain,
    round_scaled,
)
from indicata.operators import columns as columns_
from indicata.operators import geometry, joins, rows
from indicata.operators.correlation import correlation_matrix, correlation_pairs
from indicata.operators.describe import moments, quartiles
from indicata.operators.distribution import density, histogram
from indicata.operators.quantiles import exact_quantiles
from indicata.operators.regression import anova_table, coefficient_table, ols, quality_table
from indicata.operators.residuals import diagnostics, durbin_watson
from indicata.operators.trend import sampled_points, trend_band, trend_fit, trend_line
from indicata.plans import charts
from indicata.plans.analysis import CORRELATED, PREDICTORS, RESPONSE, analyze
from indicata.plans.gold import finished, gold, joined
from indicata.plans.run import run_all, run_sources, side_by_side
from indicata.plans.serving import serving
from indicata.plans.silver import silver_and_rejects
from indicata.sources.catalogue import JOIN_ORDER
from indicata.sources.landing import ORDINAL

from .tables import RING_VERTICES, YEAR, StandIns, gold_table, in_year, silvers, sources

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

TOLERANCE = 0.05
WALK_TOLERANCE = 150.0
SCATTER_POINTS = 500


Query = Callable[[SparkSession, str], DataFrame]


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        REGISTRY[name] = function
        return function

    return register


def significant(value: Column, digits: int = 9) -> Column:
    """Rounded to significant digits, by way of the decimal text that other engines print alike."""
    text = F.format_string(f"%.{digits - 1}e", value)
    return F.when(value.isNotNull(), text.cast("double") + F.lit(0.0))


def published(df: DataFrame) -> DataFrame:
    """The ratio as class and finite value."""
    value = F.col(names.BURDEN)
    kind = (
        F.when(value.isNull(), "missing")
        .when(finite_or_null(value).isNull(), "infinite")
        .when(value == 0, "zero")
        .otherwise("finite")
    )
    return df.withColumn("burden_class", kind).withColumn(names.BURDEN, finite_or_null(value))


def source(name: str):
    return next(s for s in sources() if s.name == name)


def raw_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return StandIns(spark, sf_dir).read(source(name))


def landed_source(spark: SparkSession, sf_dir: str, name: str, fmt: str = "parquet") -> DataFrame:
    """The source as the landing zone reads it from files."""
    return StandIns(spark, sf_dir).landed(source(name), fmt).read(source(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return StandIns(spark, sf_dir).table(name)


def scratch(spark: SparkSession, label: str) -> str:
    return storage.scratch_path(spark, label)


# --- sources ----------------------------------------------------------------


@query("src_series_year")
def query_src_series_year(spark, sf_dir):
    """Landed Parquet folders by year; other years are never read."""
    rows_ = landed_source(spark, sf_dir, names.REVENUE)
    return rows_.select("CODE", "YEAR", "TERCODIGO", "NIVNOME", F.col("`VALUE (R$)`").alias("value"))


@query("src_territories")
def query_src_territories(spark, sf_dir):
    return landed_source(spark, sf_dir, names.NAME).select("NAME", "ID", "LEVEL", "AREA", "CAPITAL")


@query("src_alt_shape")
def query_src_alt_shape(spark, sf_dir):
    """Landed CSV, in which everything is text; the date is a number of days."""
    rows_ = landed_source(spark, sf_dir, names.INDEX, "csv").drop(ORDINAL)
    return rows_.withColumn("value", F.col("value").cast("double"))


@query("src_polygons")
def query_src_polygons(spark, sf_dir):
    """Landed outlines in well-known binary."""
    polygons = StandIns(spark, sf_dir).landed_polygons().polygons()
    return polygons.withColumn("geometry", geometry.from_wkb(F.col("geometry"))).select(
        names.CODE,
        "UF",
        geometry.point_count(F.col("geometry")).alias("points"),
        significant(outline_area(F.col("geometry"))).alias("area"),
    )


def outline_area(shape: Column) -> Column:
    """Area of a one-ring geometry by the shoelace formula."""
    ring = shape[0][0]
    following = F.slice(ring, 2, F.size(ring) - 1)
    doubled = F.aggregate(
        F.zip_with(
            F.slice(ring, 1, F.size(ring) - 1), following, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]
        ),
        F.lit(0.0),
        lambda total, part: total + part,
    )
    return F.abs(doubled) / 2


@query("src_gold_table")
def query_src_gold_table(spark, sf_dir):
    path, name = scratch(spark, "table"), f"gold_{uuid.uuid4().hex}"
    storage.create_if_absent(gold(silvers(spark, sf_dir), ordered=False), name, path)
    return published(spark.table(name))


@query("source_catalogue")
def query_source_catalogue(spark, sf_dir):
    """The configured sources with what each holds."""
    zone, base = StandIns(spark, sf_dir), JOIN_ORDER["label"]
    parts = []
    for s in sources():
        held = zone.read(s).agg(F.count(F.lit(1)).alias("rows"), F.count(F.col(f"`{s.value}`")).alias("given"))
        parts.append(
            held.select(
                F.lit(s.name).alias("source"),
                F.lit(s.series).alias("series"),
                F.lit(base.index(s.name)).alias("join_position"),
                F.lit(s.scale).cast("double").alias("scale"),
                F.lit(s.digits).cast("int").alias("digits"),
                "rows",
                "given",
            )
        )
    return functools.reduce(DataFrame.unionByName, parts)


@query("partial_sources")
def query_partial_sources(spark, sf_dir):
    """The revenue source fails; the rest is processed and its columns stay null."""

    class OneMissing(StandIns):
        def read(self, s):
            if s.name == names.REVENUE:
                return self.spark.read.parquet(f"{self.sf_dir}/no_such_table.parquet")
            return super().read(s)

    stored = run_sources(OneMissing(spark, sf_dir), sources(), scratch(spark, "partial"))
    return published(gold(stored, ordered=False))


# --- sinks ------------------------------------------------------------------


def _round_trip(spark, sf_dir, fmt):
    """Gold written and read back, with an awkward text in every row: a document, spaces, quotes and line breaks around it."""
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").cast("string").alias(names.CODE),
        F.when(F.col("doc_id") % 7 == 0, "").when(F.col("doc_id") % 5 != 0, F.concat(F.lit(' "\\n\r\n,'), "text", F.lit("\\ \n"))).alias("note"),
    )
    table_ = gold(silvers(spark, sf_dir), ordered=False).join(texts, names.CODE, "left")
    path = scratch(spark, fmt)
    storage.write_layer(table_, path, fmt)
    return published(storage.read_layer(spark, path, table_.schema, fmt))


@query("sink_parquet_roundtrip")
def query_sink_parquet_roundtrip(spark, sf_dir):
    return _round_trip(spark, sf_dir, "parquet")


@query("sink_csv_roundtrip")
def query_sink_csv_roundtrip(spark, sf_dir):
    return _round_trip(spark, sf_dir, "csv")


@query("sink_create_if_absent")
def query_sink_create_if_absent(spark, sf_dir):
    """The table is made from silver revenue; a second save of other rows changes nothing."""
    tables = silvers(spark, sf_dir)
    path, name = scratch(spark, "table"), f"kept_{uuid.uuid4().hex}"
    storage.create_if_absent(tables[names.REVENUE], name, path)
    second = tables[names.GDP].withColumnRenamed(names.GDP, names.REVENUE)
    return storage.create_if_absent(second, name, path)


@query("sink_serving_table")
def query_sink_serving_table(spark, sf_dir):
    table_ = serving(gold_table(spark, sf_dir), StandIns(spark, sf_dir).polygons(), TOLERANCE)
    return _serving_rows(storage.staged(table_, "serving"))


def _serving_rows(served: DataFrame) -> DataFrame:
    return published(served).select(
        names.CODE,
        names.NAME,
        names.GDP,
        names.BURDEN,
        "burden_class",
        names.STATUS,
        "UF",
        geometry.point_count(F.col("geometry")).alias("points"),
        significant(outline_area(F.col("geometry"))).alias("area"),
    )


@query("stage_metrics")
def query_stage_metrics(spark, sf_dir):
    """Rows and missing values of every written layer; whether wall time was taken."""
    out = scratch(spark, "metrics")

    def write(layer):
        return storage.measured_write(layer[1], f"{out}/{layer[0]}", f"silver {layer[0]}")[1]

    metrics = side_by_side(spark, write, list(silvers(spark, sf_dir).items()))
    return storage.metrics_table(spark, metrics).select(
        "stage", "rows", "missing", (F.col("seconds") > 0).alias("timed")
    )


# --- filters and projections ------------------------------------------------


@query("filter_level")
def query_filter_level(spark, sf_dir):
    return rows.at_level(table(spark, sf_dir, "orders"), "o_orderstatus", "F").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query("filter_dim_level")
def query_filter_dim_level(spark, sf_dir):
    territories = raw_source(spark, sf_dir, names.NAME)
    return rows.at_level(territories, "LEVEL", names.LEVEL_MUNICIPALITY).select("ID", "NAME")


@query("filter_param_date")
def query_filter_param_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return rows.at_level_and_date(orders, "o_orderstatus", "F", "o_orderdate", dt.date(2000, 8, 3))


@query("filter_literal_date")
def query_filter_literal_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return orders.where("o_orderstatus = 'F' and o_orderdate = timestamp_ntz'2000-08-03'")


@query("trim_p95")
def query_trim_p95(spark, sf_dir):
    return rows.trim_upper(table(spark, sf_dir, "orders"), "o_totalprice").select("o_orderkey", "o_totalprice")


@query("drop_incomplete")
def query_drop_incomplete(spark, sf_dir):
    return rows.drop_incomplete(joined(silvers(spark, sf_dir))).select(
        names.CODE, names.NAME, names.POPULATION, names.INDEX, names.REVENUE, names.GDP
    )


@query("dedupe_first")
def query_dedupe_first(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias(names.CODE), "o_orderkey", "o_totalprice", "o_orderdate"
    )
    return rows.first_per_key(orders, names.CODE, "o_orderkey")


@query("drop_strict")
def query_drop_strict(spark, sf_dir):
    return columns_.drop_strict(table(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment")


@query("rename_cols")
def query_rename_cols(spark, sf_dir):
    """Display names; a name that is not there is passed over."""
    table_ = finished(joined(silvers(spark, sf_dir))).drop(names.BURDEN)
    return columns_.rename(table_, {**names.display_names(YEAR), "no_such_column": "x"})


@query("reindex_schema")
def query_reindex_schema(spark, sf_dir):
    """Two silver tables cut to the gold columns: the others are null."""
    tables = silvers(spark, sf_dir)
    two = joined({n: tables[n] for n in (names.GDP, names.INDEX)}).withColumn("extra", F.lit(1))
    return columns_.reindex(two, names.GOLD_SCHEMA)


# --- joins ------------------------------------------------------------------


@query("gold_join")
def query_gold_join(spark, sf_dir):
    return joined(silvers(spark, sf_dir))


@query("gold_join_strict")
def query_gold_join_strict(spark, sf_dir):
    return joined(silvers(spark, sf_dir, "strict"), "strict")


@query("geo_left_join")
def query_geo_left_join(spark, sf_dir):
    polygons = StandIns(spark, sf_dir).polygons()
    table_ = finished(joined(silvers(spark, sf_dir)))
    return geometry.join_geometry(table_, polygons, names.CODE).select(
        names.CODE, names.GDP, "UF", geometry.point_count(F.col("geometry")).alias("points")
    )


@query("join_fanout")
def query_join_fanout(spark, sf_dir):
    """Nations left-joined to their customers: repeated keys on the right multiply rows."""
    return joins.left_join_spread(*nations_and_customers(spark, sf_dir), names.CODE)


@query("join_fanout_dealt")
def query_join_fanout_dealt(spark, sf_dir):
    """The same with few rows for a task, so that every nation is dealt to several slots."""
    return joins.left_join_spread(*nations_and_customers(spark, sf_dir), names.CODE, rows_per_task=5)


@query("gold_fanout")
def query_gold_fanout(spark, sf_dir):
    """Gold from orders that are not summed: repeated keys on the right side, dealt to slots."""
    tables = silvers(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").where(in_year("o_orderdate", YEAR))
    tables[names.REVENUE] = orders.select(F.col("o_custkey").cast("string").alias(names.CODE), F.col("o_totalprice").alias(names.REVENUE))
    return published(gold(tables, ordered=False, repeated_keys=True, rows_per_task=3))


def nations_and_customers(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias(names.CODE), "n_name")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias(names.CODE), "c_custkey", "c_name"
    )
    return nations, customers


@query("join_key_cast")
def query_join_key_cast(spark, sf_dir):
    left = joins.keyed(table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("k")), "k")
    right = joins.keyed(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_name"), "k")
    return left.join(right, "k", "left").select("o_orderkey", F.col("k").alias(names.CODE), "c_name")


# --- aggregates and statistics ----------------------------------------------


@query("describe_long")
def query_describe_long(spark, sf_dir):
    table_ = gold(silvers(spark, sf_dir), ordered=False)
    summed = F.col("stat").isin("mean", "std")
    shown = F.when(summed, significant(F.col("value"))).otherwise(significant(F.col("value"), 12))
    return moments(table_, names.MEASURES).withColumn("value", shown)


@query("describe_quartiles")
def query_describe_quartiles(spark, sf_dir):
    found = quartiles(gold_table(spark, sf_dir), names.MEASURES)
    return found.withColumn("value", significant(F.col("value"), 12))


@query("quantile_95")
def query_quantile_95(spark, sf_dir):
    """The 0.95 quantile of line prices, from the whole of the largest table."""
    lines = table(spark, sf_dir, "lineitem")
    found = exact_quantiles(lines, {"l_extendedprice": [0.95], "l_quantity": [0.95]})
    pairs = [(c, float(v[0.95])) for c, v in found.items()]
    return spark.createDataFrame(pairs, "variable string, value double").withColumn(
        "value", significant(F.col("value"), 12)
    )


@query("corr_pairs")
def query_corr_pairs(spark, sf_dir):
    pairs = correlation_pairs(gold(silvers(spark, sf_dir), ordered=False), CORRELATED)
    return pairs.withColumn("r", significant(F.col("r")))


@query("corr_matrix")
def query_corr_matrix(spark, sf_dir):
    matrix = correlation_matrix(gold(silvers(spark, sf_dir), ordered=False), CORRELATED)
    return matrix.select("var_x", "var_y", significant(F.col("r")).alias("r"))


def _fit(spark, sf_dir):
    return ols(gold(silvers(spark, sf_dir), ordered=False), RESPONSE, PREDICTORS)


@query("ols_fit")
def query_ols_fit(spark, sf_dir):
    fit = _fit(spark, sf_dir)
    shown = [(fit.n, fit.intercept, *map(float, fit.slopes), fit.residual)]
    return spark.createDataFrame(shown, "n bigint, b0 double, b1 double, b2 double, rss double").select(
        "n", *[significant(F.col(c), 8).alias(c) for c in ("b0", "b1", "b2", "rss")]
    )


@query("ols_coefficients")
def query_ols_coefficients(spark, sf_dir):
    found = coefficient_table(spark, _fit(spark, sf_dir))
    rounded = [significant(F.col(c), 8).alias(c) for c in ("coef", "std_err", "t", "low", "high")]
    return found.select("term", *rounded, F.round("p_value", 8).alias("p_value"))


@query("ols_quality")
def query_ols_quality(spark, sf_dir):
    return quality_table(spark, _fit(spark, sf_dir)).withColumn("value", significant(F.col("value"), 8))


@query("residual_diagnostics")
def query_residual_diagnostics(spark, sf_dir):
    table_ = gold_table(spark, sf_dir)
    found = diagnostics(table_, ols(table_, RESPONSE, PREDICTORS))
    return spark.createDataFrame(list(found.items()), "stat string, value double").withColumn(
        "value", significant(F.col("value"), 8)
    )


@query("durbin_watson")
def query_durbin_watson(spark, sf_dir):
    table_ = gold_table(spark, sf_dir)
    found = durbin_watson(table_, ols(table_, RESPONSE, PREDICTORS), names.CODE)
    return found.select(significant(F.col("durbin_watson")).alias("durbin_watson"))


@query("condition_number")
def query_condition_number(spark, sf_dir):
    found = [(_fit(spark, sf_dir).condition_number(),)]
    return spark.createDataFrame(found, "condition_number double").select(
        significant(F.col("condition_number"), 8).alias("condition_number")
    )


@query("anova_type2")
def query_anova_type2(spark, sf_dir):
    found = anova_table(spark, _fit(spark, sf_dir))
    return found.select(
        "term",
        significant(F.col("sum_sq"), 8).alias("sum_sq"),
        "df",
        significant(F.col("f"), 8).alias("f"),
        F.round("p_value", 8).alias("p_value"),
    )


def _superfluous_fit(spark, sf_dir):
    """Predictors of which one stands twice and one is constant."""
    table_ = gold(silvers(spark, sf_dir), ordered=False).withColumns({"gdp_again": F.col(names.GDP), "level": F.lit(2.0)})
    return ols(table_, RESPONSE, [*PREDICTORS, "gdp_again", "level"])


@query("ols_superfluous")
def query_ols_superfluous(spark, sf_dir):
    found = coefficient_table(spark, _superfluous_fit(spark, sf_dir))
    rounded = [significant(F.col(c), 8).alias(c) for c in ("coef", "std_err", "t", "low", "high")]
    return found.select("term", *rounded, F.round("p_value", 8).alias("p_value"))


@query("ols_superfluous_quality")
def query_ols_superfluous_quality(spark, sf_dir):
    return quality_table(spark, _superfluous_fit(spark, sf_dir)).withColumn("value", significant(F.col("value"), 8))


@query("anova_superfluous")
def query_anova_superfluous(spark, sf_dir):
    found = anova_table(spark, _superfluous_fit(spark, sf_dir))
    return found.select("term", *[significant(F.col(c), 8).alias(c) for c in ("sum_sq", "f")], "df", F.round("p_value", 8).alias("p_value"))


@query("histogram_100")
def query_histogram_100(spark, sf_dir):
    found = histogram(gold_table(spark, sf_dir), charts.CHARTED)
    return found.select("variable", "bin", "rows")


@query("histogram_trimmed")
def query_histogram_trimmed(spark, sf_dir):
    cut = charts.trimmed(gold_table(spark, sf_dir))
    return histogram(cut, charts.TRIMMED).select("variable", "bin", "rows")


@query("kde_curve")
def query_kde_curve(spark, sf_dir):
    found = density(gold_table(spark, sf_dir), charts.CHARTED)
    return found.select(
        "variable", "position", significant(F.col("x")).alias("x"), significant(F.col("y"), 8).alias("y")
    )


@query("trend_line")
def query_trend_line(spark, sf_dir):
    found = trend_line(gold_table(spark, sf_dir), names.BURDEN, names.INDEX)
    return found.select("position", significant(F.col("x")).alias("x"), significant(F.col("y"), 8).alias("y"))


@query("trend_line_fit")
def query_trend_line_fit(spark, sf_dir):
    found = trend_fit(gold(silvers(spark, sf_dir), ordered=False), names.BURDEN, names.INDEX)
    return found.select("n", *[significant(F.col(c), 8).alias(c) for c in ("slope", "intercept", "r2", "x_min", "x_max")])


@query("trend_band")
def query_trend_band(spark, sf_dir):
    found = trend_band(gold_table(spark, sf_dir), names.BURDEN, names.INDEX, names.CODE)
    return found.select("position", *[significant(F.col(c), 8).alias(c) for c in ("x", "low", "high")])


@query("scatter_sample")
def query_scatter_sample(spark, sf_dir):
    """The bounded scatter chart: a feature of its own, the same points in every run."""
    return sampled_points(gold_table(spark, sf_dir), names.BURDEN, names.INDEX, names.CODE, SCATTER_POINTS)


@query("corr_wide")
def query_corr_wide(spark, sf_dir):
    """All pairs of 64 columns with missing values: the entries of the embeddings by thousandths."""
    entries = table(spark, sf_dir, "embeddings").selectExpr(*(f"floor(1000 * cast(embedding[{i}] as double)) AS e{i}" for i in range(RING_VERTICES)))
    columns = [f"e{i}" for i in range(RING_VERTICES)]
    some = entries.select(*(F.when(F.col(c) % 7 != 0, F.col(c)).alias(c) for c in columns))
    return correlation_pairs(some, columns).withColumn("r", significant(F.col("r")))


# --- scalars ----------------------------------------------------------------


def _revenue_and_gdp(spark, sf_dir):
    """Population as the base, so that each side of the ratio is missing somewhere."""
    tables = silvers(spark, sf_dir)
    kept = {n: tables[n] for n in (names.POPULATION, names.GDP, names.REVENUE)}
    return joins.fold_left([kept[n] for n in JOIN_ORDER["strict"] if n in kept], names.CODE)


@query("gold_sorted")
def query_gold_sorted(spark, sf_dir):
    return published(gold(silvers(spark, sf_dir)))


@query("ratio_fill_zero")
def query_ratio_fill_zero(spark, sf_dir):
    table_ = _revenue_and_gdp(spark, sf_dir)
    ratio = ratio_fill_zero(F.col(names.REVENUE), F.col(names.GDP))
    return published(table_.withColumn(names.BURDEN, ratio)).select(names.CODE, names.BURDEN, "burden_class")


@query("ratio_plain")
def query_ratio_plain(spark, sf_dir):
    table_ = _revenue_and_gdp(spark, sf_dir)
    ratio = ratio_plain(F.col(names.REVENUE), F.col(names.GDP))
    return published(table_.withColumn(names.BURDEN, ratio)).select(names.CODE, names.BURDEN, "burden_class")


@query("scale_round")
def query_scale_round(spark, sf_dir):
    """Line prices times discount, scaled by a thousand, rounded both ways."""
    lines = table(spark, sf_dir, "lineitem")
    value = F.col("l_extendedprice") * F.col("l_discount") * 1000.0
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        round_scaled(value, 2).alias("half_even"),
        round_scaled(F.col("l_extendedprice") / 8, 0).alias("half_even_whole"),
        round_scaled(F.col("l_extendedprice") / 8, 0, half_up=True).alias("half_up_whole"),
    )


@query("cast_coerce")
def query_cast_coerce(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("digit"))
    both = orders.withColumn("word", F.when(F.col("o_orderkey") % 3 == 0, "n/a").otherwise(F.col("digit")))
    return cast_coerce(cast_coerce(both, "digit", "double"), "word", "double")


@query("cast_ignore")
def query_cast_ignore(spark, sf_dir):
    """All values of one column convert and it becomes a number; the other stays text."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).alias("digit"), F.col("o_orderstatus").alias("word")
    )
    return cast_ignore(cast_ignore(orders, "digit", "double"), "word", "double")


@query("epoch_days_to_ts")
def query_epoch_days_to_ts(spark, sf_dir):
    """Order dates as a number of days with a fraction, and back."""
    orders = table(spark, sf_dir, "orders")
    days = F.datediff("o_orderdate", F.lit("1970-01-01").cast("date")) + (F.col("o_orderkey") % 4) / 4.0
    return days_to_timestamp(orders.select("o_orderkey", days.alias("date")), "date")


@query("data_status")
def query_data_status(spark, sf_dir):
    table_ = joined(silvers(spark, sf_dir))
    label = completeness(F.col(names.INDEX), F.col(names.GDP), F.col(names.REVENUE))
    return table_.select(names.CODE, label.alias(names.STATUS))


@query("simplify_polylines")
def query_simplify_polylines(spark, sf_dir):
    polygons = StandIns(spark, sf_dir).polygons()
    small = geometry.simplify(polygons.withColumn("small", F.col("geometry")), "small", TOLERANCE)
    ring = F.col("small")[0][0]
    total = F.aggregate(F.transform(ring, lambda p: p["x"] + p["y"]), F.lit(0.0), lambda a, b: a + b)
    return small.select(
        names.CODE,
        geometry.point_count(F.col("geometry")).alias("points"),
        geometry.point_count(F.col("small")).alias("kept"),
        F.round(total, 8).alias("coordinate_sum"),
        significant(outline_area(F.col("small"))).alias("area"),
    )


@query("outline_conflicts")
def query_outline_conflicts(spark, sf_dir):
    """Walks along the entries of the embeddings: the shortcuts of halving, and how many of them meet another piece."""
    sums = lambda first: f"aggregate(slice(z, 1, i + {first}), 0L, (s, v) -> s + v)"
    walk = f"transform(sequence(0, {RING_VERTICES}), i -> named_struct('x', cast({sums(1)} as double), 'y', cast({sums(9)} - {sums(1)} as double)))"
    steps = f"transform(sequence(0, {RING_VERTICES} + 8), i -> cast(floor(1000 * cast(embedding[i % {RING_VERTICES}] as double)) as bigint)) AS z"
    lines = table(spark, sf_dir, "embeddings").selectExpr("vec_id", steps)
    lines = lines.selectExpr("vec_id", f"cast(array(array({walk})) as {geometry.GEOMETRY.simpleString()}) AS line")
    drawn = geometry.drawn_outlines(lines, "line", WALK_TOLERANCE)
    met = geometry.conflicts(drawn).select("_row", "i", "j").distinct().groupBy("_row").agg(F.count(F.lit(1)).alias("n"))
    kept = F.size(F.filter("_drawn.keep", lambda k: k))
    return drawn.join(met, "_row", "left").select("vec_id", kept.alias("kept"), F.coalesce("n", F.lit(0)).alias("meeting"))


# --- composites -------------------------------------------------------------


@query("silver_series")
def query_silver_series(spark, sf_dir):
    """Landed files to silver for one source, with the rows it rejects."""
    clean, rejects = silver_and_rejects(landed_source(spark, sf_dir, names.REVENUE), source(names.REVENUE))
    rejected = rejects.select(names.CODE, names.REVENUE)
    return clean.withColumn("state", F.lit("clean")).unionByName(rejected.withColumn("state", F.lit("reject")))


@query("gold")
def query_gold(spark, sf_dir):
    return published(gold(silvers(spark, sf_dir)))


@query("gold_strict")
def query_gold_strict(spark, sf_dir):
    return published(gold(silvers(spark, sf_dir, "strict"), "strict"))


@query("report_tables")
def query_report_tables(spark, sf_dir):
    report = analyze(gold_table(spark, sf_dir))
    found = report.long()
    probability = F.col("stat").isin("p_value", "f_p_value", "jarque_bera_p", "omnibus_p")
    shown = F.when(probability, F.round("value", 8)).otherwise(significant(F.col("value"), 8))
    return found.withColumn("value", shown)


@query("serving")
def query_serving(spark, sf_dir):
    return _serving_rows(serving(finished(joined(silvers(spark, sf_dir))), StandIns(spark, sf_dir).polygons(), TOLERANCE))


@query("whole_run")
def query_whole_run(spark, sf_dir):
    """The run from landed files to the status of its steps; the territory names cannot be read."""
    standins, out = StandIns(spark, sf_dir), scratch(spark, "run")
    run = run_all(spark, standins.landed_all(spoiled=names.NAME, strays=names.REVENUE).root, out, YEAR)
    results = f"{out}/statistics"
    status = spark.read.parquet(f"{results}/run_status").select(
        F.lit("status").alias("part"), F.concat_ws(" ", "kind", "name").alias("item"), F.when(F.col("status") == "done", "done").otherwise("failed").alias(names.STATUS)
    )
    layers = spark.read.parquet(f"{results}/stage_metrics").where(F.col("stage").isin("gold", "silver revenue", "rejects revenue"))
    layers = layers.select(F.lit("rows").alias("part"), F.col("stage").alias("item"), F.col("rows").alias(names.POPULATION))
    table_ = published(run.gold).withColumnRenamed(names.CODE, "item").withColumn("part", F.lit("gold"))
    return table_.unionByName(status, allowMissingColumns=True).unionByName(layers, allowMissingColumns=True)


@query("chart_data")
def query_chart_data(spark, sf_dir):
    found = charts.chart_data(gold_table(spark, sf_dir))
    return found.select(
        "chart", "series", "x", significant(F.col("y"), 8).alias("y")
    )
