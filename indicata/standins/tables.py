"""Raw source tables derived from the test tables, in the providers' shapes.

``StandIns`` offers what ``LandingZone`` offers, so every plan runs on either.
Sums go through DECIMAL, which makes them independent of the order of rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata import names, storage
from indicata.operators.geometry import GEOMETRY, to_wkb
from indicata.plans.gold import gold
from indicata.plans.silver import silver
from indicata.sources.catalogue import OBSERVATION_YEAR, Source, default_sources
from indicata.sources.landing import ORDINAL, LandingZone, polygon_columns, raw

YEAR = 1998
TERRITORY_SEGMENT_OUT = "MACHINERY"
RING_VERTICES = 64


# Declared, so that no job is spent on reading file footers.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
        " l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def in_year(column: str, year: int) -> str:
    """A date range rather than ``year(column) = ...``, so that it reaches the Parquet scan."""
    return f"{column} >= timestamp_ntz'{year}-01-01' AND {column} < timestamp_ntz'{year + 1}-01-01'"


def money(column: str) -> Column:
    return F.expr(f"sum(cast({column} AS decimal(18,2)))")


class StandIns:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def read(self, source: Source) -> DataFrame:
        return raw(self.delivered(source))

    def delivered(self, source: Source) -> DataFrame:
        """The rows as the provider has them, with a position."""
        shapes = {
            names.GDP: self._gdp,
            names.REVENUE: self._revenue,
            names.POPULATION: self._population,
            names.NAME: self._territories,
            names.INDEX: self._index,
        }
        return shapes[source.name](source)

    def strays(self, source: Source) -> DataFrame:
        """Observations that silver has to deal with: other levels, missing keys, an unasked year, repeated keys."""
        def rows(key: str, level: str, year: int, value: str) -> DataFrame:
            return self.table("nation").selectExpr(
                f"'{source.series}' AS CODE", f"'{year}-01-01' AS `RAW DATE`", f"{year} AS YEAR", f"{key} AS {source.key}",
                f"'{level}' AS NIVNOME", f"cast({value} AS double) AS `{source.value}`",
            ).where(f"`{source.value}` IS NOT NULL")

        territory = "cast(n_nationkey AS string)"
        return (
            rows(territory, "Estados", source.year, "n_nationkey + 0.5")
            .union(rows("cast(null AS string)", source.level, source.year, "if(n_regionkey = 0, n_nationkey + 0.125, null)"))
            .union(rows(territory, source.level, source.year - 1, "n_nationkey + 0.25"))
            .union(rows(territory, source.level, source.year, "if(n_regionkey = 1, n_nationkey + 1000.125, null)"))
        )

    def landed(self, source: Source, fmt: str = "parquet") -> LandingZone:
        """A landing zone that holds the source, strays included."""
        rows = self.delivered(source).drop(ORDINAL)
        if source.year is not None:
            rows = rows.unionByName(self.strays(source))
        root = storage.scratch_path(self.spark, "landing")
        writer = rows.write.option("header", True).format(fmt)
        (writer.partitionBy(OBSERVATION_YEAR) if source.year is not None else writer).save(f"{root}/{source.series}")
        return LandingZone(self.spark, root, fmt)

    def landed_all(self, spoiled: str | None = None, strays: str | None = None) -> LandingZone:
        """One landing zone with every source; that of ``spoiled`` lacks its key, that of ``strays`` has strays."""
        root = storage.scratch_path(self.spark, "landing")
        for source in sources():
            rows = self.delivered(source).drop(ORDINAL, *([source.key] if source.name == spoiled else []))
            if source.name == strays:
                rows = rows.unionByName(self.strays(source))
            (rows.write.partitionBy(OBSERVATION_YEAR) if source.year is not None else rows.write).parquet(f"{root}/{source.series}")
        return LandingZone(self.spark, root)

    def _observations(self, rows: DataFrame, source: Source, value: Column) -> DataFrame:
        """One row per territory; grouped by the text key, which the later joins share."""
        grouped = rows.groupBy(F.expr(f"cast(o_custkey AS string) AS {source.key}")).agg(
            value.alias(source.value), F.min("o_orderkey").alias(ORDINAL)
        )
        return grouped.selectExpr(
            f"'{source.series}' AS CODE",
            f"'{source.year}-01-01' AS `RAW DATE`",
            f"{source.year} AS YEAR",
            source.key,
            f"'{source.level}' AS NIVNOME",
            f"`{source.value}`",
            ORDINAL,
        )

    def _gdp(self, source: Source) -> DataFrame:
        """Shipped value of a year per customer. Lines are summed per order before the join."""
        lines = self.table("lineitem").where(in_year("l_shipdate", source.year))
        per_order = lines.groupBy(F.expr("l_orderkey AS o_orderkey")).agg(money("l_extendedprice").alias("shipped"))
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        return self._observations(per_order.join(orders, "o_orderkey"), source, F.expr("cast(sum(shipped) AS double)"))

    def _revenue(self, source: Source) -> DataFrame:
        rows = self.table("orders").where(in_year("o_orderdate", source.year))
        return self._observations(rows, source, money("o_totalprice").cast("double"))

    def _population(self, source: Source) -> DataFrame:
        return self._observations(self.table("orders"), source, F.expr("count(1)"))

    def _territories(self, source: Source) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_name AS NAME",
            "cast(c_custkey AS string) AS ID",
            f"if(c_mktsegment = '{TERRITORY_SEGMENT_OUT}', 'Estados', '{source.level}') AS LEVEL",
            "c_acctbal AS AREA",
            "c_nationkey = 0 AS CAPITAL",
            f"0 AS {ORDINAL}",
        )

    def _index(self, source: Source) -> DataFrame:
        """Index rows; the date comes as a number of days, as one provider delivers it."""
        day = (source.date - dt.date(1970, 1, 1)).days
        return self.table("customer").selectExpr(
            f"'{source.series}' AS code",
            f"if(c_acctbal >= 0, '{source.level}', 'State') AS uname",
            f"{day}D AS date",
            "cast(c_custkey AS string) AS tcode",
            "c_acctbal AS value",
            f"0 AS {ORDINAL}",
        )

    def polygons(self) -> DataFrame:
        return polygon_columns(self.outlines())

    def landed_polygons(self) -> LandingZone:
        """A landing zone that holds the outlines in well-known binary."""
        root = storage.scratch_path(self.spark, "landing")
        self.outlines().withColumn("geometry", to_wkb(F.col("geometry"))).write.parquet(f"{root}/polygons")
        return LandingZone(self.spark, root)

    def outlines(self) -> DataFrame:
        """One closed star-shaped ring per embedding: its entries are the radii."""
        angle = f"(2 * pi() * (i % {RING_VERTICES}) / {RING_VERTICES})"
        radius = f"(1 + 0.5 * CAST(embedding[i % {RING_VERTICES}] AS DOUBLE))"
        ring = (
            f"transform(sequence(0, {RING_VERTICES}), i -> named_struct("
            f"'x', label + {radius} * cos({angle}), 'y', {radius} * sin({angle})))"
        )
        return self.table("embeddings").selectExpr(
            "cast(vec_id AS double) AS code_muni",
            "concat('polygon ', vec_id) AS name_muni",
            "cast(label AS string) AS code_state",
            "concat('S', label) AS abbrev_state",
            f"cast(array(array({ring})) AS {GEOMETRY.simpleString()}) AS geometry",
        )


def sources(year: int = YEAR) -> list[Source]:
    return default_sources(year)


def silvers(spark: SparkSession, sf_dir: str, mode: str = "label") -> dict[str, DataFrame]:
    zone = StandIns(spark, sf_dir)
    return {s.name: silver(zone.read(s), s, mode) for s in sources()}


def gold_table(spark: SparkSession, sf_dir: str, mode: str = "label") -> DataFrame:
    """Gold as a stored table, for everything that reads it more than once."""
    return storage.staged(gold(silvers(spark, sf_dir, mode), mode, ordered=False, repeated_keys=False), f"gold-{mode}")
