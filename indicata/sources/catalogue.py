"""What is read: one row per source, with everything that differs between them."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import types as T

from indicata import names

# Column names of the raw tables, as the providers deliver them.
OBSERVATION_KEY = "TERCODIGO"
OBSERVATION_LEVEL = "NIVNOME"
OBSERVATION_YEAR = "YEAR"
OBSERVATION_DROPS = ("CODE", "RAW DATE", "YEAR", "NIVNOME")
TERRITORY_KEY = "ID"
TERRITORY_LEVEL = "LEVEL"
TERRITORY_DROPS = ("LEVEL", "AREA", "CAPITAL")
INDEX_KEY = "tcode"
INDEX_LEVEL = "uname"
INDEX_DATE = "date"
INDEX_DROPS = ("code", "uname", "date")
POLYGON_KEY = "code_muni"
POLYGON_STATE = "abbrev_state"
POLYGON_DROPS = ("name_muni", "code_state")
STATE = "UF"


def observation_schema(value_column: str, value_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("CODE", T.StringType()),
            T.StructField("RAW DATE", T.StringType()),
            T.StructField("YEAR", T.IntegerType()),
            T.StructField("TERCODIGO", T.StringType()),
            T.StructField("NIVNOME", T.StringType()),
            T.StructField(value_column, value_type),
        ]
    )


TERRITORY_SCHEMA = T.StructType(
    [
        T.StructField("NAME", T.StringType()),
        T.StructField("ID", T.StringType()),
        T.StructField("LEVEL", T.StringType()),
        T.StructField("AREA", T.DoubleType()),
        T.StructField("CAPITAL", T.StringType()),
    ]
)

INDEX_SCHEMA = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("uname", T.StringType()),
        T.StructField("date", T.DoubleType()),
        T.StructField("tcode", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

POLYGON_SCHEMA = T.StructType(
    [
        T.StructField("code_muni", T.DoubleType()),
        T.StructField("name_muni", T.StringType()),
        T.StructField("code_state", T.StringType()),
        T.StructField("abbrev_state", T.StringType()),
        T.StructField("geometry", T.BinaryType()),
    ]
)


@dataclass(frozen=True)
class Source:
    """One source: where its rows lie and how its silver table follows from them."""

    name: str  # silver value column
    series: str  # directory in the landing zone
    schema: T.StructType  # the columns that must be there; files keep their own types
    key: str
    value: str
    level_column: str
    level: str
    drops: tuple[str, ...]
    year: int | None = None  # asked from the source
    date_column: str | None = None
    date: dt.date | None = None  # filtered in silver
    dtype: str | None = None
    # Cast mode per pipeline mode.
    casts: dict[str, str] = field(default_factory=lambda: {"label": "none", "strict": "none"})
    scale: float | None = None
    digits: int | None = None


def default_sources(year: int = 2010) -> list[Source]:
    """The five sources in join order; codes, units and digits are fixed values."""

    def observations(name: str, series: str, value: str, raw_type: T.DataType, **more) -> Source:
        return Source(
            name=name,
            series=series,
            schema=observation_schema(value, raw_type),
            key=OBSERVATION_KEY,
            value=value,
            level_column=OBSERVATION_LEVEL,
            level=names.LEVEL_MUNICIPALITY,
            drops=OBSERVATION_DROPS,
            year=year,
            **more,
        )

    return [
        observations(
            names.GDP, "PIB_IBGE_5938_37", f"VALUE (R$ (mil), a preços do ano {year})", T.DoubleType(),
            dtype="double", casts={"label": "strict", "strict": "ignore"}, scale=1000.0, digits=3,
        ),
        observations(
            names.REVENUE, "RECORRM", "VALUE (R$)", T.DoubleType(),
            dtype="double", casts={"label": "strict", "strict": "ignore"}, digits=2,
        ),
        observations(
            names.POPULATION, "POPTOT", "VALUE (Habitante)", T.DoubleType(),
            dtype="bigint", casts={"label": "ignore", "strict": "ignore"},
        ),
        Source(
            name=names.NAME, series="Municípios", schema=TERRITORY_SCHEMA,
            key=TERRITORY_KEY, value="NAME", level_column=TERRITORY_LEVEL,
            level=names.LEVEL_MUNICIPALITY, drops=TERRITORY_DROPS,
        ),
        Source(
            name=names.INDEX, series="ADH_IDHM", schema=INDEX_SCHEMA,
            key=INDEX_KEY, value="value", level_column=INDEX_LEVEL,
            level=names.INDEX_LEVEL_MUNICIPALITY, drops=INDEX_DROPS,
            date_column=INDEX_DATE, date=dt.date(year, 1, 1),
            dtype="double", casts={"label": "strict", "strict": "ignore"},
        ),
    ]


# Base table first. In label mode the first source that could be read is the base.
JOIN_ORDER = {
    "label": [names.GDP, names.REVENUE, names.POPULATION, names.NAME, names.INDEX],
    "strict": [names.POPULATION, names.GDP, names.REVENUE, names.INDEX, names.NAME],
}
