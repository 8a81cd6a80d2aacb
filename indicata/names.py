"""Column names, series codes and level labels of the indicator data model.

Inside the library every column has a short ASCII name; the published tables
carry the display names below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

CODE = "code"
NAME = "name"
POPULATION = "population"
INDEX = "idhm"
REVENUE = "revenue"
GDP = "gdp"
BURDEN = "burden"
STATUS = "data_status"

# Column order of the gold table; the ratio and the label are derived after the join.
GOLD_SCHEMA = T.StructType(
    [
        T.StructField(CODE, T.StringType()),
        T.StructField(NAME, T.StringType()),
        T.StructField(POPULATION, T.LongType()),
        T.StructField(INDEX, T.DoubleType()),
        T.StructField(REVENUE, T.DoubleType()),
        T.StructField(GDP, T.DoubleType()),
    ]
)
MEASURES = [POPULATION, INDEX, REVENUE, GDP, BURDEN]

# Level labels used by the two providers.
LEVEL_MUNICIPALITY = "Municípios"
INDEX_LEVEL_MUNICIPALITY = "Municipality"

# Label texts.
COMPLETE = "complete"
INCOMPLETE = "incomplete"


def display_names(year: int) -> dict[str, str]:
    """Display name of every gold column for a reference year (fixed values)."""
    return {
        CODE: "CodMunIBGE",
        NAME: "Município",
        POPULATION: f"Habitantes {year}",
        INDEX: f"IDHM {year}",
        REVENUE: f"Receitas Correntes {year} (R$)",
        GDP: f"PIB {year} (R$)",
        BURDEN: f"Carga Tributária Municipal {year}",
        STATUS: "data_status",
    }


def to_display(df: DataFrame, year: int) -> DataFrame:
    return df.withColumnsRenamed(display_names(year))


def from_display(df: DataFrame, year: int) -> DataFrame:
    return df.withColumnsRenamed({shown: plain for plain, shown in display_names(year).items()})
