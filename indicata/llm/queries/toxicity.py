from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..shared import table
from ..toxicity import toxicity


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
