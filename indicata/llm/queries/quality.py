from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..quality import quality
from ..shared import table


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
