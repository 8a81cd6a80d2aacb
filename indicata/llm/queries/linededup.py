from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..linededup import dedup_lines
from ..shared import table


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
