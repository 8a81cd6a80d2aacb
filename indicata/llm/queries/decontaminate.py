from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..decontaminate import decontaminate
from ..shared import table


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).drop("text")
