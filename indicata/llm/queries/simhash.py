from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import table
from ..simhash import simhash_groups


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
