from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..mixing import mix
from ..shared import table


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")
