from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..htmltext import main_text
from ..shared import table


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
