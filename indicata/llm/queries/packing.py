from pyspark.sql import DataFrame, SparkSession

from ..packing import pack_documents
from ..shared import table


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in sequences of 2048 tokens."""
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
