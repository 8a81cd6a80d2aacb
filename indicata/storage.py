"""Layers on shared storage: write, read back, create once, stage, measure."""

from __future__ import annotations

import functools
import tempfile
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_folder()
    raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="indicata-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, dropped when the application ends."""
    path = f"{shared_folder(spark)}/indicata/{label}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write to the shared folder and read back: lineage ends there, lost executors cost nothing."""
    path = scratch_path(df.sparkSession, label)
    write_layer(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_layer(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite a layer as snappy Parquet, or as CSV with a header in UTF-8.

    In CSV text keeps its spaces, quotes and empty values. Line breaks are written as ``\\n`` and ``\\r`` and
    back-slashes as ``\\s``, an empty text as ``\\e``, so that a record is a line and files can be split.
    """
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        one_line(df).write.mode("overwrite").options(**CSV).csv(path)
    elif fmt == "parquet":
        writer.option("compression", "snappy").parquet(path)
    else:
        raise ValueError(f"unknown layer format {fmt!r}")


def read_layer(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Read a layer back with its schema; inferring it would turn keys into numbers. A value that is no such type is an error."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return _with_text(reader.options(**CSV, mode="FAILFAST", enforceSchema="false").csv(path), _plain)
    return reader.parquet(path)


#: Writing and reading of CSV layers; quotes are doubled.
CSV = {"header": "true", "encoding": "UTF-8", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
EMPTY = "\\e"
ESCAPES = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"))


def one_line(df: DataFrame) -> DataFrame:
    return _with_text(df, _escaped)


def _escaped(text: Column) -> Column:
    return F.when(text == "", EMPTY).otherwise(reduce(lambda v, e: F.replace(v, F.lit(e[0]), F.lit(e[1])), ESCAPES, text))


def _plain(text: Column) -> Column:
    return F.when(text == EMPTY, "").otherwise(reduce(lambda v, e: F.replace(v, F.lit(e[1]), F.lit(e[0])), reversed(ESCAPES), text))


def _with_text(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    """Every text column changed."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: change(F.col(f"`{c}`")) for c in texts}) if texts else df


def create_if_absent(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Save as a table unless it exists; an existing one keeps its rows.

    Stale rows may surprise; ``overwrite_table`` replaces them.
    """
    return _save_table(df, table, "ignore", path)


def overwrite_table(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    return _save_table(df, table, "overwrite", path)


def _save_table(df: DataFrame, table: str, mode: str, path: str | None) -> DataFrame:
    writer = df.write.mode(mode).format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


@dataclass(frozen=True)
class StageMetric:
    stage: str
    rows: int
    missing: int
    seconds: float


METRIC_SCHEMA = "stage string, rows bigint, missing bigint, seconds double"


def measured_write(df: DataFrame, path: str, stage: str, fmt: str = "parquet") -> tuple[DataFrame, StageMetric]:
    """Write a layer, read it back, and report rows, missing values and wall time.

    The counts are observed on the way to the files, so the layer is not read for
    them. The observation is the last step before the write and thus part of the
    job's result tasks, each of which Spark counts once however often it is run.
    """
    return observed_write(df, path, stage, (), fmt)[:2]


def observed_write(df: DataFrame, path: str, stage: str, observed: Sequence[Column], fmt: str = "parquet") -> tuple[DataFrame, StageMetric, dict]:
    """``measured_write`` with further aggregates, whose values come back as well."""
    missing = F.lit(0)
    for c in df.columns:
        missing = missing + F.count_if(F.col(f"`{c}`").isNull())
    seen = Observation()
    started = time.monotonic()
    write_layer(df.observe(seen, F.count(F.lit(1)).alias("rows"), missing.alias("missing"), *observed), path, fmt)
    seconds = time.monotonic() - started
    stored = read_layer(df.sparkSession, path, df.schema, fmt)
    return stored, StageMetric(stage, seen.get["rows"], seen.get["missing"], seconds), seen.get


def clustered_write(df: DataFrame, path: str, key: str, parts: str, observed: Sequence[Column], buckets: int | None = None) -> tuple[DataFrame, str, dict, float]:
    """Write a layer in folders by ``parts`` and buckets of ``key``; the stored table, its name, what was observed, and the seconds.

    Tables with the same number of buckets (that of shuffle partitions unless told otherwise) join on the key without a
    shuffle. Rows go to the task of their bucket first, except where a bucket is so full that Spark splits it. The
    catalogue, which knows the buckets, has the table under a name of its own; dropping that leaves the Parquet files.
    """
    spark, seen = df.sparkSession, Observation()
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"indicata_{uuid.uuid4().hex}"
    started = time.monotonic()
    dealt = df.hint("rebalance", count, F.col(key)).observe(seen, *observed)
    dealt.write.mode("overwrite").partitionBy(parts).bucketBy(count, key).option("compression", "snappy").option("path", path).saveAsTable(name)
    return spark.table(name), name, seen.get, time.monotonic() - started


def metrics_table(spark: SparkSession, metrics: list[StageMetric]) -> DataFrame:
    return spark.createDataFrame([(m.stage, m.rows, m.missing, m.seconds) for m in metrics], METRIC_SCHEMA)
