"""Helpers of the text operators: shared storage, text columns, held-out rows."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: everything between the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder in local mode without it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if spark.sparkContext.applicationId not in _local:
        _local[spark.sparkContext.applicationId] = "file://" + tempfile.mkdtemp(prefix="indicata-llm-")
    return _local[spark.sparkContext.applicationId]


#: Lists that new paths are noted in.
_noted: list[list[str]] = []


@contextlib.contextmanager
def noted_paths() -> Iterator[list[str]]:
    """The paths that are made in the shared folder meanwhile."""
    paths: list[str] = []
    _noted.append(paths)
    try:
        yield paths
    finally:
        _noted.remove(paths)


def drop_unread(spark: SparkSession, paths: list[str], df: DataFrame) -> None:
    """Delete the paths that ``df`` does not read."""
    read = [f.split(":", 1)[-1].lstrip("/") for f in df.inputFiles()] if paths else []
    for path in paths:
        if not any(f.startswith(path.split(":", 1)[-1].lstrip("/") + "/") for f in read):
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, dropped when the application ends."""
    path = f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"
    for paths in _noted:
        paths.append(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def staged(df: DataFrame, label: str, tasks: int | None = None) -> DataFrame:
    """Write to the shared folder and read back, which ends the lineage on files that outlive executors.

    ``tasks`` bounds the tasks that write, for tables known to be small.
    """
    path = scratch_path(df.sparkSession, label)
    (df.coalesce(tasks) if tasks else df).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("string")


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z alone."""
    return F.translate(column, UPPER, UPPER.lower())


def words_of(text: Column) -> Column:
    """The words of a text that is not null, in order."""
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def held_out(doc_id: Column) -> Column:
    """Rows no model learns from: CRC-32 of the id's text leaves no remainder by 5. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame, *without: str) -> Column:
    """All columns but some as one struct ``own``, so that no name of theirs meets a working column."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in without)).alias("own")


def unpacked(docs: DataFrame, *without: str) -> list[Column]:
    """The columns that ``packed`` put into ``own``."""
    return [F.col("own").getField(c).alias(c) for c in docs.columns if c not in without]


def columns(df: DataFrame) -> list[Column]:
    """All columns, whatever their names hold."""
    return [F.col(f"`{c}`") for c in df.columns]


def dealt_join(rows: DataFrame, values: DataFrame, on: list[str], held: str, share: int = 1024) -> DataFrame:
    """Stored ``rows`` with the one row of ``values`` for their key (null keys are equal); rows without one get nulls.

    ``values`` has the columns ``on``, ``held`` (the number of rows of the key) and further ones. Keys of more than one
    part in ``share`` of all rows are dealt to so many slots that none holds more; there are at most ``share`` such keys,
    so their list is sent to the tasks. ``rows`` must come from files without a shuffle, as slots follow their order.
    """
    total, most = values.agg(F.coalesce(F.sum(held), F.lit(0)), F.coalesce(F.max(held), F.lit(0))).first()
    least = max(1, total // share)
    here = {c: f"_on{k}" for k, c in enumerate(on)}
    values = values.withColumnsRenamed(here)
    same = [F.col(f"`{c}`").eqNullSafe(F.col(here[c])) for c in on]
    if most <= least:
        return rows.join(values.drop(held), same, "left").drop(*here.values())
    slots = F.ceil(F.col(held) / least).cast("int")
    hot = values.where(F.col(held) > least).select(*here.values(), slots.alias("_slots"))
    slot = F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("_slots")), F.lit(0)).cast("int")
    dealt = rows.join(F.broadcast(hot), same, "left").withColumn("_slot", slot).drop("_slots", *here.values())
    each = values.withColumn("_at", F.explode(F.sequence(F.lit(0), F.greatest(slots, F.lit(1)) - 1))).drop(held)
    return dealt.join(each, [*same, F.col("_slot") == F.col("_at")], "left").drop("_slot", "_at", *here.values())


def smallest_hashes(rows: DataFrame, most: int, hashed: Column, *ties: str) -> DataFrame:
    """The ``most`` rows with the smallest 64-bit hash, then by ``ties``.

    A bound on the hash leaves about twice as many rows to be sorted, so what single tasks hand on does not grow with the rows.
    """
    rows = rows.withColumn("_hash", hashed)
    share, cut = 2 * most / max(rows.count(), 1), rows
    while share < 1:
        cut = rows.where(F.col("_hash") < int(-(1 << 63) + share * (1 << 64)))
        if cut.count() >= most:
            break
        cut, share = rows, 2 * share
    return cut.orderBy("_hash", *ties).limit(most).drop("_hash")


def first_rows(df: DataFrame, n: int, column: str, *ties: str) -> DataFrame:
    """The ``n`` first rows by a number column (nulls last) and ``ties``; what single tasks hand on does not grow with the rows.

    Sketches of the column cut the rows down before they are sorted; equal numbers at the cut stay together.
    """
    rows, order = df, [F.col(column).asc_nulls_last(), *ties]
    count = df.agg(F.count(column)).first()[0]
    while count > 16 * n:
        cut = rows.agg(F.percentile_approx(column, min(1.0, 4 * n / count), 10_000)).first()[0]
        fewer = df.where(F.col(column) <= cut)
        held = fewer.count()
        if held < n or held >= count:  # the sketch was too coarse, or one number fills the rows
            break
        rows, count = fewer, held
    return rows.orderBy(*order).limit(n)


def texts_of(batches: Iterator, column: str) -> Iterator:
    """Arrow batches with one column as Python strings, null as empty."""
    for batch in batches:
        yield batch, [t or "" for t in batch.column(column).to_pylist()]
