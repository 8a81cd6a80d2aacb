"""Session settings for running outside a configured cluster."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers of an application, once; wherever its code was imported from."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='indicata-')}/indicata", "zip", package.parent, package.name)
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def local_session(cores: int | str = "*", app: str = "indicata", **extra: str) -> SparkSession:
    """A ``local[cores]`` session for tests and the bench.

    A cluster job takes the session its launcher configured instead; nothing in
    the library depends on the values below.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
