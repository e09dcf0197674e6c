"""The package for Python workers that cannot import it."""

from __future__ import annotations

import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the sources of the package to all workers of the application, once.

    Functions that run inside tasks import their modules there. A job started
    with ``--py-files`` has them already; sending them again does no harm.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    # Spark deletes its own folder for files when the application ends.
    archive = Path(SparkFiles.getRootDirectory()) / "package" / "syncspark.zip"
    archive.parent.mkdir(exist_ok=True)
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(PACKAGE.rglob("*.py")):
            file.write(source, source.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def with_package(function: Callable) -> Callable:
    """A function of a session, and whatever else, that ships the package first."""

    @wraps(function)
    def run(spark: SparkSession, *args, **named):
        ship(spark)
        return function(spark, *args, **named)

    return run
