"""Makes this package importable on executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import aislewise


def ship_package(spark: SparkSession) -> None:
    """Sends the package to the executors, once for each Spark application."""
    context = spark.sparkContext
    if getattr(context, "_aislewise_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(aislewise.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="aislewise-"), "aislewise_package.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("aislewise", os.path.relpath(full, root)))
    context.addPyFile(path)
    context._aislewise_shipped = True


def map_batches(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)
