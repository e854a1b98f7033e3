"""Make the package importable in Python workers, wherever they run."""

from __future__ import annotations

import os
import tempfile
import weakref
import zipfile

from pyspark import SparkContext
from pyspark.sql import SparkSession

_SHIPPED: weakref.WeakSet[SparkContext] = weakref.WeakSet()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per application.

    Spark fetches the archive into each executor's own folder, so workers need neither
    the repository nor ``--py-files``.
    """
    context = spark.sparkContext
    if context in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(root)
    path = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, files in os.walk(root):
            for file in sorted(files):
                if file.endswith(".py"):
                    full = os.path.join(folder, file)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    _SHIPPED.add(context)
