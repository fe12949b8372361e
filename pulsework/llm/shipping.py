"""The package for executors that do not have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile
from weakref import WeakKeyDictionary

from pyspark import SparkContext
from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_sent: WeakKeyDictionary[SparkContext, bool] = WeakKeyDictionary()


def ship(spark: SparkSession) -> None:
    """Send the package's source to the executors, once per application; the driver serves the file itself."""
    context = spark.sparkContext
    if context in _sent:
        return
    name = os.path.basename(_PACKAGE)
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="package-")), f"{name}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, files in os.walk(_PACKAGE):
            for file in files:
                if file.endswith(".py"):
                    full = os.path.join(folder, file)
                    archive.write(full, os.path.join(name, os.path.relpath(full, _PACKAGE)))
    context.addPyFile(path)
    _sent[context] = True
