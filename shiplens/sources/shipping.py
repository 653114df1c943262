"""The package's own code on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import shiplens

_SENT: set[str] = set()
#: The driver serves the archive from here for as long as it runs.
_KEPT = tempfile.TemporaryDirectory(prefix="shiplens-sources-")


def ship(spark: SparkSession) -> None:
    """Send the package's sources to every executor, once per application, so that Python workers
    can import it wherever it is installed on the driver."""
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    root = os.path.dirname(os.path.abspath(shiplens.__file__))
    path = os.path.join(_KEPT.name, f"shiplens-{context.applicationId}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for top, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                file = os.path.join(top, name)
                archive.write(file, os.path.relpath(file, os.path.dirname(root)))
    context.addPyFile(path)
    _SENT.add(context.applicationId)
