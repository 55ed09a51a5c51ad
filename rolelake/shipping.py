"""Sends the package to the executors' Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make the package importable in Python workers, wherever the session was started.

    The driver serves one archive of the source files to all executors, once per application.
    """
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="rolelake-code-"), "rolelake_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("rolelake", os.path.relpath(path, root)))
    context.addPyFile(archive)
    _sent.add(context.applicationId)
