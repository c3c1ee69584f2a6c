"""The package for Python workers that do not find it on their own path."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED = "ledgerline.shipped"


def ship(spark: SparkSession) -> None:
    """Add the package's source files to the session's Python files, once per application.

    Where the package is installed on all machines, or given by ``--py-files``, this changes nothing.
    """
    context = spark.sparkContext
    if context.getLocalProperty(_SHIPPED) == context.applicationId:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # Made on the driver and served by it; no task writes or reads the folder.
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerline-files-"), "ledgerline_files.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.relpath(file, os.path.dirname(root)))
    context.addPyFile(path)
    context.setLocalProperty(_SHIPPED, context.applicationId)
