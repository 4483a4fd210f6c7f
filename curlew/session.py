"""Sessions, and shipping this package to executors that don't have it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def session(app: str = "curlew", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    options = {"spark.sql.adaptive.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false"}
    for key, value in {**options, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Makes this package importable in Python workers, once a session."""
    sc = spark.sparkContext
    if getattr(sc, "_curlew_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="curlew-"), "curlew.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._curlew_shipped = True
