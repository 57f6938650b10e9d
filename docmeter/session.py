"""Sessions, and the package's own code on executors."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def session(app: str = "docmeter", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Gives executors this package as a zip, once an application, unless their path has it."""
    app = spark.sparkContext.applicationId
    if str(ROOT) not in os.environ.get("PYTHONPATH", "").split(os.pathsep) and app not in _shipped:
        folder = tempfile.mkdtemp(prefix="docmeter-code-")
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/docmeter", "zip", ROOT, "docmeter"))
        _shipped.add(app)
    return spark
