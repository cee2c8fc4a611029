"""Makes this package importable in Python workers.

A package that is installed on the cluster, or on its PYTHONPATH, needs none of
this; one that runs from its source folder is sent as a zip, as `--py-files`
would send it.
"""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]

#: Rows of an Arrow batch, where the session keeps Spark's default of 10,000:
#: batches of whole texts are held several times over, in the JVM and in Python.
BATCH_ROWS = 2_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package once per application, and keep batches of texts small."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    base = Path(tempfile.mkdtemp(prefix="rowtide-py-")) / "rowtide"
    ignored = shutil.ignore_patterns("__pycache__")
    shutil.copytree(PACKAGE, base / "rowtide", ignore=ignored)
    context.addPyFile(shutil.make_archive(str(base), "zip", base, "rowtide"))
    _sent.add(context.applicationId)
