"""Give the Python workers this package where it is not installed on the executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Texts are long: a worker holds one batch and what it makes of it.
ARROW_BYTES = str(8 << 20)

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Add the package to the session's Python files, once per application, and keep Arrow batches small."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        top = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="package-")  # on the driver, which serves it while the application runs
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = Path(folder, f"{top.name}.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as packed:
            for path in sorted(top.rglob("*.py")):
                packed.write(path, path.relative_to(top.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
    return spark
