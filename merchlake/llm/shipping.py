"""Makes the package importable on the executors, wherever the driver was started, and keeps their batches small."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()
# A worker holds a batch of texts several times over: as Arrow, as strings, as bytes and as hashes.
_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def ship_package(spark: SparkSession) -> SparkSession:
    """Sends this package's modules to the executors once for each application, and sets the size of their batches."""
    context = spark.sparkContext
    for key, value in _BATCHES.items():
        spark.conf.set(key, value)
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        archive = f"{tempfile.mkdtemp(prefix='package-')}/{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as file:
            for module in sorted(package.rglob("*.py")):
                file.write(module, module.relative_to(package.parent))
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)
    return spark
