"""The package's code for Python workers that can't import it otherwise."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


ROWS = 1000  # rows of an Arrow batch: whole texts are long, and the default of 10,000 would hold many MB for each worker


def ship(spark: SparkSession) -> None:
    """Hand the package to the executors of this application, once, as a zip that the driver serves; bound Arrow batches."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(setting)) > ROWS:
        spark.conf.set(setting, str(ROWS))
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix=f"{root.name}-code-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)
