"""Make this package importable in the Python workers of a session."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path
from threading import Lock

from pyspark.sql import SparkSession

_shipped: set[str] = set()
_shipping = Lock()


def ship_package(spark: SparkSession) -> None:
    """Have Spark hand this package's sources to its workers; once per application.

    The archive is read by the driver's own file server only.  Spark refuses a second archive
    of that name, so sources that are loaded side by side wait for the first to be handed over.
    """
    context = spark.sparkContext
    with _shipping:
        if context.applicationId in _shipped:
            return
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="monthfusion-package-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
