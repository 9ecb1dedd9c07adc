"""Make this package importable on the executors of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_done: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package's sources with the session, once; executors need no installation."""
    sc = spark.sparkContext
    if sc.applicationId in _done:
        return spark
    root = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="deltaloom-")) / "deltaloom_sources.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(target))
    # workers that Spark starts beside the driver, as for a stream's processor, get no such files
    sc.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [str(root.parent), sc.environment.get("PYTHONPATH")]))
    _done.add(sc.applicationId)
    return spark
