"""Sends the package's own code to the executors, as `--py-files` would.

Python workers import varloom by name; a session that was started without the package on the executors' path
gets it through the driver's file server, once per application.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    root = Path(__file__).resolve().parent
    if root.is_dir():  # else this very code runs from a shipped archive
        archive = Path(tempfile.mkdtemp(prefix="varloom-code-")) / "varloom.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, path.relative_to(root.parent).as_posix())
        context.addPyFile(str(archive))
    _SENT.add(context.applicationId)
