"""A scratch folder for local sessions that name none."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import SparkSession


def ensure_scratch(spark: SparkSession) -> None:
    """Give a ``local[...]`` session without ``spark.checkpoint.dir`` a folder that goes at exit."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        folder = tempfile.mkdtemp(prefix="plumeline-")
        atexit.register(shutil.rmtree, folder, True)
        spark.sparkContext.setCheckpointDir(folder)
