"""Where written intermediate tables go."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder that the cluster names in ``spark.checkpoint.dir``.

    Tables written there survive the loss of an executor. Only a local session without the setting
    gets a folder on this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tallyloom-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
