"""Folders for intermediate tables that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# The temporary folders of local sessions, by application.
_local: dict[str, str] = {}


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below ``spark.checkpoint.dir`` that nothing uses yet.

    Where the setting is missing, a local master gets a temporary folder, one for the application. A cluster gets an
    error, as its executors could not see one another's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if context.applicationId not in _local:
            _local[context.applicationId] = tempfile.mkdtemp(prefix="sluicebox-")
        base = _local[context.applicationId]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
