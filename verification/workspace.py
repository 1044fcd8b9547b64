"""Scratch folders for the queries that write and read back."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

_local: tempfile.TemporaryDirectory | None = None


def new_folder(spark: SparkSession) -> str:
    """A fresh folder in the shared folder the cluster names; a local one only in local mode."""
    global _local
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not shared:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        _local = _local or tempfile.TemporaryDirectory(prefix="mensario-")
        shared = _local.name
    return f"{shared.rstrip('/')}/mensario/{uuid4().hex}"
