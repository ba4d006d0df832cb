"""The shared folder for staged tables and streaming checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CONF = "spark.checkpoint.dir"

_local: list[str] = []


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder of its own below ``spark.checkpoint.dir``.

    Where the setting is missing only a local session may go on, with a
    temporary folder; on a cluster such a folder would be different per machine.
    """
    base = spark.conf.get(CONF, None)
    if not base:
        if not (spark.conf.get("spark.master", "") or "").startswith("local"):
            raise ValueError(f"set {CONF} to a folder that every executor can reach")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="tablewire-"))
        base = _local[0]
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
