"""Where written tables that cut lineage go: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused directory below ``spark.checkpoint.dir``.

    Where the setting is absent, only a local master gets a temporary folder; on a cluster a
    machine-local folder would not be seen by the other executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="changeloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/changeloom/{purpose}-{uuid.uuid4().hex[:12]}"
