"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution sizes shuffles at run time; skewed join partitions are split even where
# the split costs a further exchange.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_local_scratch: str | None = None


def get_session(app_name: str = "markbook", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A new sub-folder of the folder named in ``spark.checkpoint.dir``.

    Where that is unset a temporary folder is used, in local mode only: on a cluster the
    executors would not see it.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="markbook-")
            atexit.register(shutil.rmtree, _local_scratch, ignore_errors=True)
        base = _local_scratch
    return f"{base.rstrip('/')}/markbook-{uuid.uuid4().hex}"
