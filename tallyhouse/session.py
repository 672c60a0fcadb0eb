"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Dates are derived from zoned timestamps, so the zone has to be fixed. The
# charset switch lets the CSV reader accept windows-1251. Row-preserving lookups
# lean on AQE to split a hot join key, also where that costs one more shuffle. The
# JIT compiler leaves methods above 8000 bytes interpreted; past that size separate
# small methods are faster than one fused stage.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # As JSON readers do: of a repeated key the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    A machine-local folder is only acceptable when driver and executors are one
    process, so it is refused anywhere else.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    root = tempfile.mkdtemp(prefix="tallyhouse-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/tallyhouse/{label}-{uuid.uuid4().hex}"
