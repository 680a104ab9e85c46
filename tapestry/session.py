"""Session settings and shared scratch space."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "16g") -> SparkSession:
    """A local session for tests and the benchmark; on a cluster pass your own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tapestry")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder all executors can reach, under ``spark.checkpoint.dir``; a temporary one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        root = tempfile.mkdtemp(prefix="tapestry-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write an intermediate table to the shared scratch folder and continue from there.

    Used before a table is read several times: it is computed once, and a lost executor only repeats the scan.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
