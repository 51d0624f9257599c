"""What is read from the session."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; where unset, a temporary folder if Spark runs in this process."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='vesselflow-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path
