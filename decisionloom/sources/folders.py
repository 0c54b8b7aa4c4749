"""Tables that a job keeps for itself in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: in spark.checkpoint.dir, else in the warehouse; a temporary one in local mode where the first is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        base = tempfile.mkdtemp(prefix="decisionloom-") if spark.sparkContext.master.split("[")[0] == "local" else spark.conf.get("spark.sql.warehouse.dir")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """df, written once and read again, for small tables that many branches of a query read: it cuts the plan and survives lost executors."""
    path = shared_folder(df.sparkSession, "kept")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
