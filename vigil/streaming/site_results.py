"""Incremental merge of per-site result files (SRC-6 / SET-1 / SNK-1 as a stream)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.sites import site_table

METRICS_SCHEMA = T.StructType([
    T.StructField("site", T.StringType()), T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("ci_lower", T.DoubleType()),
    T.StructField("ci_upper", T.DoubleType()),
])


def _state_dir(spark: SparkSession, name: str) -> str:
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir (shared storage) before starting a stream")
    return os.path.join(base, "streams", name)


def merge_site_files(spark: SparkSession, inbox: str, merged: str, *, schema: T.StructType = METRICS_SCHEMA,
                     fmt: str = "csv", name: str = "site_metrics") -> None:
    """Append every new per-site file under ``inbox`` to the parquet table ``merged``
    (partitioned by site), exactly once; returns when the files present at start are done."""
    stream = (spark.readStream.schema(schema).option("header", True).format(fmt).load(inbox))
    q = (stream.writeStream.format("parquet").partitionBy("site").option("path", merged)
         .option("checkpointLocation", _state_dir(spark, name)).trigger(availableNow=True).start())
    q.awaitTermination()


def site_table_from_merged(spark: SparkSession, merged: str) -> DataFrame:
    """EVL-16 over everything merged so far."""
    m = spark.read.parquet(merged)
    return site_table(m, lower="ci_lower", upper="ci_upper")
