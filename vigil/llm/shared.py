"""Intermediate tables in the folder that the whole cluster shares (``spark.checkpoint.dir``)."""

from __future__ import annotations

import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from vigil.session import ensure_checkpoint_dir


def free_name(name: str, df: DataFrame) -> str:
    """``name``, with underscores added until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, grouped by application so that it can be cleared."""
    return f"{ensure_checkpoint_dir(spark)}/vigil-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return the table read from there: lineage
    ends at files that survive the loss of any executor."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sent(spark: SparkSession, value):
    """Broadcast ``value`` (its class travels with it) and return a function that gives it in a worker."""
    data = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    opened = []

    def get():
        if not opened:
            opened.append(cloudpickle.loads(data.value))
        return opened[0]

    return get
