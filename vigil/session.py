"""SparkSession construction with the settings the operators are designed for."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

# Settings every vigil job relies on.  Adaptive execution re-plans joins at run time
# (broadcast only when the measured side is small), coalesces tiny shuffle partitions
# and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # faster (de)serialisation of checkpointed ladders and of ML training RDDs
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.filterPushdown": "true",
    # checkpointed ladders are removed once no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "vigil", extra: dict | None = None) -> SparkSession:
    """Return a session; on a cluster ``master`` is left to spark-submit."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``.  Only in local mode, when it is unset
    (tests), a scratch folder is created; on a cluster an unset value is an error, since a
    machine-local folder would not survive the loss of an executor."""
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name shared storage on a cluster")
        d = tempfile.mkdtemp(prefix="vigil-ckpt-", dir=os.environ.get("VIGIL_SCRATCH", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def pin(df):
    """Cut a DataFrame's lineage: write it once to the checkpoint folder (shared storage
    on a cluster) and read that copy from then on.  For results reused by many outputs."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, below the application's own folder."""
    return f"{ensure_checkpoint_dir(spark)}/vigil-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def written(df, label: str, counted: bool = False):
    """Write ``df`` once as Parquet to the shared folder and return the table read from there (with its number of
    rows if ``counted``, taken while writing): what is built on it reads that copy and never the upstream again."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    seen = Observation()
    (df.observe(seen, F.count(F.lit(1)).alias("n")) if counted else df).write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    return (table, seen.get["n"]) if counted else table
