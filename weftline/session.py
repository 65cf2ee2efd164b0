"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the results depend on.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.cteRecursionRowLimit": "-1",
}

# Settings only the speed depends on; what the cluster was started with wins. Parallelism
# (spark.sql.shuffle.partitions) is left alone: adaptive execution coalesces what is too fine.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "25000000",
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.joinReorder.enabled": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

_local_base: dict[str, str] = {}


def build_session(app: str = "weftline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED_CONF, **TUNING_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    started_with = spark.sparkContext.getConf()
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    for key, value in TUNING_CONF.items():
        if not started_with.contains(key):
            spark.conf.set(key, value)
    return spark


def shared_base(spark: SparkSession) -> str:
    """Folder that every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_base:
        _local_base[context.applicationId] = tempfile.mkdtemp(prefix="weftline-")
    return _local_base[context.applicationId]


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_base(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(f"{shared_base(spark)}/checkpoints")
    return df.checkpoint(eager=True)


def land(df: DataFrame, label: str) -> DataFrame:
    """Write to a fresh parquet folder in the shared scratch and read it back, so later columns are pruned."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
