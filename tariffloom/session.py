"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # runtime re-planning: joins turn into broadcasts only from measured sizes, skewed partitions are split
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a shuffle on the contract alone must not be reused for finer keys: one contract may hold a third of the rows
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "tariffloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a session that somebody else created. What its owner has set stays."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names; beside the warehouse, which is shared as well, where it names none."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(named or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints")
    return context.getCheckpointDir()
