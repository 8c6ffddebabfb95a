"""Session defaults and the reliable lineage cut used by multi-pass operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. They only touch SQL configuration, so they can be
# applied to a session somebody else has created.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even when that costs one more exchange further up
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # collect_list and the like keep hashing up to this many groups per task before they sort
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8192",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a running session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "shelfmark", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and laptops. On a cluster, use the cluster's own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints, as ``spark.checkpoint.dir`` names it. All executors must share it.

    Only a session on one machine (tests, laptops) may go without; it gets a temporary folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if not current:
        current = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            current = tempfile.mkdtemp(prefix="shelfmark-checkpoint-")
        context.setCheckpointDir(current)
    return context.getCheckpointDir() or current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and continue from the files.

    Needed where a result must be *the same rows in the same slices* for two later passes, even
    if executors are lost in between.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
