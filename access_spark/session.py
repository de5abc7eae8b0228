"""Session settings the operators rely on, and lineage cutting for iterative jobs."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. No broadcast threshold is raised: a side is broadcast only
# when the planner (or AQE, from measured shuffle sizes) finds it small enough.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split skewed partitions even when that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def small_batches(spark: SparkSession, rows: int = 1000) -> SparkSession:
    """Hand Python so many rows at once, for jobs on whole texts: Spark's 10,000 are some fifty
    megabytes, which the executor and each of its Python workers hold several times."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return spark


def local_session(cores: int | str = 8, app: str = "access_spark") -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.legacy.timeParserPolicy", "CORRECTED")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one spark.checkpoint.dir names.

    Only a local session may go without and gets a temporary folder; on a cluster every
    machine would write to its own disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="access-checkpoint-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss and stops the plan growing.

    Spark deletes the files when the table is no longer used if
    spark.cleaner.referenceTracking.cleanCheckpoints is set, as `local_session` does.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def parallelism(spark: SparkSession) -> int:
    """Number of ordered slices to use for prefix sums: one per shuffle partition."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
