"""Session helpers: a local session for tests and benches, and lineage cuts that survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", app: str = "faunatally") -> SparkSession:
    """A session on this machine. On a cluster the session comes from the cluster and its settings stand."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def named_checkpoint_dir(spark: SparkSession) -> str | None:
    return spark.conf.get(CHECKPOINT_DIR, None) or None


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Make sure checkpoints go to the folder the cluster names. A local session without one gets its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = named_checkpoint_dir(spark)
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="faunatally-"))
    else:
        raise ValueError(f"{CHECKPOINT_DIR} is not set; checkpoints need a folder all executors share")


def materialise(df: DataFrame) -> DataFrame:
    """Compute a table several queries share once, and cut its lineage.

    It is written as Parquet to the shared checkpoint folder and read back, so a lost executor costs nothing, later
    queries read only the columns they use, and the planner knows the size. The folder's owner clears it.
    """
    spark = df.sparkSession
    use_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
