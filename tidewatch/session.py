"""Session defaults for local use and the shared scratch area for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(app: str = "tidewatch", cores: str = "*", **conf: str) -> SparkSession:
    """A UTC session for tests and benchmarks; on a cluster the submitter owns the session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only in local mode where nothing is set."""
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tidewatch-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_home(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/tidewatch/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_home(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application; for the end of a job."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_home(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write `df` once to the shared folder and return a scan of it.

    Cuts lineage in a way that survives the loss of executors, and gives the planner real file sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
