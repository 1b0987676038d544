"""Working folders and intermediate tables on storage every executor can reach."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def working_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only for a local session without it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tickloom-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def application_root(spark: SparkSession) -> str:
    return f"{working_root(spark)}/tickloom/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{application_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    Cuts the lineage (a lost executor costs a re-read, not a re-run), fixes values that depend on the
    partitioning, and tells the planner the real size of the result.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; results that read them become unusable."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(application_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
