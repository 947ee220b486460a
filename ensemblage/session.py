"""Session settings and lineage cuts that survive the loss of executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows of one group that a single task may sort and scan in a window.
GROUP_LIMIT_CONF = "spark.ensemblage.maxGroupRows"
DEFAULT_GROUP_LIMIT = 2_000_000


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; a cluster job brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ensemblage")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def group_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(GROUP_LIMIT_CONF, str(DEFAULT_GROUP_LIMIT)))


def shared_folder(spark: SparkSession) -> str:
    """The folder for cut lineage and stream state: the cluster's own, else a local one in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="spark-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir() or folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below this application's part of the shared folder."""
    own = f"{shared_folder(spark).rstrip('/')}/ensemblage/{spark.sparkContext.applicationId}"
    return f"{own}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "stage", replaces: DataFrame | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Columnar, computed once, and readable again after an executor is lost. ``replaces`` is an earlier
    result of this function that nothing reads any more; its files are deleted once the new ones are there.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    if replaces is not None and (old := getattr(replaces, "_scratch_path", None)):
        _delete(spark, old)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch_path = path
    return table


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete all tables this application wrote to the shared folder; call it when their results are saved."""
    _delete(spark, scratch_path(spark, "x").rsplit("/", 1)[0])


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where a scan has fewer splits than there are cores, ahead of work that is heavy per row."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
