"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Whether shuffle files are removed at the end of the query that wrote them.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str, app_name: str = "brightwater", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and the bench; on a cluster the caller passes its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. A private folder is made
    only where that is unset and the session is local; elsewhere a
    machine-local folder would lose data, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    base = tempfile.mkdtemp(prefix="brightwater-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never one used before."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative training cut its lineage with reliable checkpoints."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder.

    For results that several jobs read, such as features a model is fitted on:
    they are computed once, and losing an executor loses none of them. The shuffle files
    it took are removed when the table stands.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        # The write plans anew, so that the setting holds for it.
        df.select("*").write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.parquet(path)


def discard(table: DataFrame) -> None:
    """Deletes a table made by :func:`written` that nothing reads any more."""
    files = table.inputFiles()
    if files:
        jvm = table.sparkSession._jvm
        folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt out evenly, over more tasks than there are cores.

    For costly work on short rows: files and adaptive joins cut partitions by bytes, which leaves
    such rows in a few tasks. Runs no job.
    """
    spark = df.sparkSession
    return df.repartition(max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan (file sizes for plain scans)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
