"""Session set-up and lineage cutting."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more shuffle after the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # long texts: a batch on its way to Python is cut by its bytes, not only by its rows
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}
START_OPTIONS = {
    # no Python call sites in error messages: recording them costs more than building the plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options the library relies on (all can be set on a live session)."""
    for key, value in RUNTIME_OPTIONS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "pricelens", master: str | None = None, **options: str) -> SparkSession:
    """A session with the library's options; ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_OPTIONS, **START_OPTIONS, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a missing
    setting is an error, because an executor's own disk is lost together with the executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pricelens-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_folder(spark: SparkSession) -> str:
    """The folder that holds all intermediate tables of this application."""
    return f"{shared_dir(spark)}/pricelens-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for an intermediate table, below one folder per application."""
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> bool:
    """Removes the application's intermediate tables; results that still read them must be written before."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def discard(*tables: DataFrame) -> None:
    """Removes tables that ``materialise`` wrote and nothing reads any more; other tables are left alone."""
    for table in tables:
        spark = table.sparkSession
        own = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark)).toUri().getPath()
        for file in table.inputFiles():
            folder = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file)).getParent()
            if folder.getParent().toUri().getPath() == own:
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
                break


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of finished steps now.

    Its cleaner removes what the driver's garbage collector has found, which may be long after a step of a job that writes
    a lot. Call it between steps whose results are written.
    """
    gc.collect()
    spark._jvm.System.gc()


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from there.

    For results that several parts of a plan use: they are computed once, survive the loss of an
    executor, are read by column, and their true size is known to the joins that follow.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)
