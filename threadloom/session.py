"""Session settings, scratch storage and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Run-time settings every job relies on; cluster sizing stays with the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "threadloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="threadloom-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet, below the shared folder.

    Everything of one application lies in one folder, which can go when the
    application has ended.
    """
    application = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/threadloom/{application}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    A lost executor costs a re-read of one file, not a rerun of the rounds
    that led here, and the parquet footer gives later joins a true size.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(CLEANUP, "false")
    # With the table written, its shuffle files have no reader.
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.scratch = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing reads any more.

    Only for tables whose every reader has itself been written: a lost executor then never needs them again.
    """
    for df in stored:
        delete_path(df.sparkSession, df.scratch)


def delete_path(spark: SparkSession, name: str) -> None:
    """Delete a file or folder wherever Spark can reach it."""
    store, path = _store(spark, name)
    store.delete(path, True)


def is_folder(spark: SparkSession, name: str) -> bool:
    store, path = _store(spark, name)
    return store.getFileStatus(path).isDirectory()


def _store(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything that this application wrote below the shared folder, once its results have been read."""
    delete_path(spark, f"{shared_dir(spark)}/threadloom/{spark.sparkContext.applicationId}")
