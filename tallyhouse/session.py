"""Session settings, session facts and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ENGINE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: start from many shuffle partitions, merge the small
    # ones, split the skewed ones, switch to broadcast when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Window state lives on disk-backed stores, not on the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(
    app_name: str = "tallyhouse",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the engine's settings.

    ``shuffle_partitions`` is the number before AQE merges small partitions: on
    a cluster give it (shuffled bytes / 128 MB), locally the number of cores.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**ENGINE_SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def session_info(spark: SparkSession) -> DataFrame:
    """(name, value) table of version, application, parallelism, user and settings."""
    context = spark.sparkContext
    facts = {
        "version": context.version,
        "appName": context.appName,
        "master": context.master,
        "defaultParallelism": context.defaultParallelism,
        "defaultMinPartitions": context.defaultMinPartitions,
        "sparkUser": context.sparkUser(),
        **dict(context.getConf().getAll()),
    }
    return spark.createDataFrame(
        [(name, str(value)) for name, value in sorted(facts.items())], "name string, value string"
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor reaches, as named in ``spark.checkpoint.dir``.

    A machine-local folder is used only when the master itself is local.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tallyhouse-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def _written_path(spark: SparkSession, name: str = "") -> str:
    return f"{shared_dir(spark)}/tallyhouse/{spark.sparkContext.applicationId}/{name}".rstrip("/")


def remove_written(spark: SparkSession, name: str = "") -> bool:
    """Delete the table ``name`` that :func:`write_through` made, or all tables of this application.

    For the end of a job: results that still read a written table fail afterwards. True if
    there was anything to delete.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_written_path(spark, name))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def write_through(df: DataFrame, name: str | None = None, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    Cuts the lineage: later reads see the same rows whatever executors are lost.
    Without ``name`` the table gets a fresh path; a repeated ``name`` is overwritten.
    With ``by`` each value of that column has a folder of its own, and a filter on it reads
    only that.
    """
    spark = df.sparkSession
    path = _written_path(spark, name or uuid.uuid4().hex)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
