"""Appending several outputs as one run: staged together, published once, repeatable.

A run writes all its outputs to a staging folder, marks it complete, moves the files into
the output folders, and at last writes its marker under ``_runs``. Whatever stops it, the
same run id can be started again: without a complete stage the run begins anew, with one the
files that are left are moved, and a run with a marker does nothing. Readers of the output
folders see plain files; folders whose names start with an underscore are hidden from them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.sinks.files import FORMATS, write_files

# Formats that need a package on the class path.
_PACKAGED = ("avro",)


class Folders:
    """Files and folders of the store that a path is in, through Spark's own file system classes."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def files(self, path: str) -> list[str]:
        """Names of the data files right under a folder."""
        names = [status.getPath().getName() for status in self._fs.listStatus(self._path(path))]
        return sorted(name for name in names if not name.startswith(("_", ".")))

    def mark(self, path: str) -> None:
        self._fs.create(self._path(path), True).close()

    def move(self, source: str, target: str) -> None:
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def check_formats(spark: SparkSession, formats: Mapping[str, str]) -> None:
    """Raise ValueError, before anything is written, for a format that is unknown or not installed."""
    for name, file_format in formats.items():
        if file_format not in FORMATS:
            raise ValueError(f"{name}: unknown file format {file_format!r}, known: {', '.join(FORMATS)}")
        if file_format in _PACKAGED and not _installed(spark, file_format):
            raise ValueError(f"{name}: the package for {file_format} files is not on the class path")


def _installed(spark: SparkSession, file_format: str) -> bool:
    provider = {"avro": "org.apache.spark.sql.avro.AvroFileFormat"}[file_format]
    try:
        spark._jvm.org.apache.spark.util.Utils.classForName(provider, True, False)
    except Exception:  # the gateway's error for a class that cannot be found
        return False
    return True


def publish_run(
    spark: SparkSession,
    output_path: str,
    run_id: str,
    outputs: Callable[[], Mapping[str, tuple[DataFrame, str]]],
) -> bool:
    """Append the outputs of a run under ``output_path``; False if the run was published before.

    ``outputs`` makes (table, format) by folder name and is called only if there is
    something to write. Runs with different ids may work at the same time.
    """
    root = output_path.rstrip("/")
    folders = Folders(spark, root)
    stage, marker = f"{root}/_staging/{run_id}", f"{root}/_runs/{run_id}"
    if folders.exists(marker):
        return False
    if not folders.exists(f"{stage}/_complete"):
        folders.delete(stage)
        made = outputs()
        check_formats(spark, {folder: file_format for folder, (_, file_format) in made.items()})
        for folder, (df, file_format) in made.items():
            write_files(df, f"{stage}/{folder}", file_format, "overwrite")
        folders.mark(f"{stage}/_complete")
    for folder in folders.files(stage):
        for name in folders.files(f"{stage}/{folder}"):
            # Spark's file names hold a random id, so they differ from those of other runs.
            folders.move(f"{stage}/{folder}/{name}", f"{root}/{folder}/{name}")
    folders.mark(marker)
    folders.delete(stage)
    return True


def published_runs(spark: SparkSession, output_path: str) -> list[str]:
    """Ids of the runs published under ``output_path``."""
    root = output_path.rstrip("/")
    folders = Folders(spark, root)
    return folders.files(f"{root}/_runs") if folders.exists(f"{root}/_runs") else []
