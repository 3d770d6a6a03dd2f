"""Versioned dataset folders and input checks, on any file system Spark can reach."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    system, hadoop_path = file_system(spark, path)
    return system.exists(hadoop_path)


def has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a table folder holds at least one data file."""
    system, hadoop_path = file_system(spark, path)
    if not system.exists(hadoop_path):
        return False
    files = system.listFiles(hadoop_path, True)
    while files.hasNext():
        if not files.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def versioned_path(base: str, dataset: str, version: str, file: str = "") -> str:
    """``base/dataset/version/file``: every regeneration of a dataset gets its own version."""
    return "/".join(part.strip("/") if i else part.rstrip("/") for i, part in enumerate([base, dataset, version, file]) if part)


def newest_run(spark: SparkSession, base: str) -> str:
    """The run folder with the greatest name under ``base``."""
    system, hadoop_path = file_system(spark, base)
    if not system.exists(hadoop_path):
        raise FileNotFoundError(f"no such folder: {base}")
    runs = [s.getPath() for s in system.listStatus(hadoop_path) if s.isDirectory()]
    if not runs:
        raise FileNotFoundError(f"no run folders in {base}")
    return max(runs, key=lambda path: path.getName()).toString()


def require_files(spark: SparkSession, folder: str, names: Iterable[str]) -> None:
    """Fail with every missing file named, before any work starts."""
    missing = [name for name in names if not exists(spark, f"{folder.rstrip('/')}/{name}")]
    if missing:
        raise FileNotFoundError(f"missing in {folder}: {', '.join(missing)}")
