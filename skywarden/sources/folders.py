"""Folders of the shared file system: what is there, and what goes.

Stores are trees of ``name=value`` folders.  The driver looks at folder
names only; the data are read and written by Spark's own sources.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, behind any URI."""
    p, fs = _path(spark, path)
    return fs.exists(p)


def values(spark: SparkSession, path: str, name: str) -> list[str]:
    """Values of the ``name=value`` folders right below ``path``, in order."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n[len(name) + 1:] for n in names if n.startswith(name + "="))


def children(spark: SparkSession, path: str) -> list[str]:
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def listing(spark: SparkSession, path: str) -> str | None:
    """Names, sizes and times of the files of a folder; None where there is none."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return None
    return "|".join(sorted(f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}" for s in fs.listStatus(p)))


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)
