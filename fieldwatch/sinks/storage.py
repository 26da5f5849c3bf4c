"""Folders in the store, through the file system Spark itself writes with."""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def children(spark: SparkSession, path: str):
    """(path, name, is a folder) of the direct children, hidden ones left out."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return
    it = fs.listStatusIterator(p)
    while it.hasNext():
        s = it.next()
        name = s.getPath().getName()
        if not name.startswith(("_", ".")):
            yield s.getPath().toString(), name, bool(s.isDirectory())


def fingerprint(spark: SparkSession, *folders: str) -> str:
    """A digest of the names, lengths and modification times of all files below the
    folders: equal as long as nobody has written there."""
    found = []
    for folder in folders:
        p, fs = _fs(spark, folder)
        it = fs.listFiles(p, True) if fs.exists(p) else None
        while it is not None and it.hasNext():
            s = it.next()
            found.append(f"{s.getPath()}|{s.getLen()}|{s.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def move(spark: SparkSession, source: str, target_folder: str) -> None:
    p, fs = _fs(spark, source)
    folder, _ = _fs(spark, target_folder)
    fs.mkdirs(folder)
    target, _ = _fs(spark, f"{target_folder.rstrip('/')}/{p.getName()}")
    if not fs.rename(p, target):
        raise RuntimeError(f"cannot move {source} to {target_folder}")


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    if fs.exists(p) and not fs.delete(p, True):
        raise RuntimeError(f"cannot delete {path}")
