"""Files and folders of the shared storage, through Hadoop's file systems.

Needs a classic session (driver and session in one process).
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _opened(spark, path)
    return system.exists(target)


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there."""
    system, target = _opened(spark, folder)
    if not system.exists(target):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(target))


def delete(spark: SparkSession, path: str) -> None:
    system, target = _opened(spark, path)
    system.delete(target, True)


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to ``target``, in place of what was there."""
    system, old = _opened(spark, target)
    system.delete(old, True)
    system.mkdirs(old.getParent())
    if not system.rename(spark._jvm.org.apache.hadoop.fs.Path(source), old):
        raise OSError(f"cannot move {source} to {target}")


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Whether a write to ``folder`` was committed."""
    return exists(spark, f"{folder}/_SUCCESS")


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file; False, and nothing done, if there is one already."""
    system, target = _opened(spark, path)
    system.mkdirs(target.getParent())
    try:
        out = system.create(target, False)
    except Exception:
        if system.exists(target):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, whole."""
    system, target = _opened(spark, path)
    data = system.open(target)
    try:
        return bytes(data.readAllBytes()).decode()
    finally:
        data.close()


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file."""
    system, target = _opened(spark, path)
    return system.getFileStatus(target).getLen()


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since 1970 at which a file or folder was last changed."""
    system, target = _opened(spark, path)
    return system.getFileStatus(target).getModificationTime() / 1000
