"""Small files on the store's file system, written and read by the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a whole small file: under another name first, then renamed, so that no reader sees a part of it."""
    fs, target = _fs(spark, path)
    partial = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}.partial")
    out = fs.create(partial, True)
    try:
        out.write(text.encode("utf-8"))
    finally:
        out.close()
    if not fs.rename(partial, target):
        # some file systems do not rename over an existing file
        fs.delete(target, False)
        if not fs.rename(partial, target):
            raise OSError(f"could not rename {partial} to {target}")


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None if there is none."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no folder."""
    fs, target = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(target)) if fs.exists(target) else []
