"""Files and folders of tables, through Hadoop's file systems (any store Spark can reach)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a file or a whole folder; False if there was none."""
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Remove an intermediate folder when the application ends."""
    fs, p = _fs(spark, path)
    fs.deleteOnExit(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path`` (partition values of one level)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly under ``path``; none if it is not there."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def create_new(spark: SparkSession, path: str) -> bool:
    """Make an empty file; False if there is one already."""
    fs, p = _fs(spark, path)
    return fs.createNewFile(p)


def rename(spark: SparkSession, path: str, to: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to))
