"""Names below a folder, and their removal, on any file system that Spark reads.

Spark's readers list files of data only, so markers and folders are asked for here, through the
file system that Spark itself uses for a path.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths that a pattern finds, in order of name."""
    fs, path = _file_system(spark, pattern)
    return sorted(str(status.getPath().toString()) for status in fs.globStatus(path) or [])


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds; nothing happens if it is not there."""
    fs, found = _file_system(spark, path)
    fs.delete(found, True)
