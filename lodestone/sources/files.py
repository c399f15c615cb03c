"""Listing folders of any file system that Spark knows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def folders(spark: SparkSession, root: str) -> list[str]:
    """The folder, and those right below it whose names begin with an underscore: Spark's readers take these for
    hidden unless they are named."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(path(root.rstrip("/") + "/_*")) or []
    return [root, *sorted(s.getPath().toString() for s in found if s.isDirectory())]


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer partitions than half of the session's cores, as one small file is, dealt out over all of them;
    others as they are. It moves what a few cores would else work on alone, and nothing of a table of many files."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df
