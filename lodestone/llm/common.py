"""What the operators share: reading tables, and cutting lineage in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, a local session gets a folder of its own; a cluster
    must name one, as executors see no folder of the driver."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="lodestone-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table written to the shared folder: lost executors cost no recomputation."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Deletes a table of ``written`` that nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Scratch:
    """A scope of written tables: on leaving it all but the kept ones are deleted."""

    def __init__(self) -> None:
        self.tables: list[DataFrame] = []

    def __enter__(self) -> Scratch:
        return self

    def written(self, df: DataFrame, name: str) -> DataFrame:
        self.tables.append(written(df, name))
        return self.tables[-1]

    def keep(self, df: DataFrame) -> DataFrame:
        self.tables = [x for x in self.tables if x is not df]
        return df

    def __exit__(self, *_: object) -> None:
        for df in self.tables:
            forget(df)


def input_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of a frame's size: for tables, what their files hold. Where it knows none, as many shuffle
    partitions of 32 MB as the session has. Only for choosing counts of partitions."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(1, size) if size < 1 << 58 else int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) << 25


def dealt(df: DataFrame) -> DataFrame:
    """The side of a join that grows with the input: both sides are dealt out by key, and neither is broadcast however
    small it is here, so the plan is the same at every size and skewed keys can be split."""
    return df.hint("merge")
