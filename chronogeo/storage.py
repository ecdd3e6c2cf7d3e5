"""Where intermediate tables are kept: the folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Only where it is unset, and all executors are threads of this process, a folder of this machine."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not at:
        at = sc.getCheckpointDir()
    if not at:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="chronogeo-")
        delete_on_exit(spark, at)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(at)
    return at


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """The folder goes when the driver ends."""
    p, fs = _path(spark, path)
    fs.deleteOnExit(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, *order: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again, so that later reads are pruned; order: columns that each file is
    sorted by, so that filters on them skip row groups. The files go when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stored-{uuid.uuid4().hex}"
    (df.sortWithinPartitions(*order) if order else df).write.parquet(path)
    delete_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """df in as many tasks as shuffles have, by the columns by. For rows that are small but costly to work on: a number that is given is
    kept, while an exchange without one is coalesced by its bytes, to a task or two. By a hash of the columns: where df is grouped by
    them already, an exchange by the columns themselves would be left out of the plan, and with it the number."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(*by))
