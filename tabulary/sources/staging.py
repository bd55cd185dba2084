"""Intermediate tables, written as Parquet into the shared checkpoint folder.

Unlike a row checkpoint a staged table can be pruned and filtered when it is
read, and a lost executor costs the reading of a file.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

_staged: list[str] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """The path of a new folder in the shared folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _staged.append(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder and read it back."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> None:
    """Delete all staged folders of this process; tables that were read from
    them must have been written elsewhere."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _staged:
        path = jvm.org.apache.hadoop.fs.Path(_staged.pop())
        path.getFileSystem(conf).delete(path, True)
