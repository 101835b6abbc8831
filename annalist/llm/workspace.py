"""Shared scratch space for intermediate tables.

Intermediates are written to the folder the cluster names in
``spark.checkpoint.dir`` so that every executor, and a task that is retried
after an executor is lost, can read them back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators.scratch import checkpoint_dir

#: Id that stands for a null document id: it sorts after every other.
NULL_ID = 2**63 - 1


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str, level: int = 0) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back (cuts lineage); with a level, compressed by zstandard."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write
    if level:
        writer = writer.option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(level))
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete materialised tables that no plan still to run reads, so that the disk holds what is in use only."""
    for table in tables:
        spark = table.sparkSession
        for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            own = spark._jvm.org.apache.hadoop.fs.Path(path)
            own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)


def spread(df: DataFrame) -> DataFrame:
    """df over all cores of the cluster, where a small scan has fewer partitions than there are cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
