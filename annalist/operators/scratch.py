"""Lineage cuts for iterative operators, in the folder that spark.checkpoint.dir names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. One of this machine is chosen only where none is set and all executors are in this process."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        own = spark.conf.get("spark.checkpoint.dir", None)
        if not own and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(own or tempfile.mkdtemp(prefix="annalist-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df as a table in the checkpoint folder, read back: computed once, and whole when an executor is lost."""
    path = f"{checkpoint_dir(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Delete tables of `cut` that no plan still to run reads."""
    for table in tables:
        spark = table.sparkSession
        for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
