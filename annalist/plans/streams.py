"""Streaming queries over the events table, drained; their batch forms are the oracle where SQL has one."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.scratch import checkpoint_dir
from ..streaming import changes
from . import query, table


def _checkpoint(spark) -> str:
    return f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex[:12]}"


def _stream(spark, d):
    schema = table(spark, d, "events").schema
    source = spark.readStream.schema(schema).parquet(f"{d}/events.parquet") if _folder(spark, f"{d}/events.parquet") else spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return source.withColumn("ts", F.col("ts").cast("timestamp"))


def _folder(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


@query("""WITH s AS (SELECT user_id, ts, event_type AS after, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS before FROM events)
          SELECT CAST(user_id AS VARCHAR) AS entity, CASE WHEN before IS NULL THEN 'added' ELSE 'modified' END AS change, before, after, count(*) AS n
          FROM s WHERE before IS DISTINCT FROM after GROUP BY ALL""")
def stream_transitions(spark, d):
    """J1, G3 as a stream with state for each entity."""
    rows = _stream(spark, d).select(F.col("user_id").cast("string").alias("entity"), "ts", F.col("event_type").alias("state"))
    out = changes.drained(changes.transitions(rows), _checkpoint(spark))
    return out.groupBy("entity", "change", "before", "after").agg(F.count("*").alias("n"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS change, count(*) AS events FROM events WHERE CAST(ts AS DATE) < (SELECT CAST(max(ts) - INTERVAL 1 DAY AS DATE) FROM events) GROUP BY 1, 2")
def stream_daily_counts(spark, d):
    """The day roll-up under a watermark of one day: days that it has passed."""
    return changes.drained(changes.daily(_stream(spark, d).withColumnRenamed("event_type", "change")), _checkpoint(spark))


@query("SELECT count(*) AS events, count(DISTINCT event_id) AS ids FROM events")
def stream_dedup(spark, d):
    """W2 as a stream: every id once."""
    rows = _stream(spark, d).select(F.col("event_id").alias("id"), "ts")
    out = changes.drained(changes.deduplicated(rows.unionByName(rows)), _checkpoint(spark))
    return out.agg(F.count("*").alias("events"), F.countDistinct("id").alias("ids"))
