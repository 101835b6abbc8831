"""Streams of observations: transitions per entity, replays dropped, daily counts.

Observations are rows (entity string, ts timestamp, state string). State is kept
for each entity by the stream's state store, so a restart goes on where its
checkpoint ended, and a batch that is run again gives the same events.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.hashing import ID_DIGITS, NAMESPACE

OUTPUT = "entity string, ts timestamp, change string, before string, after string, id string, previous_event_id string"
STATE = "value string, known boolean, last string"


def transitions(observations: DataFrame, namespace: str = NAMESPACE) -> DataFrame:
    """One event for each change of an entity's state, ids chained; a null state is a removal.

    Within a batch an entity's rows are taken by ts. A state that repeats gives
    nothing, so replays give nothing either.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        value, known, last = state.get if state.exists else (None, False, None)
        rows = pd.concat(list(frames)).sort_values(["ts", "state"], na_position="first")
        out = []
        for ts, new in zip(rows["ts"], rows["state"], strict=True):
            new = None if pd.isna(new) else new
            if known and new == value or not known and new is None:
                continue
            change = "added" if value is None else "removed" if new is None else "modified"
            parts = [namespace, key[0], change, value or "", new or ""]
            made = hashlib.sha256("|".join(parts).encode()).hexdigest()[:ID_DIGITS]
            if last:
                made = hashlib.sha256(f"{namespace}-chain|{made}|{last}".encode()).hexdigest()[:ID_DIGITS]
            out.append((key[0], ts, change, value, new, made, last))
            value, known, last = new, True, made
        state.update((value, known, last))
        yield pd.DataFrame(out, columns=["entity", "ts", "change", "before", "after", "id", "previous_event_id"])

    return observations.groupBy("entity").applyInPandasWithState(run, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)


def deduplicated(events: DataFrame, late: str = "1 day") -> DataFrame:
    """events (id, ts, ...) with each id once while the watermark keeps it."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["id"])


def daily(events: DataFrame, by: str = "change", late: str = "1 day") -> DataFrame:
    """day, by, events: counts of tumbling days, given when the watermark has passed a day."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", "1 day"), by).agg(F.count("*").alias("events")).select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), by, "events")


def drained(stream: DataFrame, checkpoint: str) -> DataFrame:
    """All that a stream has given so far, as files beside its checkpoint, after what is there now has been read.

    The file sink records each batch, so a batch that is run again counts once.
    """
    out = f"{checkpoint}-out"
    query = stream.writeStream.format("parquet").option("path", out).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)
