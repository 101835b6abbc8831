"""Event histories: chains, tails, replay, roll-up and graph validity."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hashing
from .scratch import cut, drop


def walked(events: DataFrame) -> DataFrame:
    """Rows (id, previous_event_id, ...) with root (the id its chain starts with) and depth (0 at the root).

    An event whose predecessor is null or absent is a root. Pointer doubling:
    each round every row whose chain has not ended looks twice as far back, so a
    chain of n events takes about log2(n) joins, of ever fewer rows. A round that
    ends no chain is an error: a chain of some depth has an event at every lesser
    depth, so what is still open is a cycle.
    """
    ids = events.select(F.col("id").alias("at")).distinct().withColumn("known", F.lit(True))
    linked = events.select("id", F.col("previous_event_id").alias("at")).join(ids, "at", "left")
    # at: the farthest event seen, of an ended chain its root
    step = cut(linked.select("id", F.when(F.col("known"), F.col("at")).otherwise(F.col("id")).alias("at"), F.coalesce("known", F.lit(False)).alias("open"), F.coalesce("known", F.lit(False)).cast("long").alias("depth")))
    open_, ended = step.where("open"), step.where("NOT open")
    left = open_.count()
    while left:
        far = open_.unionByName(ended).select(F.col("id").alias("at"), F.col("at").alias("at2"), F.col("open").alias("open2"), F.col("depth").alias("d2"))
        step = cut(open_.join(far, "at").select("id", F.col("at2").alias("at"), F.col("open2").alias("open"), (F.col("depth") + F.col("d2")).alias("depth")))
        open_, ended = step.where("open"), ended.unionByName(step.where("NOT open"))
        before, left = left, open_.count()
        if left >= before:
            raise ValueError("event chains have a cycle")
    return events.join(ended.select("id", F.col("at").alias("root"), "depth"), "id")


def tails(events: DataFrame, position: str = "position") -> DataFrame:
    """The latest event of each (category, entity): the chain of the latest root, and of it the deepest event.

    Links decide before clocks do: roots are ordered by observed_at (null as
    empty) and file position, events of one chain by depth only.
    """
    all_ = walked(events)
    roots = all_.where("depth = 0").select(F.col("id").alias("root"), F.coalesce("observed_at", F.lit("")).alias("__at"), F.col(position).alias("__pos"))
    order = F.struct("__at", "__pos", "depth")
    own = [c for c in events.columns if c not in ("category", "entity")]
    return all_.join(roots, "root").groupBy("category", "entity").agg(F.max_by(F.struct(*own), order).alias("r")).select("category", "entity", "r.*")


def chained(candidates: DataFrame, history: DataFrame, namespace: str = hashing.NAMESPACE, position: str = "position") -> DataFrame:
    """Candidates (one for each category and entity) with id and previous_event_id.

    A candidate that repeats the latest transition keeps that event's id and
    predecessor, as a replay does; any other is linked to the latest event and
    its base id is hashed with it.
    """
    last = tails(history, position).select("category", "entity", F.struct("id", "previous_event_id", "change", "before_sha256", "after_sha256").alias("t"))
    same = F.col("t").isNotNull()
    for c in ("change", "before_sha256", "after_sha256"):
        same &= F.col(c).eqNullSafe(F.col(f"t.{c}"))
    rest = [c for c in candidates.columns if c not in ("id", "previous_event_id")]
    return candidates.join(last, ["category", "entity"], "left").select(
        F.when(same, F.col("t.id")).otherwise(hashing.chained_id(F.col("id"), F.col("t.id"), namespace)).alias("id"),
        F.when(same, F.col("t.previous_event_id")).otherwise(F.col("t.id")).alias("previous_event_id"),
        *rest,
    )


def replayed(transitions: DataFrame, keys: list[str], order: list[str], namespace: str = hashing.NAMESPACE) -> DataFrame:
    """Chain ids of a whole history: keys, order, base id and state columns change, before, after -> with id, previous_event_id.

    Each id hashes the one before it, so a key is read in order; a key's rows
    stream through its task with one id held, whatever their number. A row that
    repeats the latest transition is dropped.
    """
    schema = transitions.select(*keys, *order, "change", "before", "after", "base")

    def run(batches):
        key = last = previous = None
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in batch.schema.names]
            out = []
            names = batch.schema.names
            at = {n: i for i, n in enumerate(names)}
            for row in zip(*cols, strict=True):
                own = tuple(row[at[k]] for k in keys)
                if own != key:
                    key, last, previous = own, None, None
                now = tuple(row[at[c]] for c in ("change", "before", "after"))
                if now == last:
                    continue
                base = row[at["base"]]
                made = base if previous is None else hashlib.sha256(f"{namespace}-chain|{base}|{previous}".encode()).hexdigest()[: hashing.ID_DIGITS]
                out.append((*row, made, previous))
                last, previous = now, made
            arrays = list(zip(*out, strict=True)) or [[]] * (len(names) + 2)
            types = [*batch.schema.types, pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(arrays, types, strict=True)], [*names, "id", "previous_event_id"])

    dealt = schema.repartition(*keys).sortWithinPartitions(*keys, *order)
    return dealt.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.schema.fields) + ", id string, previous_event_id string")


def transitions(states: DataFrame, keys: list[str], order: list[str], state: str) -> DataFrame:
    """Rows where a key's state differs from the one before it (the first counts from null): with before, after and change."""
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = states.withColumn("before", F.lag(state).over(w)).withColumn("after", F.col(state)).where(~F.col("before").eqNullSafe(F.col("after")))
    return rows.withColumn("change", F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").otherwise("modified"))


def deduplicated(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Candidates whose id is not in existing (id), one row for each id: the first by the canonical JSON of the row."""
    rest = [c for c in candidates.columns if c != "id"]
    fresh = candidates.join(existing.select("id").distinct(), "id", "left_anti")
    return fresh.groupBy("id").agg(F.min_by(F.struct(*rest), F.to_json(F.struct(*rest))).alias("r")).select("id", "r.*")


def rolled_up(existing: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """A day's events with new ones put in, a new one replacing an old one of its id."""
    rest = [c for c in existing.columns if c != key]
    both = existing.withColumn("__p", F.lit(0)).unionByName(new.withColumn("__p", F.lit(1)))
    return both.groupBy(key).agg(F.max_by(F.struct(*rest), F.col("__p")).alias("r")).select(key, "r.*")


def graph_violations(events: DataFrame, cycles: bool = True) -> DataFrame:
    """(rule, id): predecessors that are missing or of another key, events with two successors, repeated ids, cycles."""
    e = events.select("id", "previous_event_id", "category", "entity")
    repeated = e.groupBy("id").count().where("count > 1").select(F.lit("repeated-id").alias("rule"), "id")
    branches = e.where("previous_event_id is not null").groupBy(F.col("previous_event_id").alias("id")).count().where("count > 1").select(F.lit("several-successors").alias("rule"), "id")
    p = e.select(F.col("id").alias("previous_event_id"), F.col("category").alias("c"), F.col("entity").alias("n"))
    linked = e.where("previous_event_id is not null").join(p, "previous_event_id", "left")
    missing = linked.where("c is null").select(F.lit("missing-predecessor").alias("rule"), "id")
    foreign = linked.where("c <> category or n <> entity").select(F.lit("foreign-predecessor").alias("rule"), "id")
    found = repeated.unionByName(branches).unionByName(missing).unionByName(foreign).distinct()
    if not cycles:
        return found
    return found.unionByName(unrooted(e).select(F.lit("cycle").alias("rule"), "id"))


def unrooted(events: DataFrame) -> DataFrame:
    """Events that no root reaches: pointers are doubled until a round ends no chain.

    After a round whose pointers reach 2^r events back, a chain that is still open
    and ends has an event that ends it in the next round. So if none does, all that
    is open hangs on a cycle, after about log2 of the longest chain that ends.
    """
    ids = events.select(F.col("id").alias("up")).distinct().withColumn("known", F.lit(True))
    tables = [cut(events.select("id", F.col("previous_event_id").alias("up")).join(ids, "up", "left").select("id", F.when(F.col("known"), F.col("up")).alias("up")).distinct())]
    open_, ended = tables[0].where("up is not null"), tables[0].where("up is null")
    left = open_.count()
    while left:
        far = open_.unionByName(ended).select(F.col("id").alias("up"), F.col("up").alias("up2"))
        moved = cut(open_.join(far, "up").select("id", F.col("up2").alias("up")))
        tables.append(moved)
        left = moved.where("up is not null").count()
        if left == moved.count():
            break
        open_, ended = moved.where("up is not null"), ended.unionByName(moved.where("up is null"))
    drop(*tables[:-1])
    return open_.select("id").distinct() if len(tables) == 1 else tables[-1].where("up is not null").select("id").distinct()


def history_kept(previous: DataFrame, candidate: DataFrame) -> DataFrame:
    """(rule, id): events of a published history that a candidate drops or alters; new events and any order are allowed."""
    rest = [c for c in previous.columns if c != "id"]
    h = lambda df, n: df.select("id", F.xxhash64(F.to_json(F.struct(*rest))).alias(n))
    both = h(previous, "a").join(h(candidate, "b"), "id", "left")
    return both.where("b is null or a <> b").select(F.when(F.col("b").isNull(), "event-dropped").otherwise("event-altered").alias("rule"), "id")


def publication_violations(old_events: DataFrame, new_events: DataFrame, old_files: DataFrame, new_files: DataFrame) -> DataFrame:
    """(rule, id): what a candidate must not do to a published tree, as differences of its events and of its files that hang on each other.

    events: id, date and what an event says; files: path, kind (baseline, report or
    other), date and sha256. The baseline may be neither dropped nor altered. An
    event may not be dropped, altered or moved to another day; order is free. A
    report that is dropped, or altered while its day has no event more than before,
    is a violation, and so is a new report of a day without events, or a day with
    events that has no report. New days and files of other kinds are free.
    """
    kept = history_kept(old_events, new_events)
    was = old_files.select("path", "kind", "date", F.col("sha256").alias("was"))
    now = new_files.select("path", F.col("kind").alias("now_kind"), F.col("date").alias("now_date"), F.col("sha256").alias("now"))
    files = was.join(now, "path", "full_outer").select("path", F.coalesce("kind", "now_kind").alias("kind"), F.coalesce("date", "now_date").alias("date"), "was", "now")
    fresh = new_events.select("id", "date").join(old_events.select("id"), "id", "left_anti").select("date").distinct().withColumn("appended", F.lit(True))
    days = new_events.select("date").distinct().withColumn("eventful", F.lit(True))
    told = files.join(fresh, "date", "left").join(days, "date", "left")
    baseline, report = F.col("kind") == "baseline", F.col("kind") == "report"
    altered = F.col("was").isNotNull() & ~F.col("was").eqNullSafe(F.col("now"))
    rule = (
        F.when(baseline & altered, F.when(F.col("now").isNull(), "baseline-dropped").otherwise("baseline-altered"))
        .when(report & altered & F.col("now").isNull(), "report-dropped")
        .when(report & altered & F.col("appended").isNull(), "report-rewritten-without-events")
        .when(report & F.col("was").isNull() & F.col("eventful").isNull(), "report-without-events")
    )
    broken = told.select(rule.alias("rule"), F.col("path").alias("id")).where("rule is not null")
    reported = new_files.where(report).select("date").distinct()
    silent = days.join(reported, "date", "left_anti").select(F.lit("day-without-report").alias("rule"), F.col("date").cast("string").alias("id"))
    return kept.unionByName(broken).unionByName(silent)
