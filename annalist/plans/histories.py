"""Event histories per user, built from the events and orders tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing
from ..operators import history
from . import query, table

_STEPS = """
    s AS (SELECT user_id, ts, event_id, event_type AS after, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
    t AS (SELECT *, CASE WHEN before IS NULL THEN 'added' ELSE 'modified' END AS change,
                 row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM s WHERE before IS DISTINCT FROM after),
    b AS (SELECT *, substr(sha256('annalist-event-1|user:' || user_id || '|' || change || '|' || coalesce(before, '') || '|' || after), 1, 24) AS base FROM t)"""


def _transitions(spark, d):
    steps = history.transitions(table(spark, d, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"], "event_type")
    return steps.withColumn("base", hashing.event_id(F.concat(F.lit("user:"), "user_id"), F.col("change"), F.col("before"), F.col("after")))


@query(f"WITH {_STEPS} SELECT user_id, event_id, change, before, after, base FROM b")
def transition_events(spark, d):
    """G3 base ids: one event for each change of a user's state, recurrences too."""
    return _transitions(spark, d).select("user_id", "event_id", "change", "before", "after", "base")


@query(f"""WITH RECURSIVE {_STEPS},
    r AS (SELECT user_id, event_id, n, base AS id, CAST(NULL AS VARCHAR) AS previous_event_id FROM b WHERE n = 1
          UNION ALL
          SELECT b.user_id, b.event_id, b.n, substr(sha256('annalist-event-1-chain|' || b.base || '|' || r.id), 1, 24), r.id
          FROM r JOIN b ON b.user_id = r.user_id AND b.n = r.n + 1)
    SELECT user_id, event_id, id, previous_event_id FROM r""")
def transition_chain(spark, d):
    """The whole history replayed, each id hashed with the one before it."""
    return history.replayed(_transitions(spark, d).drop("event_type"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "id", "previous_event_id")


#: Orders of a customer linked by date: the predecessor is the customer's order before.
_LINKED = """
    e AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS VARCHAR) AS previous_event_id,
                 o_custkey, o_orderstatus, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders)"""


def _linked(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.lag("o_orderkey").over(w).cast("string").alias("previous_event_id"),
        F.lit("order").alias("category"),
        F.col("o_custkey").cast("string").alias("entity"),
        F.lit(None).cast("string").alias("observed_at"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("position"),
    )


@query(f"""WITH {_LINKED} SELECT id, first_value(id) OVER (PARTITION BY o_custkey ORDER BY n) AS root, n - 1 AS depth FROM e""")
def chain_walk(spark, d):
    """G1: root and depth of every event, by pointer doubling."""
    return history.walked(_linked(spark, d)).select("id", "root", "depth")


@query(f"""WITH {_LINKED},
    c AS (SELECT *, sum(CASE WHEN n = 1 OR CAST(id AS BIGINT) % 5 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY n) AS chain FROM e),
    r AS (SELECT *, first_value(CASE WHEN CAST(id AS BIGINT) % 3 > 0 THEN o_orderstatus ELSE '' END) OVER w AS clock, first_value(lpad(id, 12, '0')) OVER w AS place FROM c WINDOW w AS (PARTITION BY o_custkey, chain ORDER BY n))
    SELECT CAST(o_custkey AS VARCHAR) AS entity, arg_max(id, (clock, place, n)) AS id FROM r GROUP BY 1""")
def chain_tails(spark, d):
    """The latest event of each entity: of several chains that of the latest root by clock, unknown ones first, then by place; within it links decide."""
    k = F.col("id").cast("long")
    status = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), "o_orderstatus")
    e = _linked(spark, d).join(status, "id").withColumn("previous_event_id", F.when(k % 5 > 0, F.col("previous_event_id"))).withColumn("observed_at", F.when(k % 3 > 0, F.col("o_orderstatus")))
    return history.tails(e.drop("o_orderstatus")).select("entity", "id")


@query(f"""WITH {_LINKED},
    tail AS (SELECT o_custkey, id, previous_event_id FROM e QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC) = 1),
    c AS (SELECT c_custkey, c_mktsegment, substr(sha256('annalist-event-1|customer:' || c_custkey || '|modified||' || c_mktsegment), 1, 24) AS base FROM customer)
    SELECT CAST(c_custkey AS VARCHAR) AS entity, CASE WHEN id IS NULL THEN base ELSE substr(sha256('annalist-event-1-chain|' || base || '|' || id), 1, 24) END AS id, id AS previous_event_id
    FROM c LEFT JOIN tail ON o_custkey = c_custkey""")
def chained_candidates(spark, d):
    """New events linked to the latest of their entity."""
    old = _linked(spark, d).select("*", F.lit("added").alias("change"), F.lit(None).cast("string").alias("before_sha256"), F.lit("x").alias("after_sha256"))
    new = table(spark, d, "customer").select(
        hashing.event_id(F.concat(F.lit("customer:"), "c_custkey"), F.lit("modified"), F.lit(None).cast("string"), F.col("c_mktsegment")).alias("id"),
        F.lit("order").alias("category"),
        F.col("c_custkey").cast("string").alias("entity"),
        F.lit("modified").alias("change"),
        F.lit(None).cast("string").alias("before_sha256"),
        F.col("c_mktsegment").alias("after_sha256"),
    )
    return history.chained(new, old).select("entity", "id", "previous_event_id")


#: A graph with faults: an order's predecessor is made from its customer, so many are missing, foreign or shared; some pairs of orders follow each other.
_FAULTY = """
    g AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 50 = 0 THEN o_orderkey + 1 WHEN o_orderkey % 50 = 1 THEN o_orderkey - 1 WHEN o_custkey <> o_orderkey THEN o_custkey * 11 END AS p,
                 o_orderstatus AS c, o_orderpriority AS n FROM orders)"""


@query(f"""WITH RECURSIVE {_FAULTY},
    r(id) AS (SELECT id FROM g WHERE p IS NULL OR p NOT IN (SELECT id FROM g) UNION SELECT g.id FROM g JOIN r ON g.p = r.id)
    SELECT 'several-successors' AS rule, CAST(p AS VARCHAR) AS id FROM g WHERE p IS NOT NULL GROUP BY p HAVING count(*) > 1
    UNION ALL SELECT 'missing-predecessor', CAST(g.id AS VARCHAR) FROM g LEFT JOIN g q ON q.id = g.p WHERE g.p IS NOT NULL AND q.id IS NULL
    UNION ALL SELECT 'foreign-predecessor', CAST(g.id AS VARCHAR) FROM g JOIN g q ON q.id = g.p WHERE q.c <> g.c OR q.n <> g.n
    UNION ALL SELECT 'cycle', CAST(id AS VARCHAR) FROM g WHERE id NOT IN (SELECT id FROM r)""")
def graph_violations(spark, d):
    """Faults of an event graph, events that no root reaches among them."""
    k = F.col("o_orderkey")
    e = table(spark, d, "orders").select(
        k.cast("string").alias("id"),
        F.when(k % 50 == 0, k + 1).when(k % 50 == 1, k - 1).when(F.col("o_custkey") != k, F.col("o_custkey") * 11).cast("string").alias("previous_event_id"),
        F.col("o_orderstatus").alias("category"),
        F.col("o_orderpriority").alias("entity"),
    )
    return history.graph_violations(e)


@query("""WITH c AS (SELECT sha256(event_type || '|' || user_id) AS id, props, value FROM events),
               x AS (SELECT DISTINCT sha256(event_type || '|' || user_id) AS id FROM events WHERE ts < TIMESTAMP '2024-01-03')
          SELECT id, min('{"props":' || to_json(props) || '}') AS first FROM c WHERE id NOT IN (SELECT id FROM x) GROUP BY id""")
def event_replay_dedup(spark, d):
    """Candidates without those already known, the first of each id."""
    e = table(spark, d, "events").withColumn("id", hashing.content_sha256(F.concat_ws("|", "event_type", "user_id")))
    fresh = history.deduplicated(e.select("id", "props"), e.where("ts < timestamp_ntz'2024-01-03'").select("id"))
    return fresh.select("id", F.to_json(F.struct("props")).alias("first"))


@query("""SELECT coalesce(n.k, o.k) AS k, CASE WHEN n.k IS NOT NULL THEN n.v ELSE o.v END AS v FROM
          (SELECT user_id || '|' || event_type AS k, max(props) AS v FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1) o
          FULL JOIN (SELECT user_id || '|' || event_type AS k, max(props) AS v FROM events WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY 1) n USING (k)""")
def event_rollup_last_wins(spark, d):
    """A day's events merged, the newer row of an id in place of the older."""
    e = table(spark, d, "events").withColumn("k", F.concat_ws("|", "user_id", "event_type"))
    part = lambda c: e.where(c).groupBy("k").agg(F.max("props").alias("v"))
    return history.rolled_up(part("ts < timestamp_ntz'2024-01-20'"), part("ts >= timestamp_ntz'2024-01-20'"), "k")


@query("""SELECT 'event-altered' AS rule, CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderstatus = 'P'
          UNION ALL SELECT 'event-dropped', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'O'""")
def published_history_kept(spark, d):
    """Published events that a candidate alters or drops."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), "o_orderstatus", "o_totalprice")
    new = o.where("o_orderstatus <> 'O'").withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "P", -1.0).otherwise(F.col("o_totalprice")))
    return history.history_kept(o, new)


_TREE = """
    e AS (SELECT CAST(event_id AS VARCHAR) AS id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, user_id, event_id % 997 = 5 AS late, event_id % 1009 = 7 AS lost, event_id % 1013 = 9 AS edited, day(ts) AS d FROM events),
    o AS (SELECT * FROM e WHERE NOT (late AND d % 3 = 0)),
    n AS (SELECT * FROM e WHERE NOT lost),
    day AS (SELECT DISTINCT date, d FROM e)"""


@query(f"""WITH {_TREE}
    SELECT 'event-dropped' AS rule, id FROM o WHERE lost UNION ALL SELECT 'event-altered', id FROM o WHERE edited AND NOT lost
    UNION ALL SELECT 'baseline-altered', 'events/baseline-2.json' UNION ALL SELECT 'baseline-dropped', 'events/baseline-3.json'
    UNION ALL SELECT 'report-dropped', 'changes/' || date || '.md' FROM day WHERE d % 10 = 4
    UNION ALL SELECT 'report-rewritten-without-events', 'changes/' || date || '.md' FROM day WHERE d % 10 <> 4 AND d % 4 = 1 AND date NOT IN (SELECT date FROM n WHERE id NOT IN (SELECT id FROM o))
    UNION ALL SELECT 'report-without-events', 'changes/2030-01-0' || i || '.md' FROM range(1, 4) t(i)
    UNION ALL SELECT 'day-without-report', date FROM day WHERE d % 10 = 4 AND date IN (SELECT date FROM n)""")
def publication_violations(spark, d):
    """What a candidate does to a published tree: events, the baseline, and reports that may change with new events only."""
    k, day = F.col("event_id"), F.dayofmonth("ts")
    e = table(spark, d, "events").select(k.cast("string").alias("id"), F.to_date("ts").cast("string").alias("date"), "user_id", k.alias("k"), day.alias("d"))
    old = e.where("NOT (k % 997 = 5 AND d % 3 = 0)").select("id", "date", "user_id")
    new = e.where("k % 1009 <> 7").select("id", "date", F.when(F.col("k") % 1013 == 9, -1).otherwise(F.col("user_id")).alias("user_id"))
    days = e.select("date", "d").distinct()
    path = F.concat(F.lit("changes/"), "date", F.lit(".md"))
    row = lambda df, sha: df.select(path.alias("path"), F.lit("report").alias("kind"), "date", sha.alias("sha256"))
    fixed = lambda ids, sha: spark.range(1, 4).where(F.col("id").isin(*ids)).select(F.concat(F.lit("events/baseline-"), "id", F.lit(".json")).alias("path"), F.lit("baseline").alias("kind"), F.lit(None).cast("string").alias("date"), sha.alias("sha256"))
    extra = spark.range(1, 4).select(F.concat(F.lit("2030-01-0"), "id").alias("date"), F.lit(1).alias("d"))
    was = row(days, F.lit("a")).unionByName(fixed([1, 2, 3], F.lit("a")))
    now = row(days.where("d % 10 <> 4").unionByName(extra), F.when(F.col("d") % 4 == 1, "b").otherwise("a")).unionByName(fixed([1, 2], F.when(F.col("id") == 2, "b").otherwise("a")))
    return history.publication_violations(old, new, was, now)
