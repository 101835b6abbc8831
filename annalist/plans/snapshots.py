"""Snapshots of sources and layers, built from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing, text
from ..operators import checks, coverage, report, snapshot
from . import query, table

#: Previous sources: all documents. Current: the labelled documents (edited where quality is 0) and all pages.
_SNAPSHOTS = """
    old AS (SELECT 'docs:' || doc_id AS source_id, sha256(text) AS h FROM documents),
    new AS (SELECT 'docs:' || d.doc_id AS source_id, sha256(CASE WHEN l.quality = 0 THEN d.text || '!' ELSE d.text END) AS h
            FROM documents d JOIN labels l USING (doc_id)
            UNION ALL SELECT 'pages:' || page_id, sha256(html) FROM pages)"""


def _artifact(df, prefix, key, body, kind="documentation-page"):
    return df.select(
        F.concat(F.lit(f"{prefix}:"), key).alias("source_id"),
        F.lit(kind).alias("source_type"),
        F.concat(F.lit(f"https://docs.example.com/{prefix}/"), key).alias("url"),
        body.cast("binary").alias("content"),
        *[F.lit(None).cast("string").alias(c) for c in ("discovered_via", "upstream_last_modified", "upstream_commit", "source_tag")],
    )


def _old(spark, d):
    return _artifact(table(spark, d, "documents"), "docs", F.col("doc_id"), F.col("text"))


def _new(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    edited = _artifact(docs, "docs", F.col("doc_id"), F.when(F.col("quality") == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    return edited.unionByName(_artifact(table(spark, d, "pages"), "pages", F.col("page_id"), F.col("html")))


def _hashed(artifacts):
    return artifacts.select("source_id", "source_type", F.col("url").alias("canonical_url"), hashing.content_sha256(F.col("content")).alias("sha256"))


@query(f"""WITH {_SNAPSHOTS},
    c AS (SELECT coalesce(o.source_id, n.source_id) AS entity,
                 CASE WHEN o.source_id IS NULL THEN 'added' WHEN n.source_id IS NULL THEN 'removed' ELSE 'modified' END AS change,
                 o.h AS before_sha256, n.h AS after_sha256
          FROM old o FULL JOIN new n USING (source_id) WHERE o.h IS DISTINCT FROM n.h)
    SELECT substr(sha256('annalist-event-1|source:' || entity || '|' || change || '|' || coalesce(before_sha256, '') || '|' || coalesce(after_sha256, '')), 1, 24) AS id,
           entity, change, before_sha256, after_sha256 FROM c""")
def snapshot_diff_events(spark, d):
    events = snapshot.source_events(_hashed(_old(spark, d)), _hashed(_new(spark, d)), F.lit("2024-02-01T00:00:00Z"))
    return events.select("id", "entity", "change", "before_sha256", "after_sha256")


@query(f"""WITH {_SNAPSHOTS}
    SELECT n.source_id, n.h AS sha256, octet_length(encode(b.body)) AS bytes,
           'https://docs.example.com/' || replace(n.source_id, ':', '/') AS canonical_url,
           CASE WHEN o.h = n.h THEN '2024-01-01' ELSE '2024-02-01' END AS observed_at
    FROM new n LEFT JOIN old o USING (source_id)
    JOIN (SELECT 'docs:' || d.doc_id AS source_id, CASE WHEN l.quality = 0 THEN d.text || '!' ELSE d.text END AS body
          FROM documents d JOIN labels l USING (doc_id)
          UNION ALL SELECT 'pages:' || page_id, html FROM pages) b USING (source_id)""")
def carried_manifest(spark, d):
    """Content hashed once, observed_at carried forward while the hash stays."""
    first = snapshot.manifest(_old(spark, d), spark.createDataFrame([], "source_id string, sha256 string, observed_at string, upstream_last_modified string"), F.lit("2024-01-01"))
    return snapshot.manifest(_new(spark, d), first, F.lit("2024-02-01")).select("source_id", "sha256", "bytes", "canonical_url", "observed_at")


@query("""SELECT o_custkey AS custkey, sha256('{"orders":' || to_json(list({'key': o_orderkey, 'priority': o_orderpriority, 'status': o_orderstatus} ORDER BY o_orderkey)) || '}') AS fingerprint
          FROM orders GROUP BY o_custkey""")
def canonical_fingerprint(spark, d):
    """A10: the hash of each customer's orders as canonical JSON, whatever order rows come in."""
    items = F.struct(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
    rows = table(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(items)).alias("orders"))
    return rows.select(F.col("o_custkey").alias("custkey"), hashing.fingerprint(orders=F.col("orders")).alias("fingerprint"))


#: Layers: every customer, supplier and nation before; after, customers are the ones of large orders, suppliers have another nation where they owe, parts are new.
_LAYERS = """
    old AS (SELECT 'customers' AS layer, CAST(c_custkey AS VARCHAR) AS id, sha256(c_mktsegment) AS h FROM customer
            UNION ALL SELECT 'practices', CAST(s_suppkey AS VARCHAR), sha256(CAST(s_nationkey AS VARCHAR)) FROM supplier
            UNION ALL SELECT 'nations', CAST(n_nationkey AS VARCHAR), sha256(n_name) FROM nation),
    new AS (SELECT 'customers' AS layer, CAST(c_custkey AS VARCHAR) AS id, sha256(CASE WHEN c_acctbal < 0 THEN 'DEBT' ELSE c_mktsegment END) AS h
            FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000)
            UNION ALL SELECT 'practices', CAST(s_suppkey AS VARCHAR), sha256(CAST(s_nationkey + CASE WHEN s_acctbal < 0 THEN 1 ELSE 0 END AS VARCHAR)) FROM supplier WHERE s_acctbal < 9000
            UNION ALL SELECT 'cookbooks', p_brand, sha256(CAST(max(p_size) AS VARCHAR)) FROM part GROUP BY p_brand)"""


def _layers(spark, d):
    h = lambda c: hashing.content_sha256(c.cast("string"))
    row = lambda df, layer, key, state: df.select(F.lit(layer).alias("layer"), F.col(key).cast("string").alias("id"), h(state).alias("state"))
    customer, supplier = table(spark, d, "customer"), table(spark, d, "supplier")
    old = row(customer, "customers", "c_custkey", F.col("c_mktsegment")).unionByName(row(supplier, "practices", "s_suppkey", F.col("s_nationkey"))).unionByName(row(table(spark, d, "nation"), "nations", "n_nationkey", F.col("n_name")))
    large = table(spark, d, "orders").where("o_totalprice > 100000").select(F.col("o_custkey").alias("c_custkey")).distinct()
    kept = customer.join(large, "c_custkey", "left_semi")
    brands = table(spark, d, "part").groupBy("p_brand").agg(F.max("p_size").alias("s"))
    new = (
        row(kept, "customers", "c_custkey", F.when(F.col("c_acctbal") < 0, "DEBT").otherwise(F.col("c_mktsegment")))
        .unionByName(row(supplier.where("s_acctbal < 9000"), "practices", "s_suppkey", F.col("s_nationkey") + F.when(F.col("s_acctbal") < 0, 1).otherwise(0)))
        .unionByName(row(brands, "cookbooks", "p_brand", F.col("s")))
    )
    return old, new


@query(f"""WITH {_LAYERS},
    c AS (SELECT coalesce(o.layer, n.layer) AS layer, coalesce(o.id, n.id) AS id, o.h AS before, n.h AS after,
                 CASE WHEN o.id IS NULL THEN CASE WHEN n.layer = 'practices' THEN 'baseline' ELSE 'added' END
                      WHEN n.id IS NULL THEN CASE WHEN o.layer = 'practices' THEN 'untracked' ELSE 'removed' END ELSE 'modified' END AS change
          FROM old o FULL JOIN (SELECT * FROM new WHERE layer <> 'cookbooks') n ON o.layer = n.layer AND o.id = n.id WHERE o.h IS DISTINCT FROM n.h
          UNION ALL
          SELECT 'cookbooks', NULL, NULL, sha256('{{"items":' || to_json(list({{'id': id, 'state': h}} ORDER BY id, h)) || '}}'), 'baseline' FROM new WHERE layer = 'cookbooks')
    SELECT layer, id, change, before, after,
           substr(sha256('annalist-event-1|' || concat_ws(':', layer, id) || '|' || change || '|' || coalesce(before, '') || '|' || coalesce(after, '')), 1, 24) AS event_id FROM c""")
def semantic_layer_diff(spark, d):
    """Rows of all layers, code-defined and whole-baseline layers told apart."""
    return snapshot.layer_events(*_layers(spark, d))


@query("""SELECT o_orderkey AS orderkey,
                 sha256('{"custkey":' || o_custkey || ',"priority":' || to_json(o_orderpriority) || '}') AS projected,
                 sha256('{"custkey":' || o_custkey || ',"priority":' || to_json(o_orderpriority) || ',"status":' || to_json(o_orderstatus) || '}') AS whole
          FROM orders""")
def semantic_projection(spark, d):
    """A volatile column (the status) is left out before hashing."""
    kept = {"custkey": F.col("o_custkey"), "priority": F.col("o_orderpriority")}
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("orderkey"), hashing.fingerprint(**kept).alias("projected"), hashing.fingerprint(**kept, status=F.col("o_orderstatus")).alias("whole"))


@query("""WITH new AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000)
          SELECT c_custkey AS custkey, c_mktsegment AS segment, CASE WHEN k IS NULL THEN 'unknown' ELSE 'verified' END AS status
          FROM customer LEFT JOIN new ON k = c_custkey""")
def retain_missing_as_unknown(spark, d):
    """Customers without a large finished order stay, as unknown."""
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("segment"), F.lit("verified").alias("status"))
    seen = table(spark, d, "orders").where("o_orderstatus = 'F' and o_totalprice > 300000").select(F.col("o_custkey").alias("custkey")).distinct()
    return snapshot.retained(rows.join(seen, "custkey", "left_semi"), rows, "custkey")


@query("""WITH i AS (SELECT c_custkey AS k, c_mktsegment AS title FROM customer WHERE c_acctbal > 0),
               f AS (SELECT o_custkey AS k, max(o_orderpriority) AS title FROM orders WHERE o_totalprice > 100000 GROUP BY 1)
          SELECT coalesce(i.k, f.k) AS k, coalesce(i.title, f.title) AS title, i.k IS NOT NULL AS indexed, f.k IS NOT NULL AS discovered,
                 concat_ws(',', CASE WHEN i.k IS NOT NULL THEN 'index' END, CASE WHEN f.k IS NOT NULL THEN 'page' END) AS provenance
          FROM i FULL JOIN f ON i.k = f.k""")
def membership_flags_merge(spark, d):
    """Index and discovery in one row, the index's attributes first."""
    i = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("title"), F.array(F.lit("index")).alias("provenance"))
    f = table(spark, d, "orders").where("o_totalprice > 100000").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderpriority").alias("title")).withColumn("provenance", F.array(F.lit("page")))
    return snapshot.merged_membership(i, f, "k", ["title"]).withColumn("provenance", F.array_join("provenance", ","))


@query("""SELECT user_id, event_type AS last_type, value AS last_value FROM (
              SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def last_items_by_key(spark, d):
    """The last row of each key."""
    rows = table(spark, d, "events").select("user_id", F.struct("ts", "event_id").alias("p"), F.col("event_type").alias("last_type"), F.col("value").alias("last_value"))
    return snapshot.last_items(rows, "user_id", "p").select("user_id", "last_type", "last_value")


@query("""SELECT count(*) AS discovered, count(*) FILTER (l.doc_id IS NOT NULL) AS fetched, count(*) FILTER (l.doc_id IS NULL) AS failed,
                 bool_and(l.doc_id IS NOT NULL) AS complete, (SELECT count(*) FROM pages) AS retained
          FROM documents d LEFT JOIN labels l USING (doc_id)""")
def coverage_counts(spark, d):
    """Documents as pages, labels as what was fetched."""
    return coverage.counts(_covered(spark, d), table(spark, d, "pages"))


def _covered(spark, d):
    pages = table(spark, d, "documents").select(F.col("doc_id").alias("source_id"), F.lit("").alias("canonical_url"), F.lit("").alias("title"))
    return coverage.covered(pages, table(spark, d, "labels").select(F.col("doc_id").alias("source_id"), F.lit("x").alias("sha256")))


@query("""SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'newly-discovered' ELSE 'disappeared' END AS delta
          FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000) a
          FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 200000) b USING (k) WHERE a.k IS NULL OR b.k IS NULL""")
def coverage_delta(spark, d):
    """Keys that are new and keys that are gone."""
    side = lambda s: table(spark, d, "orders").where(f"o_orderstatus = '{s}' and o_totalprice > 200000").select(F.col("o_custkey").alias("k")).distinct()
    return coverage.delta(side("F"), side("O"), "k")


@query("""SELECT 'lineitem-order' AS rule, CAST(l_orderkey AS VARCHAR) AS key FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
          UNION ALL SELECT 'lineitem-part', CAST(l_partkey AS VARCHAR) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)
          UNION ALL SELECT 'lineitem-supplier', CAST(l_suppkey AS VARCHAR) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""")
def referential_violations(spark, d):
    """References whose target is missing or not valid."""
    items = table(spark, d, "lineitem")
    return (
        checks.unreferenced(items, "l_orderkey", table(spark, d, "orders").where("o_orderstatus <> 'P'"), "o_orderkey", "lineitem-order")
        .unionByName(checks.unreferenced(items, "l_partkey", table(spark, d, "part").where("p_size > 5"), "p_partkey", "lineitem-part"))
        .unionByName(checks.unreferenced(items, "l_suppkey", table(spark, d, "supplier").where("s_acctbal > 0"), "s_suppkey", "lineitem-supplier"))
    )


@query("SELECT 'repeated-text' AS rule, sha256(text) AS key FROM documents GROUP BY 2 HAVING count(*) > 1")
def duplicate_identity(spark, d):
    """Identities held by more than one row."""
    return checks.repeated(table(spark, d, "documents").select(hashing.content_sha256(F.col("text")).alias("h")), ["h"], "repeated-text")


@query("""SELECT 'layer' AS rule, coalesce(a.k, b.k) AS key FROM
          (SELECT CAST(c_nationkey AS VARCHAR) AS k, CAST(count(*) AS VARCHAR) AS n FROM customer GROUP BY 1) a
          FULL JOIN (SELECT CAST(s_nationkey AS VARCHAR) AS k, CAST(count(*) AS VARCHAR) AS n FROM supplier GROUP BY 1) b USING (k) WHERE a.n IS DISTINCT FROM b.n""")
def set_equality_violations(spark, d):
    """Two keyed tables that must agree."""
    side = lambda t, c: table(spark, d, t).groupBy(F.col(c).cast("string").alias("k")).agg(F.count("*").alias("n"))
    return checks.set_differences(side("customer", "c_nationkey"), side("supplier", "s_nationkey"), ["k"], ["n"], "layer")


@query("""SELECT n_nationkey AS nationkey, n_nationkey IN (SELECT c_nationkey FROM customer) AND n_nationkey NOT IN (SELECT s_nationkey FROM supplier) AS customers_only,
                 n_nationkey IN (SELECT c_nationkey FROM customer) AND n_nationkey IN (SELECT s_nationkey FROM supplier) AS both FROM nation""")
def set_algebra(spark, d):
    """Difference and intersection of key sets."""
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nationkey")).distinct().withColumn("c", F.lit(True))
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nationkey")).distinct().withColumn("s", F.lit(True))
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("nationkey")).join(c, "nationkey", "left").join(s, "nationkey", "left")
    return n.select("nationkey", (F.col("c").isNotNull() & F.col("s").isNull()).alias("customers_only"), (F.col("c").isNotNull() & F.col("s").isNotNull()).alias("both"))


@query("""SELECT strftime(ts, '%Y-%m-%d') AS date, '# Changes on ' || strftime(ts, '%Y-%m-%d') || chr(10) || chr(10) ||
                 string_agg('- **' || event_type || '** `' || user_id || '` seen: ' || props, chr(10) ORDER BY lpad(CAST(event_id AS VARCHAR), 12, '0')) || chr(10) AS report
          FROM events GROUP BY 1""")
def daily_report_lines(spark, d):
    """One deterministic report for each day."""
    e = table(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("date"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("id"), F.col("event_type").alias("category"), F.col("user_id").cast("string").alias("entity"), F.lit("seen").alias("change"), F.col("props").alias("summary"))
    return report.daily_report(e)


@query("SELECT event_type AS category, count(*) AS events FROM events GROUP BY 1")
def category_counts(spark, d):
    """A3."""
    return report.category_counts(table(spark, d, "events").withColumnRenamed("event_type", "category"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS events, coalesce(max(props), 'unknown') AS latest FROM events GROUP BY 1, 2")
def daily_rollup(spark, d):
    """A3, A4: counts by day and type; the streaming form is stream_daily_counts."""
    return table(spark, d, "events").groupBy(text.day(F.col("ts")).alias("day"), "event_type").agg(F.count("*").alias("events"), F.coalesce(F.max("props"), F.lit("unknown")).alias("latest"))
