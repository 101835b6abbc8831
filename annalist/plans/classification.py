"""The classification of changes over customers as items of six layers, every rule of the truth table met."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing
from ..operators import classify, snapshot, streamed
from . import query, table

#: Columns of an item by customer key k: (Spark SQL and DuckDB alike) before and after.
_LAYER = "CASE k % 6 WHEN 0 THEN 'practices' WHEN 1 THEN 'model-limitations' WHEN 2 THEN 'api' WHEN 3 THEN 'sdk-python' WHEN 4 THEN 'primitives' ELSE 'cookbooks' END"
_OLD = {
    "state": "c_mktsegment",
    "status": "CASE WHEN k % 4 = 0 THEN 'recommended' ELSE 'unknown' END",
    "summary": "CASE WHEN k % 10 > 0 THEN c_mktsegment END",
    "package": "'pkg'",
    "version": "concat('1.', n)",
    "policy": "CASE WHEN layer = 'practices' AND k % 5 > 1 THEN 'source-reviewed-v1' WHEN layer = 'sdk-python' AND k % 4 = 0 THEN 'tag-verified-v1' END",
    "identity": "concat('i', n)",
    "kind": "CASE WHEN k % 4 > 1 THEN 'quote' END",
    "evidence": "concat('e', n)",
    "complete": "CASE WHEN k % 5 > 1 THEN concat('h', n) END",
    "cited": "CASE WHEN k % 8 = 1 THEN '' ELSE concat('c', n) END",
    "reviews": "concat('r', k % 3)",
    "review_urls": "'u'",
    "observed": "concat('o', n)",
    "prior": "CASE WHEN k % 9 > 0 THEN concat('o', n) END",
    "s1": "CASE WHEN k % 3 = 0 THEN 'verified' ELSE 'unknown' END",
    "v1": "concat('v', n)",
    "last1": "CASE WHEN k % 7 = 1 THEN concat('v', n) END",
    "claimed": "k % 5 > 0",
    "source": "CASE WHEN k % 13 > 0 THEN concat('s', n) END",
}
_NEW = _OLD | {
    "state": "CASE WHEN k % 3 = 0 THEN concat(c_mktsegment, '!') ELSE c_mktsegment END",
    "status": "CASE WHEN k % 8 = 0 THEN 'recommended' ELSE 'unknown' END",
    "policy": "CASE WHEN layer = 'practices' THEN 'source-reviewed-v1' WHEN k % 7 > 0 THEN 'tag-verified-v1' END",
    "identity": "concat('i', n + CASE WHEN k % 11 = 0 THEN 1 ELSE 0 END)",
    "kind": "'quote'",
    "evidence": "concat('e', n + CASE WHEN k % 17 = 0 THEN 1 ELSE 0 END)",
    "complete": "concat('h', n + CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END)",
    "reviews": "concat('r', k % 2)",
    "review_urls": "CASE WHEN k % 19 = 0 THEN 'w' ELSE 'u' END",
    "observed": "concat('o', n + CASE WHEN k % 8 = 6 THEN 1 ELSE 0 END)",
    "s1": "CASE WHEN k % 4 > 0 THEN 'verified' ELSE 'unknown' END",
    "v1": "concat('v', n + CASE WHEN k % 5 = 2 THEN 1 ELSE 0 END)",
    "claimed": "k % 11 > 0",
}
_IN_OLD, _IN_NEW, _RULED = "layer <> 'cookbooks' AND k % 7 < 6", "k % 9 < 8", "k % 7 <> 5"


def _items(spark, d, columns, present):
    rows = table(spark, d, "customer").selectExpr("c_custkey AS k", "c_nationkey AS n", "c_mktsegment").selectExpr("*", f"{_LAYER} AS layer").where(present)
    rows = rows.selectExpr("layer", "cast(k as string) AS id", *[f"{e} AS {c}" for c, e in columns.items()])
    one = lambda c: F.when(F.col(c).isNotNull(), F.create_map(F.lit("a"), F.col(c)))
    facts = F.create_map(F.lit("endpoint"), F.struct(F.col("s1").alias("status"), F.col("v1").alias("value"), F.col("last1").alias("last")), F.lit("model"), F.struct(F.lit("verified").alias("status"), F.lit("m").alias("value"), F.lit(None).cast("string").alias("last")))
    return rows.select(
        "layer", "id", *[c for c in columns if c not in ("cited", "observed", "prior", "s1", "v1", "last1", "claimed", "source")],
        F.when(F.col("cited") == "", F.array().cast("array<string>")).otherwise(F.array("cited")).alias("cited"),
        one("observed").alias("observed"), one("prior").alias("prior"),
        F.when((F.col("layer") == "api") & F.col("claimed"), facts).alias("claims"),
        F.when(F.col("source").isNotNull(), F.array(F.struct(F.lit("a").alias("source_id"), F.lit("https://x").alias("url"), F.col("source").alias("sha256")))).otherwise(F.array().cast("array<struct<source_id: string, url: string, sha256: string>>")).alias("sources"),
    )


def _sql(columns, present):
    return f"SELECT layer, CAST(k AS VARCHAR) AS id, k, {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM i WHERE {present}"


@query(f"""WITH i AS (SELECT *, {_LAYER} AS layer FROM (SELECT c_custkey AS k, c_nationkey AS n, c_mktsegment FROM customer)),
    o AS ({_sql(_OLD, _IN_OLD)}), w AS ({_sql(_NEW, _IN_NEW)}),
    b AS (SELECT coalesce(o.layer, w.layer) AS layer, coalesce(o.id, w.id) AS id, coalesce(o.k, w.k) AS k, o, w, o.id IS NOT NULL AS had, w.id IS NOT NULL AS has
          FROM o FULL JOIN (SELECT * FROM w WHERE layer <> 'cookbooks') w ON o.layer = w.layer AND o.id = w.id),
    r AS (SELECT *, layer = 'practices' AND had AND has AND coalesce(o.policy, '') = 'source-reviewed-v1' AND w.policy = 'source-reviewed-v1' AND o.summary IS NOT DISTINCT FROM w.summary
                 AND o.reviews <> w.reviews AND o.review_urls = w.review_urls AND {_RULED} AND o.observed = w.observed AS reviewed FROM b),
    h AS (SELECT *, CASE WHEN had THEN sha256(CASE WHEN reviewed THEN o.state || chr(10) || o.reviews ELSE o.state END) END AS before,
                 CASE WHEN has THEN sha256(CASE WHEN reviewed THEN w.state || chr(10) || w.reviews ELSE w.state END) END AS after,
                 layer = 'sdk-python' AND had AND has AND o.policy IS NULL AND coalesce(w.policy = 'tag-verified-v1', false) AND o.identity = w.identity AS released FROM r),
    e AS (SELECT *, layer = 'model-limitations' AND had AND has AND (o.kind IS NULL OR o.complete IS NULL) AS gained,
                 CASE WHEN had AND has THEN o.evidence = w.evidence AND CASE WHEN o.complete IS NOT NULL THEN o.complete = w.complete ELSE o.cited <> '' AND o.cited = w.cited END END AS same,
                 layer = 'practices' AND had AND has AND o.policy IS NULL AND o.source IS NOT NULL AND {_RULED} AND o.prior IS NOT NULL AND w.observed = o.prior AS adopted,
                 layer = 'api' AND CASE WHEN has THEN w.claimed ELSE o.claimed END AS claimed,
                 CASE WHEN has THEN w.s1 ELSE o.s1 END AS s, CASE WHEN has THEN w.v1 ELSE o.v1 END AS v, CASE WHEN has THEN w.source ELSE o.source END AS source
          FROM h WHERE before IS DISTINCT FROM after OR released),
    f AS (SELECT *, claimed AND had AND o.claimed AS compared, claimed AND NOT (had AND coalesce(o.claimed, false)) AS appeared,
                 s <> o.s1 AS status_moved, s = 'verified' AND coalesce(CASE WHEN o.s1 = 'verified' THEN o.v1 ELSE o.last1 END <> v, false) AS value_moved FROM e),
    n AS (SELECT *, CASE WHEN appeared THEN CASE WHEN source IS NOT NULL THEN 'claims_began' ELSE 'claims_unverified' END
                         WHEN compared AND value_moved THEN 'claims_differ' WHEN compared AND status_moved THEN 'claims_reverified'
                         WHEN gained THEN CASE WHEN same THEN 'limitation_reread' ELSE 'limitation_reread_and_changed' END
                         WHEN adopted THEN 'practice_policy_adopted' WHEN reviewed THEN 'context_reviewed'
                         WHEN layer IN ('practices', 'primitives') AND NOT had THEN 'rule_added' WHEN layer IN ('practices', 'primitives') AND NOT has THEN 'rule_removed'
                         WHEN released THEN 'release_policy_adopted' END AS note FROM f),
    c AS (SELECT *, CASE WHEN note IN ('claims_began', 'limitation_reread', 'practice_policy_adopted', 'rule_added', 'release_policy_adopted') THEN 'baseline'
                         WHEN note IN ('claims_unverified', 'claims_reverified', 'context_reviewed') THEN 'verification_changed' WHEN note = 'rule_removed' THEN 'untracked'
                         WHEN NOT had THEN 'added' WHEN NOT has THEN 'removed' ELSE 'modified' END AS change FROM n),
    x AS (SELECT layer, id, change, note, before, after,
                 CASE WHEN note IS NOT NULL THEN layer || ' ' || id || ' tracking: ' || replace(note, '_', ' ')
                      WHEN layer = 'practices' AND change = 'modified' AND o.status <> w.status THEN 'Practice ' || id || ': ' || o.status || ' -> ' || w.status
                      WHEN CASE WHEN has THEN w.summary ELSE o.summary END IS NOT NULL THEN CASE WHEN has THEN w.summary ELSE o.summary END
                      WHEN layer = 'sdk-python' THEN 'pkg ' || coalesce(o.version, 'unknown') || ' -> ' || coalesce(w.version, 'unknown') ELSE layer || ' ' || id || ' changed' END AS summary
          FROM c
          UNION ALL
          SELECT layer, NULL, 'baseline', 'layer_began', NULL, sha256('{{"items":[' || string_agg('"' || state || '"', ',' ORDER BY id) || ']}}'),
                 'Tracking of ' || layer || ' began with ' || count(*) || ' entries; nothing is said about what was there before.' FROM w WHERE layer = 'cookbooks' GROUP BY layer)
    SELECT *, substr(sha256('annalist-event-1|' || concat_ws(':', layer, id) || '|' || change || '|' || coalesce(before, '') || '|' || coalesce(after, '')), 1, 24) AS event_id FROM x""")
def change_classification(spark, d):
    """D15, 2.11 (C1-C11), F16: every change with its kind and the rule behind it."""
    rules = table(spark, d, "customer").selectExpr("c_custkey AS k").where(_RULED).select(F.col("k").cast("string").alias("id"), F.array(F.lit("a")).alias("sources"))
    return classify.change_events(_items(spark, d, _OLD, _IN_OLD), _items(spark, d, _NEW, _IN_NEW), rules).drop("sources")


@query("""WITH s AS (SELECT o_custkey AS entity, o_orderkey AS p, o_orderstatus <> 'F' AS current, 's' || o_orderkey % 3 AS source_id, o_orderpriority AS sha256,
                            CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey END AS excerpt FROM orders)
          SELECT entity, CASE WHEN current THEN 'current' ELSE 'historical' END AS role, source_id, sha256, CAST(arg_max(excerpt, p) FILTER (excerpt IS NOT NULL) AS VARCHAR) AS excerpt FROM s WHERE entity % 9 > 0 GROUP BY ALL""")
def event_sources(spark, d):
    """Sources of both sides of a change, each once with its role, later attributes over earlier ones."""
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("entity"), k.alias("position"), F.concat(F.lit("s"), k % 3).alias("source_id"), F.when(F.col("o_custkey") % 9 > 0, "https://x").alias("url"), F.col("o_orderpriority").alias("sha256"), F.when(k % 4 > 0, k.cast("string")).alias("excerpt"), "o_orderstatus")
    side = lambda c: rows.where(c).drop("o_orderstatus")
    return classify.role_sources(side("o_orderstatus = 'F'"), side("o_orderstatus <> 'F'"), ["excerpt"]).drop("url")


@query(r"""SELECT l_orderkey AS orderkey, CAST(l_linenumber AS INT) AS line, sha256('{"custs":[{"a":' || l_partkey || '}],"flag":"' || l_returnflag || '"}') AS state
           FROM lineitem""")
def nested_projection(spark, d):
    """Columns that are no news left out, in nested rows too."""
    items = F.array(F.struct(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("provenance")))
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", items.alias("custs"), F.col("l_returnflag").alias("flag"), F.col("l_tax").alias("observed_at"))
    state = classify.projected(rows, without=["observed_at", "l_orderkey", "l_linenumber"], nested={"custs": ["provenance"]})
    from ..functions.hashing import content_sha256

    return rows.select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("line"), content_sha256(state).alias("state"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS id, list(source_id ORDER BY position, source_id) AS sources FROM
          (SELECT o_orderkey, 's' || l_suppkey AS source_id, l_linenumber AS position FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey WHERE s_acctbal > 0) GROUP BY 1""")
def item_provenance(spark, d):
    """The sources of an item that exist, in order."""
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("id"), F.col("l_linenumber").alias("position"), F.concat(F.lit("s"), "l_suppkey").alias("source_id"))
    sources = table(spark, d, "supplier").where("s_acctbal > 0").select(F.concat(F.lit("s"), "s_suppkey").alias("source_id"), F.lit("https://x").alias("url"), F.sha2("s_name", 256).alias("sha256"))
    found = snapshot.provenance(items, sources, F.lit("top"))
    return found.select("id", F.transform("provenance", lambda x: x["source_id"]).alias("sources"))


@query("""WITH i AS (SELECT 'nations' AS layer, CAST(n_nationkey AS VARCHAR) AS id, '{"id":' || n_nationkey || ',"name":"' || n_name || '"}' AS state FROM nation
                     UNION ALL SELECT 'regions', CAST(r_regionkey AS VARCHAR), '{"id":' || r_regionkey || ',"name":"' || r_name || '"}' FROM region),
               w AS (SELECT l.layer, '{"items":[' || coalesce(string_agg(state, ',' ORDER BY id), '') || ']}' AS state FROM (VALUES ('nations'), ('regions'), ('none')) l(layer) LEFT JOIN i USING (layer) GROUP BY 1)
          SELECT layer, sha256(state) AS fingerprint, CASE WHEN layer = 'nations' THEN '2024-01-01' ELSE '2024-02-01' END AS observed_at, (SELECT count(*) FROM i WHERE i.layer = w.layer) AS items FROM w""")
def derived_state(spark, d):
    """All layers of a snapshot, each with a fingerprint and the time since when it is so."""
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    regions = table(spark, d, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    none = spark.createDataFrame([], "layer string, fingerprint string, observed_at string")
    layers = {"nations": nations, "regions": regions, "none": nations.where("id < 0")}
    before = snapshot.derived(layers, none, F.lit("2024-01-01"))[1]
    # the regions had another name
    before = before.withColumn("fingerprint", F.when(F.col("layer") == "nations", F.col("fingerprint")).otherwise("?"))
    items, states = snapshot.derived(layers, before, F.lit("2024-02-01"))
    count = items.groupBy("layer").agg(F.count("*").alias("n"))
    return states.join(count, "layer", "left").select("layer", "fingerprint", "observed_at", F.coalesce("n", F.lit(0)).alias("items"))


@query("""WITH i AS (SELECT l_returnflag AS layer, l_orderkey AS k, l_linenumber AS n, '{"id":' || l_orderkey || ',"n":' || l_linenumber || ',"part":' || l_partkey || '}' AS state FROM lineitem)
          SELECT layer, sha256('{"items":[' || string_agg(state, ',' ORDER BY k, n, state) || ']}') AS fingerprint, count(*) AS items FROM i GROUP BY layer
          UNION ALL SELECT 'all', sha256('{"items":[' || string_agg(state, ',' ORDER BY k, n, state) || ']}'), count(*) FROM i""")
def layer_fingerprints(spark, d):
    """A10: fingerprints of layers with very many items, and of one with all, hashed as they pass in order."""
    state = hashing.canonical_json(F.struct(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("part")))
    rows = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("layer"), "l_orderkey", "l_linenumber", state.alias("state"))
    own, order = streamed.ordered_hash, ["l_orderkey", "l_linenumber", "state"]
    each = own(rows, ["layer"], order, F.col("state"), *snapshot.ITEMS)
    whole = own(rows, [], order, F.col("state"), *snapshot.ITEMS).select(F.lit("all").alias("layer"), "sha256", "n")
    return each.unionByName(whole).select("layer", F.col("sha256").alias("fingerprint"), F.col("n").alias("items"))
