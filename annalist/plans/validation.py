"""The integrity constraints, each as the rows that break it, and their ordered run."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing
from ..operators import checks, coverage, report
from . import query, table
from .evidence import _RULES, _rules


@query("""SELECT 'missing-output' AS rule, t.name AS key FROM (VALUES ('0-HIGH'), ('1-URGENT'), ('2-HIGH'), ('6-NONE')) t(name) WHERE name NOT IN (SELECT DISTINCT o_orderpriority FROM orders)
          UNION ALL SELECT 'pending-batch', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000""")
def output_violations(spark, d):
    """V1: outputs that must be there, and batches that were begun and not finished."""
    o = table(spark, d, "orders")
    pending = o.where("o_orderstatus = 'P' and o_totalprice > 400000").select(F.col("o_orderkey").cast("string").alias("name"))
    return checks.missing_outputs(o.select(F.col("o_orderpriority").alias("name")).distinct(), ["0-HIGH", "1-URGENT", "2-HIGH", "6-NONE"], pending)


_PAGES = "p AS (SELECT 'd' || doc_id % 997 AS source_id, sha256(text) AS canonical_url, CASE WHEN doc_id % 13 > 0 THEN 'fetched' WHEN doc_id % 2 = 0 THEN 'failed' END AS status FROM documents)"


@query(f"""WITH {_PAGES}
    SELECT 'repeated-id' AS rule, source_id AS key FROM p GROUP BY 2 HAVING count(*) > 1 UNION ALL SELECT 'repeated-url', canonical_url FROM p GROUP BY 2 HAVING count(*) > 1
    UNION ALL SELECT 'page-not-fetched', source_id FROM p WHERE status IS DISTINCT FROM 'fetched'
    UNION ALL SELECT 'summary-disagrees', k FROM (SELECT unnest([CASE WHEN n <> 7 THEN 'discovered' END, CASE WHEN c IS DISTINCT FROM true THEN 'complete' END, CASE WHEN f <> 7 THEN 'failed' END, 'removal-unsafe']) AS k
              FROM (SELECT count(*) AS n, bool_and(status = 'fetched') AS c, count(*) FILTER (status = 'failed') AS f FROM p)) WHERE k IS NOT NULL""")
def coverage_violations(spark, d):
    """V2: a coverage table that contradicts itself."""
    k = F.col("doc_id")
    pages = table(spark, d, "documents").select(F.concat(F.lit("d"), k % 997).alias("source_id"), hashing.content_sha256(F.col("text")).alias("canonical_url"), F.when(k % 13 > 0, "fetched").when(k % 2 == 0, "failed").alias("status"))
    real = pages.agg(F.count_if(F.col("status") == "fetched").alias("fetched"))
    return coverage.violations(pages, real.select(F.lit(7).cast("long").alias("discovered"), "fetched", F.lit(7).cast("long").alias("failed"), F.lit(True).alias("complete"), F.lit(False).alias("removal_safe")))


@query("""SELECT 'practice-evidence' AS rule, CAST(doc_id AS VARCHAR) AS key FROM documents WHERE lang = 'en' AND (doc_id % 7 = 0 OR doc_id % 5 = 0 OR length(text) > 420)""")
def practice_evidence_violations(spark, d):
    """V3: recommended practices without whole evidence, or with excerpts that are too long."""
    k = F.col("doc_id")
    row = F.struct(F.when(k % 5 > 0, "s").otherwise(" ").alias("source_id"), F.lit("u").alias("url"), F.lit("h").alias("sha256"), F.col("text").alias("excerpt"))
    rows = table(spark, d, "documents").select(k.alias("id"), F.when(F.col("lang") == "en", "recommended").otherwise("unknown").alias("status"), F.when(k % 7 > 0, F.array(row)).otherwise(F.array().cast("array<struct<source_id: string, url: string, sha256: string, excerpt: string>>")).alias("evidence"))
    return checks.practice_violations(rows)


@query("""SELECT 'fact' AS rule, CAST(doc_id AS VARCHAR) AS key FROM labels WHERE (quality = 1 AND (toxic = 1 OR doc_id % 3 = 0)) OR (coalesce(quality, 0) <> 1 AND doc_id % 4 = 0)""")
def fact_violations(spark, d):
    """V5: unknown facts with a value, verified ones without one or without evidence."""
    k, good = F.col("doc_id"), F.col("quality") == 1
    rows = table(spark, d, "labels").select(
        k.alias("claim"),
        F.when(good, "verified").otherwise("unknown").alias("status"),
        F.when(good & (F.col("toxic") == 0), "v").when(~F.coalesce(good, F.lit(False)) & (k % 4 == 0), "v").alias("value"),
        F.when(k % 3 > 0, F.array(F.lit("e"))).otherwise(F.array().cast("array<string>")).alias("evidence"),
    )
    return checks.fact_violations(rows)


_ITEMS = """
    i AS (SELECT 'l' || l_linenumber AS layer, CAST(l_orderkey AS VARCHAR) AS id, CASE WHEN l_returnflag = 'N' THEN 'unknown' ELSE 'documented' END AS status, 's' || l_suppkey AS source_id, CASE WHEN l_partkey % 29 = 0 THEN '' ELSE 'h' || l_linenumber END AS sha256, l_partkey % 31 > 0 AS cited FROM lineitem),
    s AS (SELECT 's' || s_suppkey AS source_id, 'h' || unnest([1, 2, 3]) AS sha256 FROM supplier WHERE s_acctbal > 0)"""


@query(f"""WITH {_ITEMS}
    SELECT 'repeated-item' AS rule, layer || '|' || id AS key FROM i GROUP BY layer, id HAVING count(*) > 1 UNION ALL SELECT 'item-without-provenance', id FROM i WHERE NOT cited
    UNION ALL SELECT 'incomplete-provenance', id FROM i WHERE cited AND sha256 = ''
    UNION ALL SELECT DISTINCT 'stale-provenance', id FROM i WHERE cited AND sha256 <> '' AND status <> 'unknown' AND (source_id, sha256) NOT IN (FROM s)""")
def item_violations(spark, d):
    """V4, V8: items whose identity repeats, or whose provenance is missing, partial or no longer current."""
    cite = F.struct(F.concat(F.lit("s"), "l_suppkey").alias("source_id"), F.lit("u").alias("url"), F.when(F.col("l_partkey") % 29 == 0, "").otherwise(F.concat(F.lit("h"), "l_linenumber")).alias("sha256"))
    none = F.array().cast("array<struct<source_id: string, url: string, sha256: string>>")
    items = table(spark, d, "lineitem").select(F.concat(F.lit("l"), "l_linenumber").alias("layer"), F.col("l_orderkey").cast("string").alias("id"), F.when(F.col("l_returnflag") == "N", "unknown").otherwise("documented").alias("status"), F.when(F.col("l_partkey") % 31 > 0, F.array(cite)).otherwise(none).alias("provenance"))
    sources = table(spark, d, "supplier").where("s_acctbal > 0").select(F.concat(F.lit("s"), "s_suppkey").alias("source_id"), F.explode(F.array(*[F.lit(f"h{i}") for i in (1, 2, 3)])).alias("sha256"))
    return checks.item_violations(items, sources)


@query("""SELECT 'limitation-identity' AS rule, CASE WHEN p_partkey % 9 = 0 THEN 'x' ELSE '' END || p_brand || ':' || p_partkey AS key FROM part WHERE p_partkey % 9 = 0
          UNION ALL SELECT 'capability-provenance', CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 8 = 0""")
def identity_violations(spark, d):
    """V9: limitations that do not name their model, capabilities whose source can move."""
    k = F.col("p_partkey")
    limits = table(spark, d, "part").select(F.concat(F.when(k % 9 == 0, "x").otherwise(""), "p_brand", F.lit(":"), k).alias("id"), F.col("p_brand").alias("model"))
    url = F.concat(F.lit("https://x/"), F.when(k % 8 == 0, "main").otherwise(F.md5("p_name")))
    able = table(spark, d, "part").select(k.cast("string").alias("id"), F.md5("p_name").alias("source_commit"), F.array(F.struct(F.lit("https://x/").alias("url")), F.struct(url.alias("url"))).alias("provenance"))
    return checks.identity_violations(limits, able.withColumn("provenance", F.slice("provenance", 2, 1)))


@query(f"""WITH {_RULES},
    pr AS (SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 23 = 0 THEN 'other' ELSE p_name END AS summary, p_size > 25 AS recommended FROM part WHERE p_partkey % 50 > 0),
    rv AS (SELECT ru.id, ru.source, ru.s, CASE WHEN so.source IS NULL THEN 'unavailable' WHEN ru.s % 17 = 0 THEN 'supported' ELSE ju.verdict END AS verdict, so.source IS NOT NULL AS here, ju.verdict AS want
           FROM ru LEFT JOIN so USING (source) LEFT JOIN ju ON ju.id = ru.id AND ju.source = ru.source WHERE ru.s % 19 > 0),
    st AS (SELECT id, bool_or(verdict = 'supported') AND NOT bool_or(verdict IN ('unreviewed', 'rejected')) AS good FROM rv GROUP BY 1)
    SELECT 'practice-inventory' AS rule, coalesce(pr.id, r.id) AS key FROM pr FULL JOIN (SELECT DISTINCT id, summary FROM ru) r ON r.id = pr.id WHERE pr.summary IS DISTINCT FROM r.summary
    UNION ALL SELECT 'configured-reviews', id || '|' || source FROM ru WHERE s % 19 = 0
    UNION ALL SELECT 'review-verdict', id FROM rv WHERE here AND verdict <> want
    UNION ALL SELECT 'practice-status', pr.id FROM pr LEFT JOIN st USING (id) WHERE recommended <> coalesce(good, false)""")
def review_violations(spark, d):
    """V6: practices and their reviews against the rules, the registry of reviews and the sources."""
    from ..operators import claims

    rules, sources, registry = _rules(spark, d)
    k = F.col("p_partkey")
    practices = table(spark, d, "part").where("p_partkey % 50 > 0").select(k.cast("string").alias("id"), F.col("p_brand").alias("category"), F.when(k % 23 == 0, "other").otherwise(F.col("p_name")).alias("summary"), F.when(F.col("p_size") > 25, "recommended").otherwise("unknown").alias("status"))
    s = F.col("source").substr(2, 9).cast("int")
    own = rules.where(s % 19 > 0).select(F.col("id").alias("rule"), "source").join(sources, "source", "left")
    judged = claims.reviewed(own, registry)
    verdict = F.when(F.col("context_sha256").isNull(), "unavailable").when(s % 17 == 0, "supported").otherwise(F.col("verdict"))
    context = F.when(F.col("context_sha256").isNotNull(), F.sha2("context_sha256", 256))
    reviews = judged.select(F.col("rule").alias("id"), "source", verdict.alias("verdict"), context.alias("context_sha256"), "sha256", "url")
    hashed = registry.withColumn("context_sha256", F.sha2("context_sha256", 256))
    return checks.review_violations(practices, rules, reviews, hashed, sources)


_REPORT = "strftime(ts, '%Y-%m-%d')"


@query(f"""WITH days AS (SELECT DISTINCT {_REPORT} AS day FROM events) SELECT 'report' AS rule, day AS key FROM days WHERE CAST(substr(day, 9) AS INT) % 5 < 2 UNION ALL SELECT 'report', '1999-01-01'""")
def report_violations(spark, d):
    """Stored reports that are not the rendering of their events."""
    e = table(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("date"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("id"), F.col("event_type").alias("category"), F.col("user_id").cast("string").alias("entity"), F.lit("seen").alias("change"), F.col("props").alias("summary"))
    made = report.daily_report(e)
    n = F.substring("date", 9, 2).cast("int") % 5
    stored = made.where(n > 0).select("date", F.when(n == 1, F.concat("report", F.lit("!"))).otherwise(F.col("report")).alias("report"))
    gone = spark.createDataFrame([("1999-01-01", "?")], "date string, report string")
    return checks.reports_differ(stored.unionByName(gone), made, "date")


@query(f"""WITH e AS (SELECT CASE WHEN event_id % 50 = 0 THEN '2024-02-01' ELSE {_REPORT} END AS day, {_REPORT} AS date, CAST(event_id - event_id % 40 // 39 AS VARCHAR) AS id FROM events),
               r AS (SELECT DISTINCT date AS day FROM e WHERE CAST(substr(date, 9) AS INT) % 6 > 0 UNION SELECT '1999-01-01')
    SELECT 'repeated-event' AS rule, day || '.json|' || id AS key FROM e GROUP BY day, id HAVING count(*) > 1 UNION ALL SELECT 'event-in-two-files', id FROM e GROUP BY id HAVING min(day) <> max(day)
    UNION ALL SELECT 'event-file-date', day FROM (SELECT DISTINCT day, date FROM e) WHERE day <> date
    UNION ALL SELECT 'day-without-report', day FROM (SELECT DISTINCT day FROM e) WHERE day NOT IN (SELECT day FROM r) UNION ALL SELECT 'orphan-report', day FROM r WHERE day NOT IN (SELECT day FROM e)""")
def event_file_violations(spark, d):
    """Event identities and dates across the day files, reports without days and days without reports."""
    date, k = F.date_format("ts", "yyyy-MM-dd"), F.col("event_id")
    e = table(spark, d, "events").select(F.concat(F.when(k % 50 == 0, "2024-02-01").otherwise(date), F.lit(".json")).alias("file"), date.alias("date"), (k - F.floor(k % 40 / 39)).cast("long").cast("string").alias("id"))
    reports = e.where(F.substring("date", 9, 2).cast("int") % 6 > 0).select(F.col("date").alias("day")).distinct().unionByName(spark.createDataFrame([("1999-01-01",)], "day string"))
    return checks.event_file_violations(e, reports)


@query("SELECT 'fingerprint' AS rule, CAST(c_custkey AS VARCHAR) AS key FROM customer WHERE c_custkey % 12 = 0")
def fingerprint_violations(spark, d):
    """Stored fingerprints that their fields do not give."""
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select(k.cast("string").alias("k"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    stamp = hashing.fingerprint(name=F.col("name"), nation=F.when(F.col("k").cast("int") % 12 == 0, F.col("nation") + 1).otherwise(F.col("nation")))
    return checks.fingerprint_violations(rows.withColumn("fingerprint", stamp), ["name", "nation"], "k")


@query("""WITH f AS (SELECT doc_id FROM labels WHERE (quality = 1 AND (toxic = 1 OR doc_id % 3 = 0)) OR (coalesce(quality, 0) <> 1 AND doc_id % 4 = 0)),
               v AS (SELECT 0 AS ord, 'missing-output' AS rule, t.name AS key FROM (VALUES ('0-HIGH'), ('1-URGENT'), ('2-HIGH'), ('6-NONE')) t(name) WHERE name NOT IN (SELECT DISTINCT o_orderpriority FROM orders)
                     UNION ALL SELECT 0, 'pending-batch', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000
                     UNION ALL SELECT 1, 'fact', CAST(doc_id AS VARCHAR) FROM f UNION ALL SELECT 2, 'fingerprint', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 12 = 0)
          SELECT ord, rule, key FROM v QUALIFY row_number() OVER (ORDER BY ord, rule, key) = 1""")
def first_diagnostic(spark, d):
    """The ordered run of constraints, and the one that is told."""
    return checks.first_diagnostic(checks.ranked(output_violations(spark, d), fact_violations(spark, d), fingerprint_violations(spark, d)))
