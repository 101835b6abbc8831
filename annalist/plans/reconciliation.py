"""Reconciliation, grace periods and claims."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import checks, claims, reconcile
from . import query, table

#: Releases of brands: a version from each part, tags from line items of the part, release rows from orders of the item.
_PARTS = "p AS (SELECT p_partkey, p_brand AS package, p_size || '.' || (p_partkey % 10) || '.' || length(p_name) AS version FROM part)"


def _versions(spark, d):
    return table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("package"), F.concat_ws(".", "p_size", F.col("p_partkey") % 10, F.length("p_name")).alias("version"))


@query(f"""WITH {_PARTS}, v AS (SELECT *, [CAST(x AS INT) FOR x IN string_split(version, '.')] AS t FROM p)
    SELECT package, array_to_string(max(t), '.') AS newest, array_to_string(min(t), '.') AS first, arg_min(p_partkey, (t, p_partkey)) AS introduced_by FROM v GROUP BY package""")
def semver_max_and_first(spark, d):
    """Newest and first versions by number, and what introduced the first."""
    v = _versions(spark, d).withColumn("t", text.version_of(F.col("version")))
    return v.groupBy("package").agg(F.array_join(F.max("t"), ".").alias("newest"), F.array_join(F.min("t"), ".").alias("first"), F.min_by("p_partkey", F.struct("t", "p_partkey")).alias("introduced_by"))


@query("""WITH t AS (SELECT l_partkey AS partkey, min(l_suppkey) AS lo, max(l_suppkey) AS hi FROM lineitem GROUP BY 1)
          SELECT CAST(partkey AS VARCHAR) AS tag, CASE WHEN lo = hi THEN lpad(CAST(lo AS VARCHAR), 9, '0') END AS commit, lo <> hi AS conflicted FROM t""")
def tag_binding_conflicts(spark, d):
    """A part as a tag, its suppliers as commits."""
    rows = table(spark, d, "lineitem").select(F.lit("p").alias("package"), F.col("l_partkey").cast("string").alias("tag"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0").alias("commit"))
    return reconcile.tag_bindings(rows).drop("package")


@query("""WITH b AS (SELECT CAST(l_partkey AS VARCHAR) AS tag, CASE WHEN min(l_suppkey) = max(l_suppkey) THEN min(l_suppkey) END AS commit FROM lineitem GROUP BY 1),
               r AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS tag, l_suppkey AS commit FROM lineitem WHERE l_returnflag = 'R')
          SELECT 'tag-binding' AS rule, tag AS key FROM r LEFT JOIN b USING (tag) WHERE r.commit IS DISTINCT FROM b.commit""")
def tag_binding_violations(spark, d):
    """Retained bindings against the catalog."""
    items = table(spark, d, "lineitem").select(F.lit("p").alias("package"), F.col("l_partkey").cast("string").alias("tag"), F.col("l_suppkey").alias("commit"), "l_returnflag")
    return checks.binding_violations(items.where("l_returnflag = 'R'").select("tag", "commit").distinct(), reconcile.tag_bindings(items).select("tag", "commit"), ["tag"])


_GIT = f"""{_PARTS},
    reg AS (SELECT package, min(version) AS version FROM p GROUP BY 1),
    tags AS (SELECT DISTINCT package, 'v' || version AS tag, l_suppkey AS commit FROM p JOIN lineitem ON l_partkey = p_partkey WHERE l_quantity > 45),
    rel AS (SELECT DISTINCT package, 'v' || version AS tag, l_returnflag = 'R' AS draft, l_linestatus = 'O' AS prerelease FROM p JOIN lineitem ON l_partkey = p_partkey WHERE l_discount > 0.08),
    bound AS (SELECT package, tag, CASE WHEN min(commit) = max(commit) THEN min(commit) END AS commit FROM tags GROUP BY 1, 2),
    st AS (SELECT package, tag, bool_or(draft OR prerelease) AS off, min(draft || ',' || prerelease) <> max(draft || ',' || prerelease) AS bad FROM rel GROUP BY 1, 2),
    git AS (SELECT package, tag FROM bound LEFT JOIN st USING (package, tag) WHERE coalesce(NOT off AND NOT bad, true) UNION ALL SELECT package, tag FROM st WHERE NOT off AND NOT bad),
    newest AS (SELECT package, max([CAST(x AS INT) FOR x IN string_split(substr(tag, 2), '.')]) AS newest FROM git GROUP BY 1),
    mal AS (SELECT package, bool_or(bad) AS mal FROM st GROUP BY 1),
    j AS (SELECT reg.*, [CAST(x AS INT) FOR x IN string_split(version, '.')] AS v, bound.commit, newest, mal, st.tag IS NOT NULL AND NOT st.off AND NOT st.bad AS released
          FROM reg LEFT JOIN bound ON bound.package = reg.package AND bound.tag = 'v' || version LEFT JOIN st ON st.package = reg.package AND st.tag = 'v' || version
          LEFT JOIN newest ON newest.package = reg.package LEFT JOIN mal ON mal.package = reg.package)"""


@query(f"""WITH {_GIT}
    SELECT package, version, CASE WHEN commit IS NOT NULL THEN 'v' || version END AS source_tag, commit AS source_commit,
           concat_ws(',', CASE WHEN newest > v THEN 'git_source_ahead_of_registry' END, CASE WHEN mal THEN 'malformed_release_metadata' END,
                     CASE WHEN newest IS NULL OR newest < v THEN 'registry_ahead_of_git_source' END,
                     CASE WHEN commit IS NULL THEN 'registry_version_missing_git_tag' END, CASE WHEN NOT released THEN 'registry_version_missing_github_release' END) AS discrepancies FROM j""")
def version_reconciliation(spark, d):
    """Registry version against tags and releases, as sorted codes."""
    p = _versions(spark, d)
    items = table(spark, d, "lineitem").withColumnRenamed("l_partkey", "p_partkey").join(p, "p_partkey").withColumn("tag", F.concat(F.lit("v"), "version"))
    registry = p.groupBy("package").agg(F.min("version").alias("version"))
    tags = items.where("l_quantity > 45").select("package", "tag", F.col("l_suppkey").alias("commit")).distinct()
    releases = items.where("l_discount > 0.08").select("package", "tag", (F.col("l_returnflag") == "R").alias("draft"), (F.col("l_linestatus") == "O").alias("prerelease"), F.lit(None).cast("string").alias("published_at")).distinct()
    found = reconcile.reconciled(registry, tags, releases)
    codes = F.array_join(F.array_sort("discrepancies"), ",")
    return found.select("package", "version", "source_tag", "source_commit", codes.alias("discrepancies"))


@query(f"""WITH {_GIT},
    cf AS (SELECT package, CASE WHEN n % 4 = 0 THEN ['release_config_missing'] WHEN n % 4 = 1 THEN ['release_config_malformed']
                  ELSE list_filter([CASE WHEN n % 3 = 0 THEN 'release_config_version_mismatch' END, CASE WHEN n % 5 = 0 THEN 'release_config_name_missing' WHEN n % 7 = 0 THEN 'release_config_name_mismatch' END], lambda x: x IS NOT NULL) END AS extra
           FROM (SELECT DISTINCT package, CAST(substr(package, 7) AS INT) AS n FROM p)),
    d AS (SELECT j.*, extra, list_filter([CASE WHEN newest > v THEN 'git_source_ahead_of_registry' END, CASE WHEN mal THEN 'malformed_release_metadata' END, CASE WHEN newest IS NULL OR newest < v THEN 'registry_ahead_of_git_source' END,
                         CASE WHEN commit IS NULL THEN 'registry_version_missing_git_tag' END, CASE WHEN NOT released THEN 'registry_version_missing_github_release' END], lambda x: x IS NOT NULL) AS codes FROM j JOIN cf USING (package)),
    hi AS (SELECT st.package, string_agg(st.tag || '=' || coalesce(CAST(bound.commit AS VARCHAR), '') || '=' || coalesce(CAST(nt.note AS VARCHAR), ''), ';' ORDER BY st.tag) AS history
           FROM st LEFT JOIN bound ON bound.package = st.package AND bound.tag = st.tag LEFT JOIN (SELECT package, version, min(p_partkey) AS note FROM p WHERE p_partkey % 2 = 0 GROUP BY ALL) nt ON nt.package = st.package AND 'v' || nt.version = st.tag
           WHERE NOT off AND NOT bad GROUP BY 1)
    SELECT d.package, version, CASE WHEN len(extra) = 0 AND commit IS NOT NULL THEN 'v' || version END AS source_tag, CASE WHEN len(extra) = 0 THEN commit END AS source_commit,
           array_to_string(list_sort(list_concat(codes, extra)), ',') AS discrepancies, history FROM d LEFT JOIN hi USING (package)""")
def package_snapshots(spark, d):
    """D1 (J9, J10, A12, O2): everything known of a package's release, a broken configuration leaving its source unknown."""
    p = _versions(spark, d)
    items = table(spark, d, "lineitem").withColumnRenamed("l_partkey", "p_partkey").join(p, "p_partkey").withColumn("tag", F.concat(F.lit("v"), "version"))
    registry = p.groupBy("package").agg(F.min("version").alias("version"))
    tags = items.where("l_quantity > 45").select("package", "tag", F.col("l_suppkey").alias("commit")).distinct()
    releases = items.where("l_discount > 0.08").select("package", "tag", (F.col("l_returnflag") == "R").alias("draft"), (F.col("l_linestatus") == "O").alias("prerelease"), F.lit(None).cast("string").alias("published_at")).distinct()
    n = F.substring("package", 7, 9).cast("int")
    config = registry.select("package", F.lit("npm").alias("kind"), "version", (n % 4 > 0).alias("present"), (n % 4 > 1).alias("parsed"), F.when(n % 5 == 0, None).when(n % 7 == 0, "other").otherwise(F.col("package")).alias("name"), F.when(n % 3 == 0, "0.0.0").otherwise(F.col("version")).alias("found_version"))
    notes = p.where("p_partkey % 2 = 0").select("package", "version", F.col("p_partkey").alias("position"), F.col("p_partkey").cast("string").alias("changes"))
    out = reconcile.package_snapshot(registry, tags, releases, config, notes)
    line = lambda r: F.concat_ws("=", r["tag"], F.coalesce(r["source_commit"].cast("string"), F.lit("")), F.coalesce(r["documented_changes"], F.lit("")))
    return out.select("package", "version", "source_tag", "source_commit", F.array_join("discrepancies", ",").alias("discrepancies"), F.array_join(F.transform("release_history", line), ";").alias("history"))


_CLOCK = """
    f AS (SELECT user_id, max(CASE WHEN event_type = 'error' THEN ts END) AS bad, min(CASE WHEN event_type = 'error' THEN ts END) AS first_bad, max(ts) AS last FROM events GROUP BY 1),
    c AS (SELECT user_id, CASE WHEN bad IS NOT NULL THEN 'discrepancy' ELSE 'up_to_date' END AS status,
                 strftime(first_bad, '%Y-%m-%dT%H:%M:%S') || 'Z' AS since FROM f)"""


def _clock(spark, d):
    e = table(spark, d, "events")
    iso = lambda c: F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    f = e.groupBy("user_id").agg(F.min(F.when(F.col("event_type") == "error", F.col("ts"))).alias("first_bad"))
    return f.select("user_id", F.when(F.col("first_bad").isNotNull(), "discrepancy").otherwise("up_to_date").alias("status"), iso("first_bad").alias("discrepancy_first_observed"))


@query(f"WITH {_CLOCK} SELECT user_id, since AS discrepancy_first_observed FROM c WHERE status = 'discrepancy' AND TIMESTAMP '2024-01-05' - CAST(replace(replace(since, 'T', ' '), 'Z', '') AS TIMESTAMP) >= INTERVAL 3 DAY")
def grace_period_expired(spark, d):
    """discrepancies older than three days at a given time."""
    return reconcile.actionable(_clock(spark, d), F.lit("2024-01-05T00:00:00Z").cast("timestamp")).select("user_id", "discrepancy_first_observed")


@query(f"""WITH {_CLOCK}, cur AS (SELECT user_id, bool_or(event_type = 'error') AS bad FROM events WHERE ts >= TIMESTAMP '2024-01-28' GROUP BY 1)
    SELECT user_id, CASE WHEN bad THEN 'discrepancy' ELSE 'up_to_date' END AS status,
           CASE WHEN bad THEN CASE WHEN c.status = 'discrepancy' THEN since ELSE '2024-02-01T00:00:00Z' END END AS discrepancy_first_observed FROM cur LEFT JOIN c USING (user_id)""")
def discrepancy_since(spark, d):
    """The first time of a discrepancy is kept while it lasts."""
    previous = _clock(spark, d).withColumn("observed_at", F.lit("2024-01-30T00:00:00Z"))
    bad = F.bool_or(F.col("event_type") == "error")
    current = table(spark, d, "events").where("ts >= timestamp_ntz'2024-01-28'").groupBy("user_id").agg(F.when(bad, F.array(F.lit("error"))).otherwise(F.array().cast("array<string>")).alias("discrepancies"))
    return reconcile.discrepancy_since(current, previous, "user_id", F.lit("2024-02-01T00:00:00Z")).drop("discrepancies")


@query(r"""WITH n AS (SELECT item_id AS item, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS t FROM benchmark),
               s AS (SELECT doc_id AS source, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS t FROM documents)
          SELECT item, source FROM n JOIN s ON contains(' ' || s.t || ' ', ' ' || n.t || ' ') WHERE n.t <> ''""")
def claims_contained(spark, d):
    """Which sources hold a claim's text, by an equi-join on its first words and then the text."""
    items = table(spark, d, "benchmark").select(F.col("item_id").alias("item"), F.col("text").alias("item_text"))
    return claims.contained(items, table(spark, d, "documents").select(F.col("doc_id").alias("source"), "text"))


@query(r"""WITH d AS (SELECT doc_id, lang AS package, ' ' || lower(trim(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g'))) || ' ' AS t, [1, doc_id % 50, doc_id // 50] AS v FROM documents),
                p AS (SELECT item_id % 20 AS capability, lower(array_to_string(list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '')[1:2], ' ')) AS phrase FROM benchmark)
          SELECT package, CAST(capability AS VARCHAR) AS capability, array_to_string(min(v), '.') AS version FROM d JOIN p ON contains(t, ' ' || phrase || ' ') WHERE package IS NOT NULL GROUP BY ALL""")
def phrases_introduced(spark, d):
    """The first release whose notes have a phrase of a capability, from a table of phrases, by one automaton."""
    v = F.concat_ws(".", F.lit(1), F.col("doc_id") % 50, F.expr("doc_id div 50"))
    notes = table(spark, d, "documents").where("lang is not null").select(F.col("lang").alias("package"), v.alias("version"), F.col("text").alias("note"))
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    rules = table(spark, d, "benchmark").select((F.col("item_id") % 20).cast("string").alias("capability"), F.array_join(F.slice(words, 1, 2), " ").alias("phrase"))
    return reconcile.introduced(notes, rules).select("package", "capability", "version")


@query("""WITH d AS (SELECT source || '/' || lang AS rule, lang, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
               c AS (SELECT DISTINCT rule, l.lang AS source, ls[1] AS line FROM d, (SELECT DISTINCT lang FROM d) l),
               b AS (SELECT DISTINCT lang AS source, unnest(ls) AS line FROM d)
          SELECT rule, source, bool_and(b.line IS NOT NULL) AS supported FROM c LEFT JOIN b USING (source, line) GROUP BY ALL""")
def claims_all_in_one_source(spark, d):
    """Relational division: in which language every first line of a source's documents stands, found by digest and then by its text."""
    from ..functions.hashing import content_sha256

    docs = table(spark, d, "documents").where("text is not null").select(F.concat_ws("/", "source", "lang").alias("rule"), "lang", F.split("text", "\n").alias("lines"))
    first = F.get("lines", F.lit(0))
    langs = F.broadcast(docs.select(F.col("lang").alias("source")).distinct())  # as many as there are languages
    c = docs.select("rule", content_sha256(first).alias("digest"), F.substring(first, 1, 40).alias("excerpt")).distinct().crossJoin(langs)
    b = docs.select(F.col("lang").alias("source"), F.explode("lines").alias("text")).distinct().withColumn("digest", content_sha256(F.col("text")))
    return claims.supported(c, b)


@query("""SELECT source AS rule, coalesce(bool_or(quality = 1), false) AND NOT coalesce(bool_or(toxic = 1), false) AS recommended
          FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""")
def verdict_precedence(spark, d):
    """Any support and nothing that blocks, per source."""
    rows = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels"), "doc_id", "left")
    return claims.verdict(rows, "source", F.col("quality") == 1, F.col("toxic") == 1).withColumnRenamed("source", "rule")


@query("""WITH cur AS (SELECT user_id, CASE WHEN bool_or(event_type = 'purchase') THEN 'recommended' ELSE 'unknown' END AS status, max(event_type) AS state FROM events WHERE ts >= TIMESTAMP '2024-01-27' GROUP BY 1),
               old AS (SELECT user_id, min(event_type) AS state, strftime(min(ts), '%Y-%m-%d') AS fs, strftime(max(ts), '%Y-%m-%d') AS lv FROM events WHERE ts < TIMESTAMP '2024-01-04' GROUP BY 1)
          SELECT user_id, status, cur.state, CASE WHEN fs IS NOT NULL THEN fs ELSE '2024-02-01' END AS first_seen,
                 CASE WHEN fs IS NOT NULL THEN 'baseline' ELSE 'observed' END AS first_seen_basis, CASE WHEN status = 'recommended' THEN '2024-02-01' ELSE lv END AS last_verified,
                 CASE WHEN fs IS NOT NULL AND cur.state = old.state THEN NULL WHEN fs IS NOT NULL THEN '2024-02-01' END AS last_changed
          FROM cur LEFT JOIN old USING (user_id)""")
def first_seen_state(spark, d):
    """First and last times of a fact over two observations."""
    e, day = table(spark, d, "events"), lambda c: F.date_format(c, "yyyy-MM-dd")
    cur = e.where("ts >= timestamp_ntz'2024-01-27'").groupBy("user_id").agg(F.when(F.bool_or(F.col("event_type") == "purchase"), "recommended").otherwise("unknown").alias("status"), F.max("event_type").alias("state"))
    old = e.where("ts < timestamp_ntz'2024-01-04'").groupBy("user_id").agg(F.min("event_type").alias("state"), day(F.min("ts")).alias("first_seen"), F.lit("baseline").alias("first_seen_basis"), day(F.max("ts")).alias("last_verified"), F.lit(None).cast("string").alias("last_changed"))
    return claims.first_seen(cur, old, "user_id", "state", F.lit("2024-02-01"), F.lit(False))


@query("""SELECT l_shipdate AS day, l_returnflag, count(*) AS items, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY 1, 2""")
def shipped_by_day(spark, d):
    """A3 at the scale of the largest table: three columns are read, one aggregation before the shuffle."""
    return table(spark, d, "lineitem").groupBy(F.col("l_shipdate").alias("day"), "l_returnflag").agg(F.count("*").alias("items"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))
