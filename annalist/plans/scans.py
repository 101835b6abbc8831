"""Sources: links, sitemaps, lists, registries and retries, over texts made from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing, markup, text, urls
from ..operators import coverage, extract, reconcile, snapshot
from ..sources import files
from . import query, table

_SITE = "https://docs.example.com"


def _gathered(df, keys, order, line, name, sep="\n"):
    """keys and name: lines of a group, in order, as one text."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(rows, lambda x: x["l"]), sep).alias(name))


_CODES = """
    c AS (SELECT c_custkey AS k, md5(c_name) || substr(md5(c_mktsegment), 1, 8) AS h, c_name || '__.' || c_mktsegment AS p FROM customer)"""


@query(rf"""WITH {_CODES}, v AS (SELECT *, CASE k % 4 WHEN 0 THEN h WHEN 1 THEN upper(h) WHEN 2 THEN h || chr(10) ELSE substr(h, 2) END AS x FROM c)
    SELECT k AS custkey, regexp_full_match(x, '[0-9a-fA-F]{{40}}') AS is_commit, lower(regexp_replace(p, '[-_.]+', '-', 'g')) AS python_key, p AS npm_key,
           CASE WHEN k % 3 = 0 THEN 'python' WHEN k % 3 = 1 THEN 'javascript' END AS stream, k % 4 < 3 AS documentation FROM v""")
def scalar_predicates(spark, d):
    """F4, F5, F14, F15."""
    k, h = F.col("c_custkey"), F.concat(F.md5("c_name"), F.substring(F.md5("c_mktsegment"), 1, 8))
    x = F.when(k % 4 == 0, h).when(k % 4 == 1, F.upper(h)).when(k % 4 == 2, F.concat(h, F.lit("\n"))).otherwise(F.substring(h, 2, 60))
    p = F.concat("c_name", F.lit("__."), "c_mktsegment")
    identity = F.concat(F.element_at(F.array(F.lit("pypi:"), F.lit("npm:"), F.lit("docs:")), (k % 3 + 1).cast("int")), k)
    kind = F.element_at(F.array(*[F.lit(t) for t in (*snapshot.DOCUMENT_TYPES, "github-api")]), (k % 4 + 1).cast("int"))
    return table(spark, d, "customer").select(
        k.alias("custkey"),
        text.is_commit(x).alias("is_commit"),
        text.package_key(p, "python").alias("python_key"),
        text.package_key(p, "npm").alias("npm_key"),
        reconcile.sdk_stream(identity, {"pypi:": "python", "npm:": "javascript"}).alias("stream"),
        kind.isin(*snapshot.DOCUMENT_TYPES).alias("documentation"),
    )


@query("""WITH e AS (SELECT event_id, CAST(epoch(ts) AS BIGINT) AS t, CAST(epoch(TIMESTAMP '2024-01-15') AS BIGINT) AS now, [200, 403, 429, 500, 404][1 + event_id % 5] AS status FROM events),
               w AS (SELECT *, CASE event_id % 4 WHEN 0 THEN CAST(event_id % 90 AS DOUBLE) WHEN 1 THEN CAST(t - now AS DOUBLE) END AS asked, event_id % 4 < 3 AS has, event_id % 3 = 0 AS spent, event_id % 2 = 0 AS api FROM e)
          SELECT event_id, CASE WHEN asked IS NOT NULL THEN least(60.0, greatest(0.0, asked)) END AS wait, status >= 500 OR status = 429 OR (status = 403 AND api AND (has OR spent)) AS retried FROM w""")
def retry_decisions(spark, d):
    """Waits that a server asks for, and what is asked again."""
    e, i = table(spark, d, "events"), F.col("event_id")
    second = F.timestamp_seconds(F.rint(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6))  # a date has whole seconds, the nearest
    header = F.when(i % 4 == 0, (i % 90).cast("string")).when(i % 4 == 1, F.concat(F.date_format(second, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))).when(i % 4 == 2, "soon")
    status = F.element_at(F.array(*[F.lit(s) for s in (200, 403, 429, 500, 404)]), (i % 5 + 1).cast("int"))
    return e.select("event_id", text.retry_after(header, F.lit("2024-01-15 00:00:00").cast("timestamp")).alias("wait"), text.retried(status, header, F.when(i % 3 == 0, "0").otherwise("5"), i % 2 == 0).alias("retried"))


@query("""SELECT o_orderkey AS orderkey, CASE WHEN o_orderkey % 4 IN (0, 1) THEN 'https://api.example.com/tags?page=' || o_custkey END AS next FROM orders""")
def next_pages(spark, d):
    """The next page of a list, where it is one of the same list."""
    k = F.col("o_orderkey")
    own = F.concat(F.lit("<https://api.example.com/tags?page="), "o_custkey", F.lit(">; rel="))
    link = F.when(k % 4 == 0, F.concat(F.lit('<https://api.example.com/tags?page=0>; rel="prev", '), own, F.lit('"next"'))).when(k % 4 == 1, F.concat(own, F.lit("next, <https://api.example.com/tags?page=9>; rel=last")))
    link = F.coalesce(link, F.when(k % 4 == 2, F.lit('<https://elsewhere.example.com/tags?page=2>; rel="next"')))
    return table(spark, d, "orders").select(k.alias("orderkey"), urls.next_page(link, "https://api.example.com/tags").alias("next"))


_MAP = f"""
    u AS (SELECT c_nationkey AS nation, c_custkey AS k, CASE WHEN c_custkey % 7 = 0 THEN 'https://other.example.com' ELSE '{_SITE}' END || '/c/' || c_custkey % 40 AS url,
                 CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '2024-01-' || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') END AS lastmod FROM customer),
    m AS (SELECT nation, url, arg_max(lastmod, k) AS lastmod FROM u WHERE url LIKE '{_SITE}/%' GROUP BY ALL)"""


def _sitemaps(spark, d):
    k = F.col("c_custkey")
    loc = F.concat(F.when(k % 7 == 0, "https://other.example.com").otherwise(_SITE), F.lit("/c/"), (k % 40).cast("string"), F.lit(".md"))
    mod = F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("<s:lastmod>2024-01-"), F.lpad((1 + k % 28).cast("string"), 2, "0"), F.lit("</s:lastmod>")))
    entry = F.concat(F.lit("<s:url><s:loc> "), loc, F.lit(" </s:loc>"), mod, F.lit("</s:url>"))
    body = _gathered(table(spark, d, "customer"), [F.col("c_nationkey").alias("nation")], "c_custkey", entry, "b")
    return body.select("nation", F.concat(F.lit('<s:urlset xmlns:s="http://www.sitemaps.org/schemas/sitemap/0.9">'), "b", F.lit("</s:urlset>")).alias("xml"))


@query(f"WITH {_MAP} SELECT * FROM m")
def sitemap_entries(spark, d):
    """Pages of the site, the last entry of each, no lastmod as empty text."""
    return extract.sitemap(_sitemaps(spark, d), ["nation"], "xml", f"{_SITE}/")


@query(f"WITH {_MAP}, one AS (SELECT url, max(lastmod) AS lastmod FROM m GROUP BY 1), p AS (SELECT '{_SITE}/c/' || s_suppkey AS canonical_url FROM supplier) SELECT canonical_url, nullif(lastmod, '') AS upstream_last_modified FROM p LEFT JOIN one ON url = canonical_url")
def page_lastmod(spark, d):
    """Pages with the time that the sitemap gives."""
    entries = extract.sitemap(_sitemaps(spark, d), ["nation"], "xml", f"{_SITE}/").groupBy("url").agg(F.max("lastmod").alias("lastmod"))
    return snapshot.with_lastmod(table(spark, d, "supplier").select(F.concat(F.lit(f"{_SITE}/c/"), "s_suppkey").alias("canonical_url")), entries)


_INDEX = f"""
    l AS (SELECT c_nationkey AS nation, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS pos, c_name AS title, c_custkey AS k,
                 CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END AS description FROM customer),
    t AS (SELECT *, CASE k % 6 WHEN 0 THEN '{_SITE}/index' WHEN 1 THEN 'https://other.example.com/' || k % 20 WHEN 2 THEN 'http://docs.example.com/' || k % 20 ELSE '{_SITE}/p/' || k % 20 END AS url FROM l)"""


def _indexes(spark, d):
    k = F.col("c_custkey")
    target = F.when(k % 6 == 0, "/index.md").when(k % 6 == 1, F.concat(F.lit("https://other.example.com/"), k % 20)).when(k % 6 == 2, F.concat(F.lit("http://docs.example.com/"), k % 20)).otherwise(F.concat(F.lit("/p/./x/../"), k % 20, F.when(k % 6 == 3, ".md?v=1").otherwise("")))
    line = F.concat(F.lit("- ["), "c_name", F.lit("]("), target, F.lit(")"), F.when(k % 5 == 0, "").otherwise(F.concat(F.lit(": "), "c_mktsegment")))
    return _gathered(table(spark, d, "customer"), [F.col("c_nationkey").alias("nation")], "c_custkey", line, "md")


@query(f"WITH {_INDEX} SELECT nation, url, title, description, CAST(pos AS INT) AS pos FROM t WHERE k % 6 > 2 QUALIFY row_number() OVER (PARTITION BY nation, url ORDER BY pos) = 1")
def index_scan(spark, d):
    """Links of Markdown indexes, the first of each page, the index itself left out."""
    return extract.index_links(_indexes(spark, d), ["nation"], "md", f"{_SITE}/", f"{_SITE}/index")


@query(f"WITH {_INDEX} SELECT nation, url, title, CASE k % 6 WHEN 0 THEN 'discovery-index' WHEN 1 THEN 'external-host' ELSE 'non-https' END AS reason FROM t WHERE k % 6 < 3 QUALIFY row_number() OVER (PARTITION BY nation, url ORDER BY pos DESC) = 1")
def index_exclusions(spark, d):
    """Links that are no pages, with the reason and their last title."""
    out = extract.excluded_links(_indexes(spark, d), ["nation"], "md", f"{_SITE}/", f"{_SITE}/index")
    return out.withColumn("url", F.regexp_replace("url", r"\.md$", ""))


_RELEASES = """
    r AS (SELECT DISTINCT p_brand AS package, 'v' || p_size || '.0.' || p_partkey % 3 AS tag, CASE WHEN p_partkey % 4 > 0 THEN p_partkey % 4 = 1 END AS draft, CASE WHEN p_partkey % 5 > 1 THEN p_partkey % 5 = 2 END AS prerelease,
                 CASE WHEN p_partkey % 6 > 0 THEN '2024-01-' || lpad(CAST(1 + p_partkey % 28 AS VARCHAR), 2, '0') END AS published_at FROM part)"""


def _releases(spark, d):
    k = F.col("p_partkey")
    return table(spark, d, "part").select(
        F.col("p_brand").alias("package"),
        F.concat(F.lit("v"), "p_size", F.lit(".0."), (k % 3).cast("string")).alias("tag"),
        F.when(k % 4 > 0, k % 4 == 1).alias("draft"),
        F.when(k % 5 > 1, k % 5 == 2).alias("prerelease"),
        F.when(k % 6 > 0, F.concat(F.lit("2024-01-"), F.lpad((1 + k % 28).cast("string"), 2, "0"))).alias("published_at"),
        k.alias("id"),
    )


@query(f"WITH {_RELEASES} SELECT DISTINCT package, tag, coalesce(draft, false) AS draft, coalesce(prerelease, false) AS prerelease, published_at FROM r")
def release_evidence(spark, d):
    """A list of several pages, checked, volatile columns left out, absent flags false, each row once."""
    rows = _releases(spark, d)
    body = rows.groupBy("package").agg(F.to_json(F.collect_list(F.struct("package", "tag", "draft", "prerelease", "published_at", "id"))).alias("body"))
    schema = "struct<package: string, tag: string, draft: boolean, prerelease: boolean, published_at: string, id: bigint>"
    return files.pages_of_list(body, schema, {"tag": "tag like 'v%'", "package": "package is not null"}, ["package", "tag", "draft", "prerelease", "published_at"], {"draft": False, "prerelease": False})


@query(f"WITH {_RELEASES} SELECT package, list(coalesce(tag, '') ORDER BY coalesce(published_at, ''), coalesce(tag, '')) AS tags FROM (SELECT DISTINCT package, tag, published_at FROM r) GROUP BY 1")
def release_order(spark, d):
    """O2: releases by publication, an unknown time first, then by tag."""
    return reconcile.published_order(_releases(spark, d).select("package", "tag", "published_at").distinct(), ["package"])


@query("""SELECT p_brand AS package, max(p_size || '.' || p_partkey % 7) AS version, list(DISTINCT p_size || '.' || p_partkey % 7 ORDER BY p_size || '.' || p_partkey % 7) AS published FROM part GROUP BY 1""")
def registry_scan(spark, d):
    """A registry's answer about every package, its name folded, its version among the published ones."""
    v = table(spark, d, "part").select(F.col("p_brand").alias("package"), F.concat_ws(".", "p_size", F.col("p_partkey") % 7).alias("v"))
    info = F.struct(F.lower(F.first("package")).alias("name"), F.max("v").alias("version"))
    released = F.map_from_entries(F.transform(F.array_sort(F.collect_set("v")), lambda x: F.struct(x, F.array().cast("array<struct<filename: string>>"))))
    bodies = v.groupBy("package").agg(F.to_json(F.struct(info.alias("info"), released.alias("releases"))).alias("body"))
    return files.registry(bodies, "python", F.col("package"))


@query("""SELECT p_partkey AS partkey, p_name AS name, CASE WHEN p_partkey % 3 > 0 THEN p_size || '.0.1' END AS version FROM part""")
def toml_values(spark, d):
    """Static strings of a project file; a dynamic or missing one is null."""
    k = F.col("p_partkey")
    version = F.when(k % 3 == 0, 'dynamic = ["version"]').otherwise(F.concat(F.lit('version = "'), "p_size", F.lit('.0.1"')))
    body = F.concat(F.lit('[project]\nname = "'), "p_name", F.lit('"\n'), version, F.lit('\n[tool.x]\nversion = "9"\n'))
    return table(spark, d, "part").select(k.alias("partkey"), markup.toml_of(body, "name").alias("name"), markup.toml_of(body, "version").alias("version"))


@query("""SELECT page_id AS source_id, CASE page_id % 4 WHEN 0 THEN 404 WHEN 1 THEN 200 WHEN 2 THEN 200 ELSE 500 END AS status,
                 sha256(CASE page_id % 4 WHEN 1 THEN url WHEN 2 THEN html END) AS sha256 FROM pages""")
def page_forms(spark, d):
    """The first form of a page, the second only where the first is not there."""
    p, k = table(spark, d, "pages").withColumnRenamed("page_id", "source_id"), F.col("source_id")
    first = p.select("source_id", F.when(k % 4 == 1, 200).when(k % 4 == 3, 500).otherwise(404).alias("status"), F.col("url").alias("content"))
    second = p.select("source_id", F.when(k % 4 == 0, 404).otherwise(200).alias("status"), F.col("html").alias("content"))
    return snapshot.fetched_with_fallback(p.select("source_id"), first, second).select("source_id", "status", hashing.content_sha256(F.col("content")).alias("sha256"))


@query("""SELECT c_nationkey AS nation, arg_min(md5(c_name) || substr(md5(c_mktsegment), 1, 8), c_custkey) AS commit FROM customer WHERE c_custkey % 5 > 0 GROUP BY 1""")
def pinned_sources(spark, d):
    """A file at the latest commit of its path."""
    k = F.col("c_custkey")
    commit = F.when(k % 5 > 0, F.concat(F.md5("c_name"), F.substring(F.md5("c_mktsegment"), 1, 8))).otherwise("main")
    rows = table(spark, d, "customer").select(F.col("c_nationkey").alias("repository"), commit.alias("commit"), k.alias("position"))
    return reconcile.pinned(rows, "https://raw.example.com/", "SKILL.md").select(F.col("repository").alias("nation"), F.regexp_extract("url", "^https://raw.example.com/[0-9]+/([0-9a-f]{40})/SKILL.md$", 1).alias("commit"))


@query("""WITH m AS (SELECT 'f' || o_custkey % 3 AS file, CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE 's' || o_custkey END AS source_id, o_orderkey % 11 > 0 AS whole FROM orders)
          SELECT 'incomplete-record' AS rule, source_id AS key FROM m WHERE source_id = '' OR NOT whole
          UNION ALL SELECT 'repeated-record', file || '|' || source_id FROM m GROUP BY file, source_id HAVING count(*) > 1""")
def manifest_scan(spark, d):
    """Records of manifest files that are incomplete or that a file has twice."""
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(F.concat(F.lit("f"), F.col("o_custkey") % 3).alias("file"), F.when(k % 50 == 0, "").otherwise(F.concat(F.lit("s"), "o_custkey")).alias("source_id"), F.when(k % 11 > 0, F.sha2(k.cast("string"), 256)).otherwise("x").alias("sha256"), F.lit("https://x").alias("fetch_url"))
    return files.manifest_violations(rows)


@query("""SELECT event_id, CASE event_id % 9 WHEN 0 THEN 'UTF-8' WHEN 1 THEN 'UTF-8' WHEN 2 THEN 'UTF-16BE' WHEN 3 THEN 'UTF-16LE' WHEN 4 THEN 'UTF-16LE' WHEN 5 THEN 'UTF-32BE' WHEN 6 THEN 'UTF-32LE' WHEN 7 THEN 'UTF-16BE' ELSE 'UTF-8' END AS encoding,
                 CASE WHEN event_id % 9 < 7 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k, CASE WHEN event_id % 9 < 7 THEN 'é😀' || user_id END AS word FROM events""")
def json_encodings(spark, d):
    """JSON bytes in five encodings, with and without a mark; an unpaired surrogate or a stray byte is no JSON."""
    body = F.concat(F.lit('{"w":"é😀'), F.col("user_id").cast("string"), F.lit('",'), F.substring("props", 2, 2**31 - 1))
    wide = F.hex(F.encode(body, "UTF-32"))
    little = F.unhex(F.regexp_replace(wide, "(..)(..)(..)(..)", "$4$3$2$1"))
    le, mark = F.encode(body, "UTF-16LE"), lambda x: F.unhex(F.lit(x))
    n = F.col("event_id") % 9
    data = (
        F.when(n == 0, F.encode(body, "UTF-8"))
        .when(n == 1, F.concat(mark("EFBBBF"), F.encode(body, "UTF-8")))
        .when(n == 2, F.encode(body, "UTF-16BE"))
        .when(n == 3, le)
        .when(n == 4, F.concat(mark("FFFE"), le))
        .when(n == 5, F.concat(mark("0000FEFF"), F.encode(body, "UTF-32")))
        .when(n == 6, little)
        .when(n == 7, F.concat(F.encode(body, "UTF-16BE"), mark("D800")))
        .otherwise(F.concat(F.encode(body, "UTF-8"), mark("FF")))
    )
    read = table(spark, d, "events").select("event_id", data.alias("b")).select("event_id", text.json_encoding(F.col("b")).alias("encoding"), text.bounded_json(text.json_text(F.col("b"))).alias("v"))
    return read.select("event_id", "encoding", F.try_variant_get("v", "$.k", "bigint").alias("k"), F.try_variant_get("v", "$.w", "string").alias("word"))


@query(r"""SELECT event_id, '{' || chr(10) || '  "a": [' || chr(10) || '    ' || user_id || ',' || chr(10) || '    null' || chr(10) || '  ],' || chr(10) || '  "z": "' || event_type || '"' || chr(10) || '}' || chr(10) AS body FROM events""")
def json_layout(spark, d):
    """JSON for people, keys sorted."""
    body = F.to_json(F.struct(F.col("event_type").alias("z"), F.array("user_id", F.lit(None)).alias("a")), {"ignoreNullFields": "false"})
    return table(spark, d, "events").select("event_id", files.laid_out(body).alias("body"))


@query("""WITH cur AS (SELECT doc_id FROM documents WHERE doc_id % 3 > 0), old AS (SELECT doc_id FROM documents WHERE doc_id % 4 > 0),
               c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
          SELECT (SELECT count(*) FROM cur) AS discovered_page_count, (SELECT list(doc_id ORDER BY doc_id) FROM cur WHERE doc_id NOT IN (SELECT doc_id FROM old)) AS newly_discovered,
                 (SELECT list(doc_id ORDER BY doc_id) FROM old WHERE doc_id NOT IN (SELECT doc_id FROM cur)) AS disappeared, (SELECT CAST(sum(n) AS BIGINT) FROM c) AS candidate_event_count,
                 (SELECT string_agg(event_type || '=' || n, ',' ORDER BY event_type) FROM c) AS candidate_event_counts, (SELECT max(ts) FROM events WHERE event_type <> 'error') AS last_successful_fetch""")
def attempt_diagnostics(spark, d):
    """The account of an attempt."""
    docs, e = table(spark, d, "documents").select("doc_id"), table(spark, d, "events")
    fetches = e.select(F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"), F.col("ts").alias("fetched_at"))
    row = coverage.diagnostics(docs.where("doc_id % 3 > 0"), docs.where("doc_id % 4 > 0"), e.withColumnRenamed("event_type", "category"), fetches, "doc_id")
    counts = F.array_join(F.transform(F.map_entries("candidate_event_counts"), lambda x: F.concat(x["key"], F.lit("="), x["value"])), ",")
    return row.withColumn("candidate_event_counts", counts)
