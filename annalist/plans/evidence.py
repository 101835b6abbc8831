"""Claims, reviews, practices, limitations, releases and reports, over rows and texts made from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing, markup, text
from ..operators import checks, claims, extract, openapi, reconcile, report, snapshot
from . import query, table
from .scans import _gathered

_RULES = """
    ru AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS category, p_name AS summary, 's' || (p_partkey * 7 + j) % 40 AS source, (p_partkey * 7 + j) % 40 AS s FROM part, range(2) t(j)),
    so AS (SELECT 's' || i AS source, i AS s, 'h' || i AS sha256, 'c' || i AS context FROM range(40) t(i) WHERE i % 9 > 0),
    re AS (SELECT id AS rule, source, CASE WHEN s % 5 = 0 THEN 'rejected' WHEN s % 7 = 0 THEN 'non_conflicting' ELSE 'supported' END AS verdict, s % 11 = 0 AS stale FROM ru WHERE s % 13 > 0),
    ju AS (SELECT ru.id, ru.source, ru.s, CASE WHEN re.rule IS NULL OR stale THEN 'unreviewed' ELSE verdict END AS verdict FROM ru JOIN so USING (source) LEFT JOIN re ON re.rule = ru.id AND re.source = ru.source)"""


def _rules(spark, d):
    p, k = table(spark, d, "part"), F.col("p_partkey")
    s = ((k * 7 + F.col("j")) % 40).cast("int")
    rules = p.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("j")).select(k.cast("string").alias("id"), F.col("p_brand").alias("category"), F.col("p_name").alias("summary"), F.concat(F.lit("s"), s).alias("source"), s.alias("s"))
    sources = spark.range(40).where("id % 9 > 0").select(F.concat(F.lit("s"), "id").alias("source"), F.lit("https://x").alias("url"), F.concat(F.lit("h"), "id").alias("sha256"), F.concat(F.lit("c"), "id").alias("context_sha256"))
    verdict = F.when(F.col("s") % 5 == 0, "rejected").when(F.col("s") % 7 == 0, "non_conflicting").otherwise("supported")
    registry = rules.where("s % 13 > 0").select(F.col("id").alias("rule"), "source", F.concat(F.lit("c"), "s").alias("context_sha256"), F.when(F.col("s") % 11 == 0, "other").otherwise(F.concat(F.lit("h"), "s")).alias("sha256"), F.lit("https://x").alias("url"), verdict.alias("verdict"))
    return rules.drop("s"), sources, registry


@query(f"WITH {_RULES} SELECT id AS rule, source, verdict FROM ju")
def reviewed_contexts(spark, d):
    """What the registry says of each rule's sources, where context, hash and address agree."""
    rules, sources, registry = _rules(spark, d)
    contexts = rules.select(F.col("id").alias("rule"), "source").join(sources, "source")
    return claims.reviewed(contexts, registry).select("rule", "source", "verdict")


@query(f"""WITH {_RULES},
    hj AS (SELECT *, verdict = 'supported' AND s % 4 > 0 AS held FROM ju),
    v AS (SELECT id, bool_or(held) AND NOT bool_or(verdict <> 'non_conflicting' AND NOT held) AS ok, count(*) FILTER (held) AS n FROM hj GROUP BY 1),
    pr AS (SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 3 = 0 THEN p_name || '!' ELSE p_name END AS summary, p_brand AS category, CASE WHEN p_partkey % 5 = 0 THEN 'recommended' ELSE 'unknown' END AS status,
                  CASE WHEN p_partkey % 4 > 0 THEN '2023-01-01' END AS first_seen, CASE p_partkey % 4 WHEN 1 THEN 'observed' WHEN 0 THEN 'not_yet_supported' END AS basis FROM part WHERE p_partkey % 2 = 0),
    j AS (SELECT DISTINCT ru.id, ru.category, ru.summary, coalesce(ok, false) AS ok, pr.id IS NOT NULL AS known, pr.summary AS ps, pr.status AS pst, pr.category AS pc, pr.first_seen AS pf,
                 CASE WHEN pr.id IS NULL THEN 'not_yet_supported' ELSE coalesce(pr.basis, CASE WHEN pr.first_seen IS NOT NULL THEN 'observed' ELSE 'unknown_legacy' END) END AS basis, v.n
          FROM ru LEFT JOIN v ON v.id = ru.id LEFT JOIN pr ON pr.id = ru.id)
    SELECT id, category, summary, CASE WHEN ok THEN 'recommended' ELSE 'unknown' END AS status, CASE WHEN ok AND basis = 'not_yet_supported' THEN '2024-02-01' ELSE pf END AS first_seen,
           CASE WHEN ok AND basis = 'not_yet_supported' THEN 'observed' ELSE basis END AS first_seen_basis, CASE WHEN ok THEN '2024-02-01' WHEN ps = summary THEN '2023-06-01' END AS last_verified,
           CASE WHEN known AND ps = summary AND pc = category AND pst = CASE WHEN ok THEN 'recommended' ELSE 'unknown' END THEN '2023-03-01' ELSE '2024-02-01' END AS last_changed,
           CASE WHEN ok THEN CAST(n AS INT) ELSE 0 END AS evidence FROM j""")
def practices_state(spark, d):
    """D4 (J12, J13, A13, A11, F13, P6): the state of every practice from reviews and literal claims."""
    rules, sources, registry = _rules(spark, d)
    own = rules.select("id").distinct().select("id", F.lit("d").alias("digest"), F.concat(F.lit("claim "), "id").alias("excerpt"))
    # a block of every source says all claims, but for one source in four
    every = rules.select("source", "id").distinct().where("cast(substr(source, 2) as int) % 4 > 0")
    blocks = every.select("source", F.lit("d").alias("digest"), F.concat(F.lit("so: claim "), "id", F.lit(".")).alias("text"))
    p, k = table(spark, d, "part").where("p_partkey % 2 = 0"), F.col("p_partkey")
    evidence = "array<struct<source: string, url: string, sha256: string, context_sha256: string, excerpt: string>>"
    previous = p.select(
        k.cast("string").alias("id"),
        F.when(k % 3 == 0, F.concat("p_name", F.lit("!"))).otherwise(F.col("p_name")).alias("summary"),
        F.col("p_brand").alias("category"),
        F.when(k % 5 == 0, "recommended").otherwise("unknown").alias("status"),
        F.when(k % 4 > 0, "2023-01-01").alias("first_seen"),
        F.when(k % 4 == 1, "observed").when(k % 4 == 0, "not_yet_supported").alias("first_seen_basis"),
        F.lit("2023-06-01").alias("last_verified"),
        F.lit("2023-03-01").alias("last_changed"),
        F.array().cast(evidence).alias("evidence"),
    )
    out = claims.practices(rules, own, sources, blocks, registry, previous, F.lit("2024-02-01"))
    return out.withColumn("evidence", F.size("evidence"))


@query("""WITH s AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'm-2' ELSE 'm-1' END AS model, 'sec' || c_custkey % 10 AS section, c_custkey % 4 AS t, CASE WHEN c_custkey % 5 > 0 THEN c_custkey % 3 END AS c FROM customer)
          SELECT k, CASE WHEN ok THEN 'read ' || section END AS summary, CASE WHEN ok THEN 'repository-interpretation' ELSE 'unknown' END AS summary_kind
          FROM (SELECT *, model = 'm-1' AND CAST(substr(section, 4) AS INT) < 8 AND CASE WHEN c IS NOT NULL THEN c = CAST(substr(section, 4) AS INT) % 3 ELSE t = CAST(substr(section, 4) AS INT) % 4 END AS ok FROM s)""")
def limitation_interpretations(spark, d):
    """a reviewed reading of a section, while the hash of the section stands."""
    k = F.col("c_custkey")
    sections = table(spark, d, "customer").select(k.alias("k"), F.when(k % 3 == 0, "m-2").otherwise("m-1").alias("model"), F.concat(F.lit("sec"), k % 10).alias("section"), (k % 4).cast("string").alias("text_sha256"), F.when(k % 5 > 0, (k % 3).cast("string")).alias("complete_sha256"))
    registry = spark.range(8).select(F.concat(F.lit("sec"), "id").alias("section"), (F.col("id") % 4).cast("string").alias("text_sha256"), (F.col("id") % 3).cast("string").alias("complete_sha256"), F.concat(F.lit("read sec"), "id").alias("summary"))
    return claims.interpreted(sections, registry, "m-1").select("k", "summary", "summary_kind")


@query("""WITH s AS (SELECT c_nationkey AS n, c_custkey AS k, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS r, c_mktsegment AS seg FROM customer)
          SELECT n AS nation, 'm-' || n || ':section-' || k AS id, 'Section ' || k AS title, 'm-' || n AS model, '2024-01-05' AS reviewed, sha256('About ' || seg || ' first.') AS text_sha256,
                 sha256('About ' || seg || ' first. More of it here.') AS complete_sha256 FROM s""")
def limitation_sections(spark, d):
    """Sections of pages about a model, with hashes of their first sentence and of the whole."""
    k = F.col("c_custkey")
    section = F.concat(F.when(k % 2 == 0, "## ").otherwise("### "), F.lit("Section "), k, F.lit("\n\nAbout  "), "c_mktsegment", F.lit("\nfirst.  More of\n\nit here.\n"))
    pages = _gathered(table(spark, d, "customer"), [F.col("c_nationkey").alias("nation")], "c_custkey", section, "body")
    md = F.concat(F.lit("# Limits\n\nApplies to `m-"), "nation", F.lit("`. Last reviewed 2024-01-05.\n\n"), "body")
    return extract.limitation_sections(pages.select("nation", md.alias("md")), ["nation"], "md")


@query("""SELECT item_id, CASE WHEN item_id % 6 = 0 THEN 'unknown' WHEN item_id % 6 = 1 THEN 'unknown' WHEN item_id % 6 = 2 THEN 'unknown' WHEN item_id % 6 = 3 THEN 'unknown' WHEN length(substr(text, 1, 240)) > 0 THEN 'verified' ELSE 'unknown' END AS status FROM benchmark""")
def verified_facts(spark, d):
    """a value with passages that its source has, none too long."""
    k, t = F.col("item_id"), F.col("text")
    passages = F.when(k % 6 == 0, F.array().cast("array<string>")).when(k % 6 == 1, F.array(F.substring(t, 1, 40), F.lit("\u0001 not there"))).when(k % 6 == 3, F.array(F.rpad(t, 241, "x"))).otherwise(F.array(F.substring(t, 1, 240)))
    value = F.when(k % 6 != 2, F.lit("v"))
    source = F.concat(t, F.rpad(t, 241, "x"))
    return table(spark, d, "benchmark").select("item_id", claims.verified(value, passages, source, F.lit("s")).alias("status"))


_STREAMS = "k % 3 = 0"


@query("""WITH c AS (SELECT s_suppkey AS k, s_suppkey % 4 = 0 AS bad, s_suppkey % 5 > 0 AS had, s_suppkey % 7 = 0 AS was_bad, s_nationkey AS v FROM supplier)
          SELECT k, bad AND had AS held, CASE WHEN bad AND had THEN v + 100 ELSE v END AS version FROM c""")
def held_streams(spark, d):
    """the earlier state stays where the new one has discrepancies."""
    k = F.col("s_suppkey")
    none = F.array().cast("array<string>")
    c = table(spark, d, "supplier").select(k.alias("k"), F.col("s_nationkey").alias("version"), F.when(k % 4 == 0, F.array(F.lit("code"))).otherwise(none).alias("discrepancies"))
    p = table(spark, d, "supplier").where("s_suppkey % 5 > 0").select(k.alias("k"), (F.col("s_nationkey") + 100).alias("version"), none.alias("discrepancies"))
    return snapshot.held_streams(c, p, "k", "discrepancies").select("k", F.coalesce("held", F.lit(False)).alias("held"), "version")


@query("""WITH c AS (SELECT 'pypi:' || c_custkey AS id, c_nationkey % 3 AS st, 'new' AS v FROM customer WHERE c_custkey % 5 > 0), p AS (SELECT 'pypi:' || c_custkey AS id, c_nationkey % 3 AS st, 'old' AS v FROM customer WHERE c_custkey % 4 > 0)
          SELECT CASE WHEN st = 0 THEN 'candidate:' || id ELSE id END AS source_id, CAST(st AS VARCHAR) AS stream, v AS sha256 FROM c UNION ALL SELECT id, CAST(st AS VARCHAR), v FROM p WHERE st = 0""")
def readmitted_records(spark, d):
    """Records of a held stream stay, the new ones beside them as candidates."""
    rows = lambda v: table(spark, d, "customer").select(F.concat(F.lit("pypi:"), "c_custkey").alias("source_id"), (F.col("c_nationkey") % 3).cast("string").alias("stream"), F.lit(v).alias("sha256"), "c_custkey")
    held = spark.createDataFrame([("0",)], "stream string")
    return snapshot.readmitted(rows("new").where("c_custkey % 5 > 0").drop("c_custkey"), rows("old").where("c_custkey % 4 > 0").drop("c_custkey"), F.col("stream"), held)


@query("""WITH r AS (SELECT o_orderkey AS k, md5(CAST(o_orderkey AS VARCHAR)) || '01234567' AS c FROM orders)
          SELECT k AS orderkey, k % 5 IN (0, 1) AS trusted FROM r""")
def trusted_locations(spark, d):
    """addresses that a record's type and identity allow."""
    k = F.col("o_orderkey")
    commit = F.concat(F.md5(k.cast("string")), F.lit("01234567"))
    shapes = [("page", r"docs:[0-9]+", "https://docs.example.com/a"), ("file", r"repo:README\.md", "https://raw.example.com/{commit}/README.md"), ("tag", "repo:tag", "https://example.com/{tag}")]
    kind = F.when(k % 5 == 0, "page").when(k % 5 == 4, "tag").otherwise("file")
    identity = F.when(k % 5 == 0, F.concat(F.lit("docs:"), k)).when(k % 5 == 3, "repo:other").when(k % 5 == 4, "repo:tag").otherwise("repo:README.md")
    url = F.when(k % 5 == 0, "https://docs.example.com/a").when(k % 5 == 2, "https://raw.example.com/main/README.md").when(k % 5 == 4, "https://example.com/v2").otherwise(F.concat(F.lit("https://raw.example.com/"), commit, F.lit("/README.md")))
    return table(spark, d, "orders").select(k.alias("orderkey"), checks.trusted_location(kind, identity, url, commit, F.lit("v1"), shapes).alias("trusted"))


_NOTES = "n AS (SELECT p_brand AS package, p_size || '.' || p_partkey % 4 || '.0' AS version, p_partkey AS position, p_name || ' ' || p_type AS note FROM part)"


def _notes(spark, d):
    return table(spark, d, "part").select(F.col("p_brand").alias("package"), F.concat("p_size", F.lit("."), F.col("p_partkey") % 4, F.lit(".0")).alias("version"), F.col("p_partkey").alias("position"), F.concat_ws(" ", "p_name", "p_type").alias("note"))


@query(f"""WITH {_NOTES}, f AS (SELECT package, version, arg_min(note, position) AS note FROM n GROUP BY ALL), r AS (SELECT DISTINCT p_brand AS package, p_size || '.' || x || '.0' AS version FROM part, range(5) t(x))
    SELECT package, version, note AS documented_changes FROM r LEFT JOIN f USING (package, version)""")
def documented_releases(spark, d):
    """Releases with the first note of their version."""
    releases = table(spark, d, "part").select(F.col("p_brand").alias("package"), "p_size", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("x")).select("package", F.concat("p_size", F.lit("."), "x", F.lit(".0")).alias("version")).distinct()
    return reconcile.documented(releases, _notes(spark, d).withColumnRenamed("note", "changes"))


@query(f"""WITH {_NOTES}, k AS (SELECT * FROM (VALUES ('one', '[135]'), ('polished', 'POLISHED|polished'), ('a', '^[a-m]')) t(capability, pattern)),
    h AS (SELECT package, capability, version, note, [CAST(x AS INT) FOR x IN string_split(version, '.')] AS v FROM n JOIN k ON regexp_matches(note, pattern))
    SELECT package, capability, arg_min(version, (v, note)) AS version, arg_min(note, (v, note)) AS note FROM h GROUP BY ALL""")
def capabilities_introduced(spark, d):
    """The release whose note first speaks of a capability."""
    return reconcile.introduced(_notes(spark, d), [("one", "[135]"), ("polished", "POLISHED|polished"), ("a", "^[a-m]")])


@query("""SELECT o_orderkey AS orderkey, CASE WHEN o_orderkey % 3 = 0 AND o_custkey % 4 > 0 AND o_custkey % 5 > 0 THEN 'retained:s' || o_custkey || ':old' WHEN o_orderkey % 3 = 0 AND o_custkey % 4 = 0 AND o_custkey % 5 > 0 THEN 'retained:s' || o_custkey || ':old'
                 ELSE 's' || o_custkey END AS source_id, CASE WHEN o_orderkey % 3 = 0 THEN 'old' ELSE 'new' END AS sha256 FROM orders""")
def retained_citations(spark, d):
    """A citation whose source has moved on cites the state that was kept."""
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("orderkey"), F.concat(F.lit("s"), "o_custkey").alias("source_id"), F.when(F.col("o_orderkey") % 3 == 0, "old").otherwise("new").alias("sha256"))
    own = table(spark, d, "orders").select(F.concat(F.lit("s"), "o_custkey").alias("source_id"), "o_custkey").distinct()
    return reconcile.retained_citations(rows, own.where("o_custkey % 4 > 0").withColumn("sha256", F.lit("new")).drop("o_custkey"), own.where("o_custkey % 5 > 0").withColumn("sha256", F.lit("old")).drop("o_custkey"))


_HISTORY = """
    p AS (SELECT o_custkey AS id, nullif(o_orderpriority, '5-LOW') AS sha256, min(o_orderkey) AS position FROM orders WHERE o_orderstatus <> 'O' GROUP BY ALL),
    c AS (SELECT DISTINCT o_custkey AS id, nullif(o_orderpriority, '5-LOW') AS sha256 FROM orders WHERE o_orderstatus = 'O')"""


def _citations(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("sha256"), F.col("o_orderkey").alias("position"), "o_orderstatus")
    return rows.where("o_orderstatus <> 'O'").drop("o_orderstatus"), rows.where("o_orderstatus = 'O'").select("id", "sha256")


@query(f"WITH {_HISTORY} SELECT * FROM p WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.id = p.id AND c.sha256 IS NOT DISTINCT FROM p.sha256)")
def historical_sources(spark, d):
    """Earlier citations that are no longer current, the first of equals."""
    return snapshot.historical(*_citations(spark, d), ["id", "sha256"], "position")


@query(f"""WITH {_HISTORY}, w AS (SELECT id, sha256 FROM p WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.id = p.id AND c.sha256 IS NOT DISTINCT FROM p.sha256)),
               g AS (SELECT DISTINCT id, sha256 FROM p WHERE id % 3 > 0)
          SELECT 'historical-citation' AS rule, concat_ws('|', id, sha256) AS key FROM ((FROM w EXCEPT FROM g) UNION ALL (FROM g EXCEPT FROM w))""")
def historical_violations(spark, d):
    """V7: historical citations that the trusted history does not give."""
    before, now = _citations(spark, d)
    return checks.historical_violations(before.where("id % 3 > 0"), before, now, ["sha256"])


_CHANGELOG = """
    v AS (SELECT p_brand AS package, p_size AS s, p_partkey AS k, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS r FROM part)"""


def _changelogs(spark, d):
    k = F.col("p_partkey")
    bullets = F.array_join(F.transform(F.sequence(F.lit(1), (k % 15 + 1).cast("int")), lambda i: F.concat(F.when(i % 2 == 0, "- ").otherwise("* "), F.lit("change "), i)), "\n")
    head = F.when(k % 4 == 0, F.concat(F.lit("<h2>v"), "p_size", F.lit("."), k, F.lit(".0</h2>"))).when(k % 4 == 1, F.concat(F.lit("## v"), "p_size", F.lit("."), k, F.lit(".0 (2024-01-02)"))).when(k % 4 == 2, F.concat(F.lit("## "), "p_size", F.lit("."), k, F.lit(".0-rc1"))).otherwise(F.concat(F.lit("### Notes "), k))
    return _gathered(table(spark, d, "part"), [F.col("p_brand").alias("package")], "p_partkey", F.concat(head, F.lit("\n\n"), bullets, F.lit("\n")), "md")


@query(f"""WITH {_CHANGELOG},
    o AS (SELECT *, min(CASE WHEN k % 4 < 3 THEN r END) OVER (PARTITION BY package ORDER BY r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS until FROM v),
    y AS (SELECT *, ['change ' || i FOR i IN range(1, k % 15 + 2)] AS c FROM v),
    b AS (SELECT o.package, o.k, o.s, flatten(list(y.c ORDER BY y.r)) AS c FROM o JOIN y ON y.package = o.package AND y.r >= o.r AND (o.until IS NULL OR y.r < o.until) WHERE o.k % 4 < 2 GROUP BY o.package, o.k, o.s)
    SELECT package, s || '.' || k || '.0' AS version, CASE WHEN k % 4 = 1 THEN '2024-01-02' END AS date, array_to_string(c[1:12], ',') AS changes FROM b""")
def release_notes_scan(spark, d):
    """Sections of releases, each to the next heading of its level or above, with at most twelve bullets."""
    return extract.release_notes(_changelogs(spark, d), ["package"], "md").withColumn("changes", F.array_join("changes", ","))


@query("""SELECT c_nationkey AS nation, CASE WHEN c_custkey % 3 = 2 THEN 'alias' ELSE 'versioned' END AS kind, CASE WHEN c_custkey % 3 = 2 THEN 'a' ELSE 'm' END || '-' || c_custkey AS id,
                 CASE WHEN c_custkey % 3 < 2 THEN 'Fam ' || c_custkey END AS label, CASE WHEN c_custkey % 3 = 2 THEN 'm-' || c_custkey END AS target FROM customer
          UNION ALL SELECT DISTINCT c_nationkey, 'unrecognized', NULL, NULL, NULL FROM customer""")
def model_tables(spark, d):
    """Models and aliases of pipe tables in three layouts, and tables that are not understood."""
    k = F.col("c_custkey")
    row = F.when(k % 3 == 0, F.concat(F.lit("| Fam "), k, F.lit(" | `m-"), k, F.lit("` |"))).when(k % 3 == 2, F.concat(F.lit("| `a-"), k, F.lit("` | `m-"), k, F.lit("` |")))
    across = F.when(k % 3 == 1, F.concat(F.lit("\n| Model | Fam "), k, F.lit(" |\n|---|:-:|\n| Model ID | `m-"), k, F.lit("` |\n")))
    md = _gathered(table(spark, d, "customer"), [F.col("c_nationkey").alias("nation")], "c_custkey", F.coalesce(row, across), "t")
    broken = F.concat("t", F.lit("\n\n| Model | Fam A | Fam B |\n|---|---|---|\n| Model ID | `x` | y |\n"))
    return extract.model_rows(md.select("nation", broken.alias("md")), ["nation"], "md", "fam ")


@query("""SELECT p_partkey AS partkey, CASE WHEN p_partkey % 3 > 0 THEN p_name ELSE 'none' END AS title FROM part""")
def page_titles(spark, d):
    """The first heading of a page, or what stands for it."""
    k = F.col("p_partkey")
    md = F.when(k % 3 == 1, F.concat(F.lit("intro\n# *"), "p_name", F.lit("*  \n# second"))).when(k % 3 == 2, F.concat(F.lit("#   `"), "p_name", F.lit("`"))).otherwise(F.concat(F.lit("## "), "p_name"))
    return table(spark, d, "part").select(k.alias("partkey"), text.title(md, F.lit("none")).alias("title"))


@query("""SELECT n_name AS category, 'Recipe ' || c_custkey AS title, 'https://docs.example.com/r/' || c_custkey AS url, c_mktsegment AS level, c_name AS summary FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def recipe_inventory(spark, d):
    """Rows of an index under the latest heading above them."""
    rows = table(spark, d, "customer").join(table(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey")
    line = F.concat(F.lit("| [Recipe "), "c_custkey", F.lit("](/r/"), "c_custkey", F.lit(".md) | "), "c_mktsegment", F.lit(" | "), "c_name", F.lit(" |"))
    parts = _gathered(rows, [F.col("n_name").alias("name"), F.lit(1).alias("doc")], "c_custkey", line, "t").select("doc", "name", F.concat(F.lit("## "), "name", F.lit("\n\n| Recipe | Level | What |\n|---|---|---|\n"), "t", F.lit("\n")).alias("t"))
    return extract.recipe_rows(_gathered(parts, ["doc"], "name", F.col("t"), "md"), ["doc"], "md", "https://docs.example.com/").drop("doc")


@query("""WITH p AS (SELECT p_brand AS category, lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS id, p_type AS summary, CASE WHEN p_size > 25 THEN 'recommended' ELSE 'unknown' END AS status, '2024-01-' || lpad(CAST(1 + p_size % 28 AS VARCHAR), 2, '0') AS v FROM part),
               s AS (SELECT category, '## ' || category || chr(10) || chr(10) || string_agg('- `' || id || '` (' || status || '): ' || summary, chr(10) ORDER BY id) AS t FROM p GROUP BY 1)
          SELECT 'Last verified: ' || (SELECT coalesce(max(v), 'unknown') FROM p) || chr(10) || chr(10) || (SELECT coalesce(string_agg(t, chr(10) || chr(10) ORDER BY category), '') FROM s) || chr(10) AS report""")
def practices_guide(spark, d):
    """Practices under their categories, as one text."""
    return report.practices_report(_practices(spark, d))


def _practices(spark, d):
    size = F.col("p_size")
    return table(spark, d, "part").select(F.col("p_brand").alias("category"), F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("id"), F.col("p_type").alias("summary"), F.when(size > 25, "recommended").otherwise("unknown").alias("status"), F.concat(F.lit("2024-01-"), F.lpad((1 + size % 28).cast("string"), 2, "0")).alias("last_verified"))


@query("""SELECT p_brand AS model, string_agg('- ' || p_name || CASE WHEN p_size % 2 = 0 THEN ' (not found any more)' ELSE '' END || ': ' || CASE WHEN p_size % 3 = 0 THEN 'no reviewed summary' ELSE p_type END, chr(10) ORDER BY lpad(CAST(p_partkey AS VARCHAR), 9, '0')) AS report FROM part GROUP BY 1""")
def limitations_text(spark, d):
    """Limitations of each model, those that are gone marked."""
    rows = table(spark, d, "part").select(F.col("p_brand").alias("model"), F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("id"), F.col("p_name").alias("title"), F.when(F.col("p_size") % 2 == 0, "unknown").otherwise("documented").alias("status"), F.when(F.col("p_size") % 3 > 0, F.col("p_type")).alias("summary"))
    return report.limitations_report(rows)


@query("""WITH m AS (SELECT DISTINCT p_brand AS id, CAST(substr(p_brand, 7) AS INT) % 2 = 0 AS alias FROM part)
          SELECT string_agg(CASE WHEN alias THEN id || ' -> x' ELSE id END, ', ' ORDER BY alias, id) AS summary FROM m""")
def models_text(spark, d):
    """Versioned models, then aliases."""
    alias = F.substring("p_brand", 7, 9).cast("int") % 2 == 0
    return report.models_line(table(spark, d, "part").select(F.col("p_brand").alias("id"), F.when(alias, "alias").otherwise("versioned").alias("kind"), F.lit("x").alias("target")).distinct())


_TOOLS = """
    r AS (SELECT p_brand AS package, 'v' || p_size || '.' || p_partkey % 3 || '.0' AS tag, p_partkey % 7 = 0 AS draft, p_partkey % 5 = 0 AS prerelease, p_partkey AS k FROM part),
    st AS (SELECT package, tag, NOT bool_or(draft OR prerelease) AND count(DISTINCT (draft, prerelease)) = 1 AS stable FROM r GROUP BY ALL),
    nw AS (SELECT package, arg_max(tag, [CAST(x AS INT) FOR x IN string_split(substr(tag, 2), '.')]) AS tag FROM st WHERE stable GROUP BY 1),
    tg AS (SELECT package, tag, CASE WHEN min(k % 2) = max(k % 2) THEN 'c' || min(k % 2) END AS commit FROM r GROUP BY ALL)"""


@query(f"""WITH {_TOOLS}, j AS (SELECT p.package, nw.tag, tg.commit FROM (SELECT DISTINCT p_brand AS package FROM part) p LEFT JOIN nw USING (package) LEFT JOIN tg ON tg.package = p.package AND tg.tag = nw.tag)
    SELECT package, substr(tag, 2) AS version, CASE WHEN commit IS NOT NULL THEN tag END AS source_tag, commit AS source_commit, CASE WHEN commit IS NOT NULL THEN 'Useful for comparing ' || package || '.' END AS purpose,
           CASE WHEN commit = 'c1' THEN 'It is a drop-in replacement.' END AS compatibility, CASE WHEN commit IS NOT NULL THEN 'A' ELSE '' END AS providers,
           concat_ws(',', CASE WHEN tag IS NULL THEN 'release' END, CASE WHEN commit IS NULL THEN 'tag' END, CASE WHEN CASE WHEN commit IS NOT NULL THEN substr(tag, 2) END IS DISTINCT FROM substr(tag, 2) THEN 'config' END,
                     CASE WHEN commit IS NULL THEN 'purpose' END, CASE WHEN coalesce(commit, '') <> 'c1' THEN 'compatibility' END) AS missing FROM j""")
def tool_snapshots(spark, d):
    """D3 (F6, A6, J9, T7): packages by their newest stable release, with what keeps one from being published."""
    k = F.col("p_partkey")
    r = table(spark, d, "part").select(F.col("p_brand").alias("package"), F.concat(F.lit("v"), "p_size", F.lit("."), k % 3, F.lit(".0")).alias("tag"), (k % 7 == 0).alias("draft"), (k % 5 == 0).alias("prerelease"), F.lit(None).cast("string").alias("published_at"), F.concat(F.lit("c"), k % 2).alias("commit"))
    newest = reconcile.release_states(r).where("stable").withColumn("v", text.version_of(F.col("tag"))).groupBy("package").agg(F.max_by("tag", "v").alias("tag"))
    readme = F.concat(F.lit("Tool.\n\nUseful for comparing "), "package", F.lit(".\n\nInstall tool[a] now.\n"), F.when(F.col("c") == 1, "\n- It is a drop-in replacement.\n").otherwise(""))
    made = newest.select("package", F.explode(F.array(F.lit(0), F.lit(1))).alias("c"), F.substring("tag", 2, 99).alias("config_version")).select("package", F.concat(F.lit("c"), "c").alias("commit"), readme.alias("readme"), "config_version")
    out = reconcile.tool_snapshot(r, r, made, "useful for comparing", "drop-in replacement", {"tool[a]": "A", "tool[b]": "B"})
    return out.select("package", "version", "source_tag", "source_commit", "purpose", "compatibility", F.array_join("provider_families", ",").alias("providers"), F.array_join("missing", ",").alias("missing"))


@query("""SELECT p_partkey AS partkey, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'POST /v' || p_size END AS endpoint, CASE WHEN p_partkey % 3 > 0 THEN '["kind","n' || p_size || '"]' END AS properties,
                 CASE WHEN p_partkey % 3 = 1 THEN '["a","b"]' END AS kinds FROM part""")
def openapi_operations(spark, d):
    """Claims of the one operation that a page embeds; two operations, or variants that do not agree, claim nothing."""
    k = F.col("p_partkey")
    spec = F.concat(
        F.lit("# Page\n\n```yaml\npaths:\n  /v"), "p_size", F.lit(":\n    post:\n      requestBody:\n        content:\n          application/json:\n            schema:\n              $ref: '#/components/schemas/Body'\n      responses: {}\n"),
        F.lit("components:\n  schemas:\n    Body:\n      properties:\n        n"), "p_size", F.lit(": {type: string}\n        kind: {$ref: '#/components/schemas/Kind'}\n"),
        F.lit("    Kind:\n      discriminator:\n        propertyName: type\n        mapping: {a: '#/components/schemas/A', b: '#/components/schemas/B'}\n      oneOf:\n        - $ref: '#/components/schemas/A'\n        - $ref: '#/components/schemas/B'\n"),
        F.lit("    A:\n      properties:\n        type: {const: a}\n    B:\n      properties:\n        type: {const: "), F.when(F.col("v") == 1, "b").otherwise("c"), F.lit("}\n```\n"),
    )
    # pages differ by size and variant only, so each text is made and read once
    v = (k % 3).alias("v")
    pages = table(spark, d, "part").select(k.alias("partkey"), "p_size", v)
    texts = pages.select("p_size", "v").distinct()
    read = texts.select("p_size", "v", openapi.claims_of(F.when(F.col("v") == 0, F.concat(spec, F.lit("\n"), spec)).otherwise(spec)).alias("c"))
    value = lambda name: F.regexp_replace(F.try_element_at("c", F.lit(name)), '^"|"$', "")
    return pages.join(F.broadcast(read), ["p_size", "v"]).select("partkey", value("endpoint").alias("endpoint"), value("properties").alias("properties"), value("variants:kind").alias("kinds"))


_API = """
    p AS (SELECT p_partkey AS api, p_size AS n, p_partkey % 4 AS v1, (p_partkey // 4) % 4 AS v2, p_partkey % 3 = 0 AS old FROM part),
    c AS (SELECT api, claim, old AND claim = 'endpoint' AS old, v1 = 0 OR (claim = 'endpoint' AND v1 <> 1) AS ok1, v2 = 0 OR (claim = 'endpoint' AND v2 <> 1) AS ok2,
                 CASE claim WHEN 'endpoint' THEN '"POST https://api.example.com/' || s || n || '"' WHEN 'model_default' THEN '"' || s || n || '"' ELSE '["' || s || n || '"]' END AS value, s
          FROM p, (VALUES ('endpoint'), ('model_default'), ('required_fields')) x(claim), (VALUES ('a'), ('b')) y(s)),
    f AS (SELECT a.api, a.claim, a.ok2 AS ok, b.value, CASE WHEN a.ok1 THEN a.value WHEN a.old THEN '"old"' END AS known FROM c a JOIN c b ON b.api = a.api AND b.claim = a.claim AND a.s = 'a' AND b.s = 'b')"""


def _api_pages(parts, letter, variant):
    """A prose reference of each part: whole, without any claim, with a tag in single quotes, or ending within a tag."""
    size = F.concat(F.lit(letter), "p_size")
    model = F.when(variant == 2, F.concat(F.lit("default='"), size, F.lit("'"))).otherwise(F.concat(F.lit('default="'), size, F.lit('"')))
    field = F.concat(F.lit('<ParamField body="model" type="string" '), model, F.lit('>Which.</ParamField>\n<ParamField body="'), size, F.when(variant == 3, '" type="array" required').otherwise('" type="array" required>All.</ParamField>\n'))
    page = F.concat(F.lit("# API\n\n## Evaluation endpoint\n\n```http\nPOST https://api.example.com/"), size, F.lit("\n```\n\n## Request body\n\n"), field)
    text = F.when(variant == 1, F.lit("# API\n\nGone for now.\n")).otherwise(page)
    return parts.select(F.col("p_partkey").alias("api"), F.lit("prose").alias("source_id"), text.alias("text"), hashing.content_sha256(text).alias("sha256"))


def _api_states(spark, d):
    """Facts of two observations of every reference, the second on top of the first."""
    parts, k = table(spark, d, "part"), F.col("p_partkey")
    old = parts.where(k % 3 == 0).select(k.alias("api"), F.lit("endpoint").alias("claim"), F.lit("verified").alias("status"), F.lit('"old"').alias("value"))
    names = ["endpoint", "model_default", "required_fields"]
    first = openapi.api_facts(_api_pages(parts, "a", k % 4), names, old, "prose", by=["api"])
    pages = _api_pages(parts, "b", F.expr("(p_partkey div 4) % 4"))
    return pages, openapi.api_facts(pages, names, first, "prose", by=["api"])


@query(f"""WITH {_API} SELECT api, claim, CASE WHEN ok THEN 'verified' ELSE 'unknown' END AS status, CASE WHEN ok THEN value END AS value, CASE WHEN NOT ok THEN known END AS last_known FROM f""")
def api_reference_facts(spark, d):
    """Claims of prose references over two observations; what neither shows stays as last known."""
    return _api_states(spark, d)[1].select("api", "claim", "status", "value", "last_known")


@query(f"""WITH {_API} SELECT api, max(CASE WHEN claim = 'endpoint' AND ok THEN value END) AS endpoint, max(CASE WHEN claim = 'required_fields' AND ok THEN value END) AS required,
                 max(CASE WHEN claim = 'endpoint' AND NOT ok THEN known END) AS last_endpoint, CAST(count(*) FILTER (ok) AS INT) AS verified FROM f GROUP BY api""")
def api_reference_states(spark, d):
    """The facts of each reference as one state."""
    state = openapi.api_state(_api_states(spark, d)[1], ["api"])
    cited = F.size(F.filter(F.map_values("properties"), lambda x: F.size(x["evidence"]) > 0))
    return state.select("api", F.col("values")["endpoint"].alias("endpoint"), F.col("values")["required_fields"].alias("required"), F.col("properties")["endpoint"]["last_known"].alias("last_endpoint"), cited.alias("verified"))


@query(f"""WITH {_API}, e AS (SELECT *, api % 7 = 0 AS moved, api % 11 = 0 AND claim = 'endpoint' AS other FROM f)
    SELECT 'value-disagrees' AS rule, api || '|' || claim AS key FROM e WHERE other
    UNION ALL SELECT 'evidence-not-current', api || '|' || claim FROM e WHERE ok AND moved""")
def evidence_violations(spark, d):
    """V5: state values that are not their property's, and evidence whose source has other content by now."""
    pages, facts = _api_states(spark, d)
    facts = facts.withColumn("evidence", F.transform("evidence", lambda e: F.struct(F.concat_ws(":", e["source_id"], "api").alias("source_id"), e["sha256"].alias("sha256"), e["excerpt"].alias("excerpt"))))
    values = facts.select("api", "claim", F.when((F.col("api") % 11 == 0) & (F.col("claim") == "endpoint"), "other").otherwise(F.col("value")).alias("value"))
    sources = pages.select(F.concat_ws(":", "source_id", "api").alias("source_id"), F.when(F.col("api") % 7 == 0, "moved").otherwise(F.col("sha256")).alias("sha256"))
    return checks.evidence_violations(facts, values, sources, ["api"])


@query("""SELECT c_custkey AS custkey, CASE WHEN c_custkey % 4 = 3 THEN '' ELSE 'Body of ' || c_name || '.' END AS body, CASE c_custkey % 4 WHEN 2 THEN NULL ELSE 'in  out' END AS shown,
                 CASE WHEN c_custkey % 4 = 1 THEN 'x' ELSE c_mktsegment END AS kind FROM customer""")
def component_sections(spark, d):
    """The body of the one section of a title, text without nested components, attributes of a tag."""
    k = F.col("c_custkey")
    body = F.concat(F.lit("Body of "), "c_name", F.lit("."))
    page = F.concat(F.lit("# T\n\n## Other\n\nno\n\n## Wanted\n\n"), body, F.when(k % 4 == 3, "\n\n## Wanted\n\ntwice\n").otherwise("\n\n## Last\n\nend\n"))
    nested = F.concat(F.lit("in <Expandable title=\"a\">x <Expandable>y</Expandable> z"), F.when(k % 4 == 2, "").otherwise("</Expandable>"), F.lit(" out"))
    tag = F.when(k % 4 == 1, F.lit('<F type="x">')).otherwise(F.concat(F.lit('<F type="'), "c_mktsegment", F.lit('" required>')))
    rows = table(spark, d, "customer").select(k.alias("custkey"), markup.section_of(page, "Wanted").alias("body"), markup.without(nested, ["Expandable"]).alias("shown"), F.element_at(markup.attributes_of(tag), "type").alias("kind"))
    return rows.select("custkey", F.btrim(F.regexp_replace("body", r"^\s+|\s+$", "")).alias("body"), "shown", "kind")


@query(r"""SELECT c_custkey AS custkey, 'before ' || c_name || ' text `code` end - item' || CASE WHEN c_custkey % 2 = 0 THEN ' last' ELSE '' END AS prose FROM customer""")
def prose_of_markdown(spark, d):
    """Comments, code, quotes, raw containers and link targets left out of a page, lists read as such."""
    tail = F.when(F.col("c_custkey") % 2 == 0, "last").otherwise("    last\n")
    md = F.concat(F.lit("before "), "c_name", F.lit(" [text](https://x.example/a) `code`<!-- no -->`a b` <pre>raw</pre> end\n\n```py\nfenced "), "c_mktsegment", F.lit("\n```\n\n> quoted\nlazily\n\n- item\n\n      code\n\nend of list\n\n"), tail)
    c = text.fold_space(markup.unlinked(markup.prose(md)))
    return table(spark, d, "customer").select(F.col("c_custkey").alias("custkey"), F.replace(c, F.lit(" end of list"), F.lit("")).alias("prose"))
