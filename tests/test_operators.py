from __future__ import annotations

import hashlib
import itertools
import json
import os
import random
import shutil
import time
from http.client import HTTPException, IncompleteRead
from urllib.request import Request

import pytest
from pyspark.sql import functions as F

from annalist.functions import hashing
from annalist.operators import checks, claims, coverage, extract, history, openapi, patterns, reconcile, report, snapshot
from annalist.sources import files, http
from annalist.sources.publish import Store
from annalist.streaming import changes


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_changed_tells_added_removed_modified_and_null_states(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", None), ("d", None), ("e", "x")], "k string, h string")
    new = spark.createDataFrame([("b", "2"), ("c", None), ("d", "1"), ("e", None), ("f", None)], "k string, h string")
    assert rows(snapshot.changed(old, new, ["k"], "h"), "k", "change", "before", "after") == [
        ("a", "removed", "1", None),
        ("b", "modified", "1", "2"),
        ("d", "modified", None, "1"),
        ("e", "modified", "x", None),
        ("f", "added", None, None),
    ]


def test_source_events_keep_documentation_only(spark):
    shape = "source_id string, source_type string, canonical_url string, sha256 string"
    page = "documentation-page"
    old = spark.createDataFrame([("p1", page, "u1", "a"), ("p2", page, "u2", "a"), ("r", "repository", "u", "a")], shape)
    new = spark.createDataFrame([("p1", page, "u1", "b"), ("p3", page, "u3", "a"), ("r", "repository", "u", "b")], shape)
    events = snapshot.source_events(old, new, F.lit("2024-01-01T00:00:00Z"))
    assert rows(events, "entity", "change") == [("p1", "modified"), ("p2", "removed"), ("p3", "added")]
    got = {r.entity: r.id for r in events.collect()}
    assert got["p1"] == hashlib.sha256(b"annalist-event-1|source:p1|modified|a|b").hexdigest()[:24]


def test_manifest_carries_times_while_the_hash_stays(spark):
    artifact = spark.createDataFrame([("a", "t", "https://x.example/a", bytearray(b"one"), None, None, None, None), ("b", "t", "https://x.example/b", bytearray(b"two"), None, None, None, None)], "source_id string, source_type string, url string, content binary, discovered_via string, upstream_last_modified string, upstream_commit string, source_tag string")
    old = spark.createDataFrame([("a", hashlib.sha256(b"one").hexdigest(), "old", "m"), ("b", "other", "old", "m")], "source_id string, sha256 string, observed_at string, upstream_last_modified string")
    assert rows(snapshot.manifest(artifact, old, F.lit("now")), "source_id", "observed_at", "upstream_last_modified", "bytes") == [("a", "old", "m", 3), ("b", "now", None, 3)]


def test_layer_events_truth_table(spark):
    shape = "layer string, id string, state string"
    old = spark.createDataFrame([("models", "m", "1"), ("practices", "p", "1"), ("practices", "q", "1"), ("models", "gone", "1")], shape)
    new = spark.createDataFrame([("models", "m", "2"), ("practices", "p", "2"), ("practices", "r", "1"), ("cookbooks", "c", "1"), ("cookbooks", "d", "1")], shape)
    assert rows(snapshot.layer_events(old, new), "layer", "id", "change") == [
        ("cookbooks", None, "baseline"),
        ("models", "gone", "removed"),
        ("models", "m", "modified"),
        ("practices", "p", "modified"),
        ("practices", "q", "untracked"),
        ("practices", "r", "baseline"),
    ]


def test_retention_membership_and_fallback(spark):
    new = spark.createDataFrame([("a", "verified")], "id string, status string")
    old = spark.createDataFrame([("a", "verified"), ("b", "verified")], "id string, status string")
    assert rows(snapshot.retained(new, old, "id"), "id", "status") == [("a", "verified"), ("b", "unknown")]
    i = spark.createDataFrame([("u1", "I", ["i"]), ("u2", "I", ["i"])], "url string, title string, provenance array<string>")
    f = spark.createDataFrame([("u2", "D", ["d"]), ("u3", "D", ["d"])], "url string, title string, provenance array<string>")
    assert rows(snapshot.merged_membership(i, f, "url", ["title"]), "url", "title", "indexed", "discovered", "provenance") == [("u1", "I", True, False, ["i"]), ("u2", "I", True, True, ["i", "d"]), ("u3", "D", False, True, ["d"])]
    pages = spark.createDataFrame([("a",), ("b",), ("c",)], "source_id string")
    md = spark.createDataFrame([("a", 200, "md"), ("b", 404, None), ("c", 500, None)], "source_id string, status int, content string")
    html = spark.createDataFrame([("b", 200, "html"), ("c", 200, "html")], "source_id string, status int, content string")
    assert rows(snapshot.fetched_with_fallback(pages, md, html), "source_id", "content", "status") == [("a", "md", 200), ("b", "html", 200), ("c", None, 500)]


def test_held_streams_and_history_of_citations(spark):
    shape = "stream string, version string, discrepancies array<string>"
    cand = spark.createDataFrame([("a", "2", ["x"]), ("b", "2", []), ("c", "2", ["x"])], shape)
    prev = spark.createDataFrame([("a", "1", []), ("b", "1", [])], shape)
    assert rows(snapshot.held_streams(cand, prev, "stream", "discrepancies"), "stream", "version", "held") == [("a", "1", True), ("b", "2", False), ("c", "2", False)]
    old = spark.createDataFrame([(1, "s", "h", None), (2, "s", "h", None), (3, "s", "g", None)], "n int, id string, h string, url string")
    now = spark.createDataFrame([("s", "g", None)], "id string, h string, url string")
    assert rows(snapshot.historical(old, now, ["id", "h", "url"], "n"), "n") == [(1,)]


def test_every_short_sequence_gives_one_event_for_each_transition(spark):
    states = [s for n in range(1, 6) for s in itertools.product(("A", "B", None), repeat=n)]
    assert len(states) == 363
    df = spark.createDataFrame([(i, j, v) for i, s in enumerate(states) for j, v in enumerate(s)], "seq int, step int, state string")
    events = history.transitions(df, ["seq"], ["step"], "state")
    got = {r.seq: r.n for r in events.groupBy("seq").agg(F.count("*").alias("n")).collect()}
    for i, s in enumerate(states):
        want = sum(a != b for a, b in zip((None, *s), s))
        assert got.get(i, 0) == want, s
    base = hashing.event_id(F.col("seq").cast("string"), F.col("change"), F.col("before"), F.col("after"))
    chain = history.replayed(events.drop("state").withColumn("base", base), ["seq"], ["step"])
    assert chain.count() == events.count() and chain.select("seq", "id").distinct().count() == events.count()
    assert chain.alias("a").join(chain.alias("b"), F.expr("a.seq = b.seq and a.previous_event_id = b.id")).count() == events.count() - len(got)


def _chain(spark, *more):
    shape = "id string, previous_event_id string, category string, entity string, observed_at string, position string, change string, before_sha256 string, after_sha256 string"
    return spark.createDataFrame([("1", None, "c", "e", "2024-01-09", "a", "added", None, "A"), ("2", "1", "c", "e", "2024-01-01", "b", "modified", "A", "B"), ("9", "lost", "c", "f", None, "c", "added", None, "A"), *more], shape)


def test_links_beat_clocks_and_replays_keep_their_id(spark):
    h = _chain(spark)
    assert rows(history.walked(h), "id", "root", "depth") == [("1", "1", 0), ("2", "1", 1), ("9", "9", 0)]
    assert rows(history.tails(h), "entity", "id") == [("e", "2"), ("f", "9")]
    shape = "id string, category string, entity string, change string, before_sha256 string, after_sha256 string"
    new = spark.createDataFrame([("x", "c", "e", "modified", "A", "B"), ("y", "c", "f", "modified", "A", "B"), ("z", "c", "g", "added", None, "A")], shape)
    got = {r.entity: (r.id, r.previous_event_id) for r in history.chained(new, h).collect()}
    assert got == {"e": ("2", "1"), "f": (hashlib.sha256(b"annalist-event-1-chain|y|9").hexdigest()[:24], "9"), "g": ("z", None)}


def test_long_chain_and_cycle(spark):
    long = spark.createDataFrame([(str(i), str(i - 1) if i else None, "c", "e", None, str(i)) for i in range(150)], "id string, previous_event_id string, category string, entity string, observed_at string, position string")
    assert history.walked(long).agg(F.max("depth")).first()[0] == 149
    loop = spark.createDataFrame([("1", "2", "c", "e"), ("2", "1", "c", "e"), ("3", None, "c", "e"), ("4", "3", "c", "e")], "id string, previous_event_id string, category string, entity string")
    assert rows(history.unrooted(loop), "id") == [("1",), ("2",)]


def test_bound_of_a_walk_follows_the_events(spark, monkeypatch):
    rounds, own = [], history.cut
    monkeypatch.setattr(history, "cut", lambda df: rounds.append(1) or own(df))
    loop = spark.createDataFrame([("1", "2"), ("2", "3"), ("3", "1"), ("4", None)], "id string, previous_event_id string")
    with pytest.raises(ValueError, match="cycle"):
        history.walked(loop).count()
    assert len(rounds) <= 5


def test_graph_violations(spark):
    e = spark.createDataFrame([("1", None, "c", "e"), ("2", "1", "c", "e"), ("3", "1", "c", "e"), ("4", "0", "c", "e"), ("5", "2", "d", "e"), ("1", None, "c", "e")], "id string, previous_event_id string, category string, entity string")
    assert rows(history.graph_violations(e, cycles=False), "rule", "id") == [("foreign-predecessor", "5"), ("missing-predecessor", "4"), ("repeated-id", "1"), ("several-successors", "1")]


def test_registered_violations_hold_the_cycles(spark, tmp_path):
    from annalist.plans import histories

    rng = random.Random(3)
    orders = [(i, rng.randrange(1, 12), "O", "1") for i in range(1, 100)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    up = {k: c * 11 for k, c, _, _ in orders if c != k}
    want = set()
    for start in up:
        at, seen = start, set()
        while at in up and at not in seen:
            seen.add(at)
            at = up[at]
        if at in seen:
            want.add(str(start))
    got = [r.id for r in histories.graph_violations(spark, str(tmp_path)).where("rule = 'cycle'").collect()]
    assert want and sorted(got) == sorted(want)


def test_dedup_rollup_and_kept_history(spark):
    c = spark.createDataFrame([("b", "2"), ("a", "1"), ("b", "1"), ("c", "1")], "id string, v string")
    known = spark.createDataFrame([("c",)], "id string")
    assert rows(history.deduplicated(c, known), "id", "v") == [("a", "1"), ("b", "1")]
    old = spark.createDataFrame([("a", "old"), ("b", "old")], "id string, v string")
    new = spark.createDataFrame([("b", "new"), ("c", "new")], "id string, v string")
    assert rows(history.rolled_up(old, new), "id", "v") == [("a", "old"), ("b", "new"), ("c", "new")]
    assert rows(history.history_kept(old, new), "rule", "id") == [("event-altered", "b"), ("event-dropped", "a")]
    assert history.history_kept(old, old.unionByName(new.where("id = 'c'"))).isEmpty()


@pytest.mark.parametrize(
    ("version", "tags", "releases", "want"),
    [
        ("1.0.0", [("v1.0.0", "c1")], [("v1.0.0", False, False)], []),
        ("1.0.0", [("v1.0.0", "c1"), ("v1.1.0", "c2")], [("v1.0.0", False, False)], ["git_source_ahead_of_registry"]),
        ("1.0.0", [("v1.0.0", "c1"), ("v1.1.0", "c2")], [("v1.0.0", False, False), ("v1.1.0", False, True)], []),
        ("1.0.0", [("v1.0.0", "c1"), ("v1.0.0", "c2")], [("v1.0.0", False, False)], ["registry_version_missing_git_tag"]),
        ("1.0.0", [], [], ["registry_ahead_of_git_source", "registry_version_missing_git_tag", "registry_version_missing_github_release"]),
        ("one", [("v1.0.0", "c1")], [], ["registry_version_unresolved"]),
        ("1.0.0", [("v1.0.0", "c1")], [("v1.0.0", False, False), ("v1.0.0", True, False)], ["malformed_release_metadata", "registry_ahead_of_git_source", "registry_version_missing_github_release"]),
    ],
)
def test_reconciliation_codes(spark, version, tags, releases, want):
    registry = spark.createDataFrame([("p", version)], "package string, version string")
    t = spark.createDataFrame([("p", *x) for x in tags], "package string, tag string, commit string")
    r = spark.createDataFrame([("p", *x, None) for x in releases], "package string, tag string, draft boolean, prerelease boolean, published_at string")
    assert reconcile.reconciled(registry, t, r).first().discrepancies == want


def test_config_codes_unset_the_source(spark):
    s = spark.createDataFrame([("p", "1.0.0", "v1.0.0", "c", [])], "package string, version string, source_tag string, source_commit string, discrepancies array<string>")
    c = spark.createDataFrame([("p", "python", "1.0.0", True, True, "other", "1.0.1")], "package string, kind string, version string, present boolean, parsed boolean, name string, found_version string")
    row = reconcile.resolved(s, c).first()
    assert (row.source_tag, row.source_commit) == (None, None)
    assert row.discrepancies == ["release_config_name_mismatch", "release_config_version_mismatch"]


def test_grace_period(spark):
    df = spark.createDataFrame([("a", "discrepancy", "2024-01-01T00:00:00Z"), ("b", "discrepancy", "2024-01-03T00:00:01Z"), ("c", "discrepancy", None), ("d", "up_to_date", "2024-01-01T00:00:00Z")], "k string, status string, discrepancy_first_observed string")
    assert rows(reconcile.actionable(df, F.lit("2024-01-04T00:00:00Z").cast("timestamp")), "k") == [("a",)]


def test_notes_capabilities_and_retained_citations(spark):
    notes = spark.createDataFrame([("p", "1.1.0", "adds batch calls"), ("p", "1.0.0", "batch preview"), ("p", "0.9.0", "nothing"), ("p", "2.0.0-rc", "batch")], "package string, version string, note string")
    assert rows(reconcile.introduced(notes, [("batch", r"\bbatch\b")]), "capability", "version") == [("batch", "1.0.0")]
    cites = spark.createDataFrame([("a", "h1"), ("b", "h1"), ("c", "h1")], "source_id string, sha256 string")
    now = spark.createDataFrame([("a", "h2"), ("b", "h1")], "source_id string, sha256 string")
    was = spark.createDataFrame([("a", "h1"), ("b", "h1")], "source_id string, sha256 string")
    assert rows(reconcile.retained_citations(cites, now, was), "source_id") == [("b",), ("c",), ("retained:a:h1",)]


def test_claims(spark):
    c = spark.createDataFrame([("r", "s1", "d1", "x"), ("r", "s1", "d2", "y"), ("r", "s2", "d1", "x"), ("r", "s2", "d2", "q")], "rule string, source string, digest string, excerpt string")
    b = spark.createDataFrame([("s1", "d1", "..x.."), ("s1", "d2", "y"), ("s2", "d1", "x"), ("s2", "d2", "y")], "source string, digest string, text string")
    assert rows(claims.supported(c, b), "source", "supported") == [("s1", True), ("s2", False)]
    items = spark.createDataFrame([(1, "Alpha  beta gamma delta"), (2, "one"), (3, None), (4, "  "), (5, "missing words here")], "item int, item_text string")
    texts = spark.createDataFrame([(10, "so ALPHA beta\ngamma delta, one"), (11, "alpha beta gamma"), (12, None), (13, "")], "source int, text string")
    assert rows(claims.contained(items, texts), "item", "source") == [(2, 10)] and rows(claims.contained(items, spark.createDataFrame([(10, "x alpha beta gamma delta y")], "source int, text string")), "item", "source") == [(1, 10)]
    v = spark.createDataFrame([("a", True, False), ("a", False, False), ("b", True, True), ("c", False, False)], "rule string, s boolean, u boolean")
    assert rows(claims.verdict(v, "rule", F.col("s"), F.col("u")), "rule", "recommended") == [("a", True), ("b", False), ("c", False)]
    f = spark.createDataFrame([("v", ["p"], "a p b", "src"), ("v", [], "a", "src"), (None, ["p"], "p", "src"), ("v", ["p"], "a", "src"), ("v", ["p" * 241], "p" * 300, "src"), ("v", ["p"], "p", None)], "value string, passages array<string>, text string, provenance string")
    assert [r.x for r in f.select(claims.verified(F.col("value"), F.col("passages"), F.col("text"), F.col("provenance")).alias("x")).collect()] == ["verified"] + ["unknown"] * 5


def test_reviews_need_context_hash_and_url(spark):
    c = spark.createDataFrame([("r", "s", "ctx", "raw", "u"), ("r", "t", "ctx", "raw2", "u")], "rule string, source string, context_sha256 string, sha256 string, url string")
    g = spark.createDataFrame([("r", "s", "ctx", "raw", "u", "supports"), ("r", "t", "ctx", "raw", "u", "supports")], "rule string, source string, context_sha256 string, sha256 string, url string, verdict string")
    assert rows(claims.reviewed(c, g), "source", "verdict") == [("s", "supports"), ("t", "unreviewed")]


def test_coverage(spark):
    pages = spark.createDataFrame([("a", "u1", "t"), ("b", "u2", "t")], "source_id string, canonical_url string, title string")
    got = coverage.covered(pages, spark.createDataFrame([("a", "h")], "source_id string, sha256 string"))
    assert coverage.counts(got).select("discovered", "fetched", "failed", "complete").first() == (2, 1, 1, False)
    assert coverage.counts(got.limit(0)).first().complete is True
    assert rows(coverage.delta(pages.where("source_id = 'a'"), pages.where("source_id = 'b'")), "source_id", "delta") == [("a", "newly-discovered"), ("b", "disappeared")]
    summary = coverage.counts(got).withColumn("removal_safe", F.lit(True)).withColumn("fetched", F.lit(2).cast("long"))
    assert rows(coverage.violations(got, summary), "rule", "key") == [("page-not-fetched", "b"), ("summary-disagrees", "fetched")]


INDEX = """# Index
- [Start](/start.md): First page
- [Again](https://docs.example.com/start): repeated
- [Index](/index.txt)
- [Plain](http://docs.example.com/plain)
- [Other](https://other.example.org/x)
- [Guide](guide/two): Second
"""


def test_index_links_and_exclusions(spark):
    df = spark.createDataFrame([(1, INDEX)], "i int, t string")
    base, index = "https://docs.example.com/index.txt", "https://docs.example.com/index.txt"
    assert rows(extract.index_links(df, ["i"], "t", base, index), "url", "title", "description") == [("https://docs.example.com/guide/two", "Guide", "Second"), ("https://docs.example.com/start", "Start", "First page")]
    assert rows(extract.excluded_links(df, ["i"], "t", base, index), "url", "reason") == [("http://docs.example.com/plain", "non-https"), ("https://docs.example.com/index.txt", "discovery-index"), ("https://other.example.org/x", "external-host")]


def exchanged(spark, df):
    """Bytes that df's plan exchanges, before compression."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df.collect()
        plans, total = [df._jdf.queryExecution().executedPlan()], 0
        while plans:
            plan = plans.pop()
            plans += [plan.children().apply(i) for i in range(plan.children().size())]
            if plan.nodeName() == "Exchange":
                total += plan.metrics().apply("dataSize").value()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return total


def test_sitemap_keeps_pairs(spark):
    xml = '<urlset xmlns:s="urn:x"><s:url><s:loc>https://docs.example.com/a</s:loc></s:url><url><loc>https://docs.example.com/b.md</loc><lastmod>2024-01-02</lastmod></url><url><loc>https://x.example/c</loc></url><url><loc>https://docs.example.com/a</loc><lastmod>2024-01-03</lastmod></url></urlset>'
    df = spark.createDataFrame([(1, xml)], "i int, t string")
    assert rows(extract.sitemap(df, ["i"], "t", "https://docs.example.com"), "url", "lastmod") == [("https://docs.example.com/a", "2024-01-03"), ("https://docs.example.com/b", "2024-01-02")]


def test_tables_models_sections_notes(spark):
    page = "| Model | Name |\n|---|:--:|\n| `m-1` | Fast one |\n| `latest` | `m-1` |\ntext\n| a | b |\n"
    df = spark.createDataFrame([(1, page)], "i int, t string")
    assert rows(extract.tables(df, ["i"], "t"), "island", "cells") == [(1, ["Model", "Name"]), (1, ["`latest`", "`m-1`"]), (1, ["`m-1`", "Fast one"]), (2, ["a", "b"])]
    page = "| M 1 | `m-1` |\n| `latest` | `m-1` |\n| Other | `o` |\n\n|  | M 2 | M 3 |\n|---|---|---|\n| Model ID | `m-2` | `m-3` |\n"
    models = lambda t: rows(extract.model_rows(spark.createDataFrame([(1, t)], "i int, t string"), ["i"], "t", "m "), "id", "kind", "label", "target")
    assert models(page) == [("latest", "alias", None, "m-1"), ("m-1", "versioned", "M 1", None), ("m-2", "versioned", "M 2", None), ("m-3", "versioned", "M 3", None)]
    assert models("| a | M 2 | M 3 |\n| Model ID | `m-2` | none |\n") == models("| a | M 2 |\n| Model ID | `m-2` | `m-3` |\n") == [(None, "unrecognized", None, None)]
    notes = "# Log\n## v1.2.0 (2024-02-03)\n- one\n### More\n- two\n## 1.3.0-rc.1\n- no\n## 1.1.0\n* three\n## Other\n- no\n"
    assert rows(extract.release_notes(spark.createDataFrame([(1, notes)], "i int, t string"), ["i"], "t"), "version", "date", "changes") == [("1.1.0", None, ["three"]), ("1.2.0", "2024-02-03", ["one", "two"])]
    levels = extract.levelled_sections(spark.createDataFrame([(1, "# a\n## b\n### c\n## d\n# e")], "i int, t string"), ["i"], "t")
    assert rows(levels, "title", "until") == [("a", 4), ("b", 3), ("c", 3), ("d", 4), ("e", None)]


def test_release_notes_of_a_long_text(spark):
    """Neither a heading takes a copy of the text nor a frame is read anew for each heading."""
    n = 30_000
    page = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("## 1.0."), i, F.lit("\n- a\n### more\n- b\n"), F.when(i % 2 == 0, F.repeat(F.lit("* c\n"), 12)).otherwise(""))), "")
    df = spark.range(1).select(F.col("id").alias("i"), page.alias("t"))
    found = extract.release_notes(df, ["i"], "t")
    begun = time.monotonic()
    assert {(r.even, r.c): r["count"] for r in found.select((F.split("version", r"\.")[2].cast("int") % 2 == 0).alias("even"), F.array_join("changes", "").alias("c")).groupBy("even", "c").count().collect()} == {(True, "ab" + "c" * 10): n // 2, (False, "ab"): n // 2}
    assert time.monotonic() - begun < 60
    empty = spark.createDataFrame([(1, "## 1.0.0\n## 1.0.1\ntext\n- x")], "i int, t string")
    assert rows(extract.release_notes(empty, ["i"], "t"), "version", "changes") == [("1.0.0", []), ("1.0.1", ["x"])]


def test_inventories(spark):
    recipes = "## Basics\n| [One](/one) | easy | first |\n## Next\n| [Two](/two.md) | hard | second |\n"
    df = spark.createDataFrame([(1, recipes)], "i int, t string")
    assert rows(extract.recipe_rows(df, ["i"], "t", "https://docs.example.com/cook"), "category", "title", "url", "level") == [("Basics", "One", "https://docs.example.com/one", "easy"), ("Next", "Two", "https://docs.example.com/two", "hard")]
    limits = "Applies to `m-1`.\nLast reviewed: 2024-01-02\n## Long Inputs\nFirst sentence. More text.\n## Other one\nBody"
    got = extract.limitation_sections(spark.createDataFrame([(1, limits)], "i int, t string"), ["i"], "t")
    assert rows(got, "id", "reviewed") == [("m-1:long-inputs", "2024-01-02"), ("m-1:other-one", "2024-01-02")]
    assert got.where("title = 'Long Inputs'").first().text_sha256 == hashlib.sha256(b"First sentence.").hexdigest()


def test_reports(spark):
    e = spark.createDataFrame([("2024-01-01", "b", "c", "e2", "added", None), ("2024-01-01", "a", "c", "e1", "removed", "gone")], "date string, id string, category string, entity string, change string, summary string")
    assert report.daily_report(e).first().report == "# Changes on 2024-01-01\n\n- **c** `e1` removed: gone\n- **c** `e2` added: \n"
    p = spark.createDataFrame([("p2", "b", "recommended", "s2", "2024-01-02"), ("p1", "a", "unknown", "s1", None)], "id string, category string, status string, summary string, last_verified string")
    assert report.practices_report(p).first().report == "Last verified: 2024-01-02\n\n## a\n\n- `p1` (unknown): s1\n\n## b\n\n- `p2` (recommended): s2\n"
    assert report.practices_report(p.limit(0)).first().report == "Last verified: unknown\n\n\n"
    m = spark.createDataFrame([("z", "versioned", None), ("a", "alias", "z")], "id string, kind string, target string")
    assert report.models_line(m).first().summary == "z, a -> z"


def test_constraints_rank_and_raise(spark):
    cites = spark.createDataFrame([("a", "1"), ("b", "2")], "source_id string, sha256 string")
    src = spark.createDataFrame([("a", "1"), ("b", "1")], "source_id string, sha256 string")
    found = checks.ranked(checks.unresolved(cites, src), checks.repeated(src.withColumn("x", F.lit(1)), ["x"], "repeated"))
    assert rows(found, "ord", "rule", "key") == [(0, "citation", "b"), (1, "repeated", "1")]
    with pytest.raises(ValueError, match="citation: b"):
        checks.require(found)
    checks.require(found.limit(0))
    state = spark.createDataFrame([("a", "x")], "id string, v string").withColumn("fingerprint", hashing.fingerprint(v=F.col("v")))
    assert checks.fingerprint_violations(state, ["v"], "id").isEmpty()
    assert rows(checks.fingerprint_violations(state.withColumn("v", F.lit("y")), ["v"], "id"), "key") == [("a",)]
    facts = spark.createDataFrame([("a", "unknown", "v", []), ("b", "verified", "v", ["e"]), ("c", "verified", None, ["e"])], "claim string, status string, value string, evidence array<string>")
    assert rows(checks.fact_violations(facts), "key") == [("a",), ("c",)]


def test_trusted_locations(spark):
    shapes = [("repository-file", "file:[a-z]+", "https://raw.example.com/{commit}/x"), ("documentation-page", "docs:.*", "https://docs.example.com/x")]
    df = spark.createDataFrame([("repository-file", "file:a", "https://raw.example.com/" + "a" * 40 + "/x", "a" * 40), ("repository-file", "file:a", "https://raw.example.com/" + "A" * 40 + "/x", "A" * 40), ("documentation-page", "docs:x", "https://evil.example/x", None), ("documentation-page", "docs:x", "https://docs.example.com/x", None)], "t string, i string, u string, c string")
    got = df.select(checks.trusted_location(F.col("t"), F.col("i"), F.col("u"), F.col("c"), F.lit(None).cast("string"), shapes).alias("x")).collect()
    assert [r.x for r in got] == [True, False, False, True]


OPENAPI = """# Reference
```yaml
paths:
  /v1/run:
    post:
      requestBody: {content: {application/json: {schema: {$ref: '#/components/schemas/Run'}}}}
      responses: {'200': {}}
servers: [{url: https://api.example.com}]
components:
  schemas:
    Run: {required: [kind], properties: {kind: {type: string}, steps: {items: {discriminator: {propertyName: k, mapping: {a: '#/components/schemas/A', b: '#/components/schemas/B'}}, oneOf: [{$ref: '#/components/schemas/A'}, {$ref: '#/components/schemas/B'}]}}}}
    A: {properties: {k: {const: a}}}
    B: {properties: {k: {const: b}}}
```
"""


def test_openapi_claims(spark):
    found = openapi.operation_claims(OPENAPI)
    assert json.loads(found["endpoint"]) == "POST /v1/run" and json.loads(found["variants:steps"]) == ["a", "b"]
    assert "variants:steps" not in openapi.operation_claims(OPENAPI.replace("const: b", "const: c"))
    assert openapi.operation_claims(OPENAPI + OPENAPI) is None
    pages = spark.createDataFrame([("s", OPENAPI, "h")], "source_id string, text string, sha256 string")
    old = spark.createDataFrame([("gone", "verified", '"x"')], "claim string, status string, value string")
    assert rows(openapi.api_facts(pages, ["endpoint", "gone"], old), "claim", "status", "value", "last_known") == [("endpoint", "verified", '"POST /v1/run"', None), ("gone", "unknown", None, '"x"')]


PROSE = """# API
## Evaluation endpoint
```http
POST https://api.example.com/v1/run
```
## Request body
<ParamField body="model" type="string" default="m-1">Which.</ParamField>
<ParamField body="steps" type="array" required>
<Expandable title="step"><ParamField body="inner" type="string" required>In it.</ParamField></Expandable>
</ParamField>
## Question types
<ParamField body="type" type='"choice"' />
## Response body
Answers by id.
"""


def test_prose_claims_come_first_and_need_their_passages(spark):
    text = PROSE.replace("type='\"choice\"'", 'type="&quot;choice&quot;"')
    digest = hashlib.sha256(b"Answers by id.").hexdigest()
    names = ["endpoint", "request_fields", "required_fields", "model_required", "model_default", "question_types", "response_shape"]
    shape = "source_id string, text string, sha256 string"
    old = spark.createDataFrame([("endpoint", "verified", '"x"')], "claim string, status string, value string")

    def facts(*pages, passages=("Answers by id.",)):
        return {r.claim: r for r in openapi.api_facts(spark.createDataFrame(list(pages), shape), names, old, "prose", (digest, "by id", list(passages))).collect()}

    got = facts(("prose", text, "h"), ("spec", OPENAPI, "g"))
    assert {k: got[k].value and json.loads(got[k].value) for k in names} == {"endpoint": "POST https://api.example.com/v1/run", "request_fields": ["model", "steps"], "required_fields": ["steps"], "model_required": False, "model_default": "m-1", "question_types": ["choice"], "response_shape": "by id"}
    assert {(r.status, r.source_id) for r in got.values()} == {("verified", "prose")}
    assert facts(("prose", text, "h"), passages=("Not there.",))["response_shape"].status == "unknown"
    assert facts(("prose", text.replace("by id.", "by name."), "h"))["response_shape"].status == "unknown"
    twice = facts(("prose", text.replace("## Request body", "## Request body\n<ParamField body=\"model\" required>"), "h"))
    assert [twice[k].status for k in ("request_fields", "required_fields", "model_required")] == ["verified", "unknown", "unknown"]
    assert facts(("prose", "", "h"), ("spec", OPENAPI, "g"))["endpoint"].source_id == "spec"
    lost = facts(("prose", "nothing", "h"), ("spec", OPENAPI, "g"))["endpoint"]
    assert (lost.status, lost.last_known) == ("unknown", '"x"')
    long = OPENAPI.replace("/v1/run", "/v1/" + "r" * 240)
    assert facts(("spec", long, "g"))["endpoint"].status == "unknown"


def test_what_a_field_declares():
    read = lambda t: [d for _, d in openapi.declarations(t)]
    assert read('<ParamField body="a" required/> <ParamField body="b &amp; c" required={false}>x</ParamField>') == [{"body": "a", "required": True}, {"body": "b & c", "required": False}]
    assert read('<ParamField body="a" required="yes">') == [{"body": "a", "required": None}]
    assert read("<ParamField body='a'>") == read("<ParamField>") == read('<ParamField body="a" body="b">') == read('<ParamField body={a}>') == read('<paramfield body="a">') == [None]
    assert read('\\<ParamField body="a"> <!-- <ParamField body="b"> --> <X title="<ParamField ">') == []
    assert read('<ParamField body="a"> then <ParamField body="b"') == [{"body": "a"}, None, None]
    assert read('<ParamField body="a"> then <!-- no end') == [{"body": "a"}, None]


def test_last_known_outlives_several_unknown_observations(spark):
    pages = lambda text: spark.createDataFrame([("prose", text, "h")], "source_id string, text string, sha256 string")
    state = spark.createDataFrame([], "claim string, status string, value string")
    seen = []
    for text in (PROSE, "gone", "gone", "", PROSE.replace("m-1", "m-2"), "gone"):
        facts = openapi.api_facts(pages(text), ["model_default"], state, "prose")
        state = spark.createDataFrame(facts.collect(), facts.schema)
        seen += [(r.status, r.value, r.last_known, r.reason is None, len(r.evidence)) for r in state.collect()]
    assert seen == [("verified", '"m-1"', None, True, 1), *[("unknown", None, '"m-1"', False, 0)] * 3, ("verified", '"m-2"', None, True, 1), ("unknown", None, '"m-2"', False, 0)]


def test_http_retries_and_guards():
    calls, waits = [], []

    def flaky(url, timeout):
        calls.append(url)
        return (429, {"Retry-After": "7"}, b"", url) if len(calls) < 3 else (200, {}, b"ok", url)

    assert http.get("https://a.example/x", flaky, waits.append)[2] == b"ok" and waits == [7.0, 7.0]
    with pytest.raises(ValueError, match="not an https URL: a.example/x"):
        http.get("http://u:secret@a.example/x?token=1", flaky)
    with pytest.raises(ValueError, match="another origin"):
        http.get("https://a.example/x", lambda u, t: (200, {}, b"", "https://b.example/x"))
    with pytest.raises(ValueError, match="too large"):
        http.get("https://a.example/x", lambda u, t: (200, {}, b"x" * (http.MOST_BYTES + 1), u))
    with pytest.raises(ValueError, match="repeat"):
        list(http.pages("https://a.example/l", "https://a.example/l", lambda u, t: (200, {"Link": '<https://a.example/l>; rel="next"'}, b"[]", u)))
    assert not http.again(403, {}) and http.again(403, {"Retry-After": "1"}) and http.again(503, {})
    assert not http.again(403, {"Retry-After": "1"}, False) and http.again(429, {}, False)


def test_bodies_cut_short_are_asked_for_again():
    tries = []

    def short(url, timeout):
        tries.append(url)
        if len(tries) < 3:
            raise HTTPException("IncompleteRead")
        return 200, {}, b"ok", url

    assert http.get("https://a.example/x", short, lambda s: None)[2] == b"ok" and len(tries) == 3
    with pytest.raises(ValueError, match="no answer: a.example/x: IncompleteRead"):
        http.get("https://a.example/x", lambda u, t: (_ for _ in ()).throw(IncompleteRead(b"")), lambda s: None)

    def foreign(url, timeout):
        raise http.ForeignRedirect

    with pytest.raises(ValueError, match="another origin: a.example/x"):
        http.get("https://a.example/x", foreign)
    handler = http._SameOrigin()
    with pytest.raises(http.ForeignRedirect):
        handler.redirect_request(Request("https://a.example/x"), None, 302, "", {}, "https://b.example/")


def test_http_source_reads_lists(spark):
    spark.dataSource.register(http.HttpSource)
    df = spark.read.format("annalist-http").option("urls", json.dumps(["https://api.example.com/r/tags"])).option("transport", "stub_transport:list_pages").option("list", "true").load()
    tags = files.listed(df, "struct<name: string>", {"name": "name is not null"})
    assert rows(files.stable_evidence(tags, ["name"]), "name") == [("v1",), ("v2",), ("v3",)]


def test_registry_shapes(spark):
    body = json.dumps({"info": {"name": "My.Pkg", "version": "1.0.0"}, "releases": {"1.0.0": [], "0.9.0": []}})
    df = spark.createDataFrame([(bytearray(body.encode()),)], "body binary")
    assert files.registry(df, "python", "my-pkg").first() == ("my-pkg", "1.0.0", ["0.9.0", "1.0.0"])
    with pytest.raises(Exception, match="unexpected shape"):
        files.registry(df, "python", "other").collect()
    npm = spark.createDataFrame([(bytearray(json.dumps({"name": "@a/b", "dist-tags": {"latest": "2.0.0"}}).encode()),)], "body binary")
    assert files.registry(npm, "npm", "@a/b").first().version == "2.0.0"


def test_history_files(spark, tmp_path):
    for day, ids in (("2024-01-02", ["c"]), ("2024-01-01", ["a", "b", None])):
        (tmp_path / f"{day}.json").write_text(json.dumps({"date": day, "events": [{"id": i, "category": "c", "entity": "e", "change": "added"} for i in ids]}))
    got = files.history(spark, str(tmp_path)).orderBy("position")
    assert [(r.date, r.id) for r in got.collect()] == [("2024-01-01", "a"), ("2024-01-01", "b"), ("2024-01-02", "c")]
    assert files.json_documents(spark, str(tmp_path / "none.json"), "a int", spark.createDataFrame([(1,)], "a int")).first().a == 1
    (tmp_path / "bad.json").write_text('{"a": "x"}')
    with pytest.raises(Exception):
        files.json_documents(spark, str(tmp_path / "bad.json"), "a int").collect()


def test_publication_is_atomic_and_recovers(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.publish("b1", {"t": spark.range(1)})
    assert store.current() == "b1" and store.read("t").count() == 1

    def refuse(*_):
        raise ValueError("checks failed")

    with pytest.raises(ValueError):
        store.publish("b2", {"t": spark.range(2)}, refuse)
    assert store.current() == "b1"
    store.recover()
    assert not (tmp_path / "s/batches/b2").exists()
    store.publish("b3", {"t": spark.range(3)})
    store.publish("b3", {"t": spark.range(9)})
    assert store.read("t").count() == 3
    store._put("CURRENT", "b1")  # as if the writer had been lost before the pointer moved
    store.recover()
    assert store.current() == "b3"
    with pytest.raises(ValueError):
        store.publish("../x", {})


def test_the_lock_of_a_killed_writer_is_taken_over(spark, tmp_path):
    root = str(tmp_path / "s")
    Store(spark, root).publish("b1", {"t": spark.range(1)})
    (tmp_path / "s/LOCK").write_text("a writer that is no more")
    shutil.copytree(tmp_path / "s/batches/b1/t", tmp_path / "s/batches/b2/t")
    with pytest.raises(RuntimeError, match="holds the lock"):
        Store(spark, root).publish("b3", {"t": spark.range(3)})
    os.utime(tmp_path / "s/LOCK", (time.time() - 500,) * 2)
    (tmp_path / "s/.LOCK.crc").unlink(missing_ok=True)
    store = Store(spark, root)
    store.publish("b3", {"t": spark.range(3)})
    assert store.read("t").count() == 3 and not (tmp_path / "s/LOCK").exists() and not (tmp_path / "s/batches/b2").exists()
    assert list(Store._in_order(dict.fromkeys(["state_x", "baseline", "events", "report_a", "other"]))) == ["other", "report_a", "events", "state_x", "baseline"]
    (tmp_path / "link").symlink_to(tmp_path / "s")
    with pytest.raises(ValueError, match="link"):
        Store(spark, str(tmp_path / "link")).publish("b4", {"t": spark.range(1)})


def test_a_writer_that_wakes_late_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "s")
    Store(spark, root).publish("b1", {"t": spark.range(1)})
    late, other = Store(spark, root, lease=500.0), Store(spark, root)

    def sleep_through(store, path):
        """The lease runs out and another writer publishes while this one checks its batch."""
        os.utime(tmp_path / "s/LOCK", (time.time() - 900,) * 2)
        (tmp_path / "s/.LOCK.crc").unlink(missing_ok=True)
        other.publish("b3", {"t": spark.range(3)})

    for batch in ("b2", "b4"):  # before and after the other's
        with pytest.raises(RuntimeError, match="lease was lost"):
            late.publish(batch, {"t": spark.range(2)}, sleep_through)
        assert late.current() == other.current() == "b3" and late.read("t").count() == 3 and not (tmp_path / "s/LOCK").exists()
        assert not (tmp_path / f"s/batches/{batch}").exists()
    # its pointer, and a whole batch that it puts in place after all, do not count
    shutil.copytree(tmp_path / "s/batches/b3", tmp_path / "s/batches/b9")
    (tmp_path / "s/batches/b9/.READY.crc").unlink(missing_ok=True)
    (tmp_path / "s/batches/b9/READY").write_text("b9@2")
    late._put("CURRENT-2", "b9")
    assert other.current() == "b3"
    other.publish("b5", {"t": spark.range(5)})
    assert other.current() == "b5" and other.read("t").count() == 5 and len(list((tmp_path / "s").glob("EPOCH-*"))) <= 2
    late.publish("b6", {"t": spark.range(6)})
    assert other.read("t").count() == 6


def test_literal_patterns_in_blocks_against_every_pair(spark):
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "B", "ab", "c\u00e9", "\U0001f600", "d"])
    texts = [None, "", " \t"] + [rng.choice([" ", "\n\t", "\u00a0 "]).join(word() for _ in range(rng.randrange(1, 30))) for _ in range(60)]
    items = [None, "", " "] + [" ".join(word() for _ in range(rng.randrange(1, 5))) for _ in range(40)] + ["a b", "A  b"]
    t = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    p = spark.createDataFrame(list(enumerate(items)), "item long, item_text string")
    fold = lambda x: " " + b" ".join((x or "").lower().encode().split()).decode() + " "
    want = sorted((k, w[1:-1]) for k, x in enumerate(texts) for w in {fold(i) for i in items} if w.strip() and w in fold(x))
    for block in (1 << 20, 25):
        got = patterns.occurring(t, ["k"], F.col("text"), p, "item_text", block)
        assert sorted(map(tuple, got.collect())) == want
    assert patterns.occurring(t, ["k"], F.col("text"), p.limit(0), "item_text").count() == 0 == patterns.occurring(t.limit(0), ["k"], F.col("text"), p, "item_text").count()
    few = claims.contained(p, t.withColumnRenamed("k", "source"))
    joined = sorted(map(tuple, few.collect()))
    claims.SCANS, kept = 0, claims.SCANS
    try:
        assert sorted(map(tuple, claims.contained(p, t.withColumnRenamed("k", "source")).collect())) == joined
    finally:
        claims.SCANS = kept


def test_slices_of_one_row_against_a_loop(spark):
    from annalist.operators.prefix_scan import Slices

    rng = random.Random(8)
    data = [(k, n, rng.choice([None, None, 1, 2, 3]), rng.choice([True, False, None])) for k in ("a", None, "b") for n in range({"a": 40, "b": 1}.get(k, 7))]
    df = spark.createDataFrame(data, "k string, n long, v long, f boolean")
    for keys in (["k"], []):
        groups: dict = {}
        for k, n, v, f in sorted(data, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
            groups.setdefault(k if keys else 0, []).append((k, n, v, f))
        want_fill, want_runs, want_ends, want_sum = [], [], [], []
        for own in groups.values():
            last, runs, before, total = None, 0, False, 0
            heads = [(k, n) for k, n, v, _ in own if v == 2]
            for k, n, v, f in own:
                last = last if v is None else v
                total += v or 0
                runs += bool(f) and not before
                before = bool(f)
                want_fill.append((k, n, last))
                want_sum.append((k, n, total))
                want_runs += [(k, n, runs)] * bool(f)
            want_ends += [(k, n, nxt and nxt[1]) for (k, n), nxt in zip(heads, [*heads[1:], None], strict=False)]
        for parts in (48, 5, 1):
            s = Slices(df, keys, ["n"] if keys else ["k", "n"], parts)
            assert rows(s.filled(F.col("v"), "x"), "k", "n", "x") == sorted(want_fill, key=repr)
            assert rows(s.summed(F.col("v"), "x"), "k", "n", "x") == sorted(want_sum, key=repr)
            assert rows(s.islands(F.col("f")), "k", "n", "island") == sorted(want_runs, key=repr)
            assert rows(s.bounded(F.expr("v <=> 2"), "n"), "k", "start", "until") == sorted(want_ends, key=repr)
    empty = Slices(df.limit(0), [], ["k", "n"])
    assert empty.islands(F.col("f")).count() == empty.filled(F.col("v"), "x").count() == 0


def test_hash_of_ordered_rows_is_that_of_their_text(spark, monkeypatch):
    from annalist.operators import streamed

    rng = random.Random(9)
    data = [(k, n, rng.choice([None, "", "x", "\u00e9" * 9])) for k in ("a", None, "b") for n in range({"a": 300}.get(k, 3))]
    df = spark.createDataFrame(data, "k string, n long, t string").repartition(6)
    for size in (1 << 18, 16):  # the workers' own module keeps its size: the chunk's end is met by long parts too
        monkeypatch.setattr(streamed, "CHUNK", size)
        for keys in (["k"], []):
            want: dict = {}
            for k, n, t in sorted(data, key=lambda r: (r[1], r[0] is not None, r[0] or "")):
                want.setdefault(k if keys else 0, []).append(t or "")
            got = streamed.ordered_hash(df, keys, ["n", "k"], F.col("t"), "[", ",", "]").collect()
            assert {(r.k if keys else 0): (r.sha256, r.n) for r in got} == {k: (hashlib.sha256(f"[{','.join(v)}]".encode()).hexdigest(), len(v)) for k, v in want.items()} and len(got) == len(want)
    assert streamed.ordered_hash(df.limit(0), ["k"], ["n"], F.col("t")).count() == 0


def test_cycles_are_told_after_the_longest_chain_that_ends(spark):
    rng = random.Random(6)
    for n in (0, 1, 40):
        links = {i: rng.choice([None, rng.randrange(n)]) for i in range(n)}
        if n:
            links |= {100 + i: 99 + i if i else None for i in range(37)} | {200 + i: 200 + (i + 1) % 7 for i in range(7)} | {300: 205}
        rooted = set()
        while more := {i for i, up in links.items() if i not in rooted and (up is None or up not in links or up in rooted)}:
            rooted |= more
        e = spark.createDataFrame([(str(i), None if up is None else str(up)) for i, up in links.items()], "id string, previous_event_id string")
        assert {int(r.id) for r in history.unrooted(e).collect()} == set(links) - rooted
        if set(links) - rooted:
            with pytest.raises(ValueError, match="cycle"):
                history.walked(e)


def test_documents_are_laid_out_and_named(spark, tmp_path):
    df = spark.createDataFrame([("state/a.json", '{"b": [1], "a": "\u00e9"}'), ("c.json", "[]")], "name string, json string")
    out = {r.name: r for r in files.write_documents(df, f"file://{tmp_path}/out").collect()}
    assert (tmp_path / "out/state/a.json").read_text() == '{\n  "a": "\u00e9",\n  "b": [\n    1\n  ]\n}\n' and out["c.json"].bytes == 3
    for name, body in (("../x.json", "{}"), ("x.json", "{"), ("x.json", None)):
        with pytest.raises(Exception, match="not a document"):
            files.write_documents(spark.createDataFrame([(name, body)], "name string, json string"), f"file://{tmp_path}/out").collect()


def test_command_line_gives_a_summary(spark, tmp_path, capsys):
    from annalist.__main__ import main

    spark.range(5).selectExpr("id as event_id", "'a' as event_type").write.parquet(str(tmp_path / "d/events.parquet"))
    assert main(["category_counts", "--data", str(tmp_path / "d"), "--out", str(tmp_path / "out"), "--diagnostics", str(tmp_path / "run.json")], spark) == 0
    assert json.loads(capsys.readouterr().out)["rows"] == 1 == json.loads((tmp_path / "run.json").read_text())["rows"]
    assert main(["category_counts", "--data", str(tmp_path / "none")], spark) == 1
    assert json.loads(capsys.readouterr().out)["phase"] == "plan"


def test_every_rule_of_the_truth_table_is_met(spark):
    from annalist.operators import classify

    shape = "layer string, id string, state string, status string, summary string, policy string, identity string, kind string, complete string, evidence string, cited array<string>, reviews string, review_urls string, observed map<string, string>, prior map<string, string>, claims map<string, struct<status: string, value: string, last: string>>, sources array<struct<source_id: string, url: string, sha256: string>>"
    names = [c.split()[0] for c in shape.split(", ") if " " in c][:15]
    src = [("a", "u", "h")]

    def rows_of(*items):
        out = []
        for item in items:
            row = dict.fromkeys(["layer", "id", "state", "status", "summary", "policy", "identity", "kind", "complete", "evidence", "cited", "reviews", "review_urls", "observed", "prior", "claims", "sources"]) | {"sources": src} | item
            out.append(tuple(row.values()))
        return spark.createDataFrame(out, shape)

    old = rows_of(
        {"layer": "practices", "id": "gone", "state": "1"}, {"layer": "models", "id": "m", "state": "1"}, {"layer": "models", "id": "r", "state": "1"}, {"layer": "models", "id": "same", "state": "1"},
        {"layer": "sdk-python", "id": "s", "state": "1", "identity": "x"}, {"layer": "model-limitations", "id": "l1", "state": "1", "evidence": "e", "cited": ["c"]}, {"layer": "model-limitations", "id": "l2", "state": "1", "evidence": "e", "cited": []},
        {"layer": "practices", "id": "p1", "state": "1", "prior": {"a": "h"}}, {"layer": "practices", "id": "p2", "state": "1", "policy": "source-reviewed-v1", "reviews": "r", "review_urls": "u", "observed": {"a": "h"}}, {"layer": "practices", "id": "p3", "state": "1", "status": "unknown", "policy": "source-reviewed-v1"},
        {"layer": "api", "id": "a1", "state": "1", "claims": {"x": ("verified", "1", None)}}, {"layer": "api", "id": "a2", "state": "1", "claims": {"x": ("unknown", None, "1")}}, {"layer": "api", "id": "a3", "state": "1"}, {"layer": "api", "id": "a4", "state": "1"},
    )
    new = rows_of(
        {"layer": "primitives", "id": "came", "state": "1"}, {"layer": "models", "id": "m", "state": "2", "summary": "own"}, {"layer": "models", "id": "n", "state": "1"}, {"layer": "models", "id": "same", "state": "1"}, {"layer": "cookbooks", "id": "c1", "state": "1"}, {"layer": "cookbooks", "id": "c2", "state": "2"},
        {"layer": "sdk-python", "id": "s", "state": "1", "identity": "x", "policy": "tag-verified-v1"}, {"layer": "model-limitations", "id": "l1", "state": "2", "evidence": "e", "cited": ["c"], "kind": "k", "complete": "h"}, {"layer": "model-limitations", "id": "l2", "state": "2", "evidence": "e", "cited": [], "complete": "h"},
        {"layer": "practices", "id": "p1", "state": "2", "policy": "source-reviewed-v1", "observed": {"a": "h"}}, {"layer": "practices", "id": "p2", "state": "1", "policy": "source-reviewed-v1", "reviews": "s", "review_urls": "u", "observed": {"a": "h"}}, {"layer": "practices", "id": "p3", "state": "2", "status": "recommended", "policy": "source-reviewed-v1"},
        {"layer": "api", "id": "a1", "state": "2", "claims": {"x": ("unknown", None, "1")}}, {"layer": "api", "id": "a2", "state": "2", "claims": {"x": ("verified", "2", None)}}, {"layer": "api", "id": "a3", "state": "2", "claims": {"x": ("verified", "1", None)}}, {"layer": "api", "id": "a4", "state": "2", "claims": {"x": ("unknown", None, None)}},
    )
    assert len(names) == 15
    rules = spark.createDataFrame([("p1", ["a"]), ("p2", ["a"]), ("p3", ["a"])], "id string, sources array<string>")
    got = {(r.layer, r.id): (r.change, r.note) for r in classify.change_events(old, new, rules).collect()}
    assert got == {
        ("cookbooks", None): ("baseline", "layer_began"), ("models", "m"): ("modified", None), ("models", "r"): ("removed", None), ("models", "n"): ("added", None), ("sdk-python", "s"): ("baseline", "release_policy_adopted"),
        ("practices", "gone"): ("untracked", "rule_removed"), ("primitives", "came"): ("baseline", "rule_added"), ("model-limitations", "l1"): ("baseline", "limitation_reread"), ("model-limitations", "l2"): ("modified", "limitation_reread_and_changed"),
        ("practices", "p1"): ("baseline", "practice_policy_adopted"), ("practices", "p2"): ("verification_changed", "context_reviewed"), ("practices", "p3"): ("modified", None), ("api", "a1"): ("verification_changed", "claims_reverified"),
        ("api", "a2"): ("modified", "claims_differ"), ("api", "a3"): ("baseline", "claims_began"), ("api", "a4"): ("verification_changed", "claims_unverified"),
    }


def test_streams_agree_with_batch_and_ignore_replays(spark, tmp_path):
    shape = "entity string, ts timestamp, state string"
    base = str(tmp_path / "in")
    first = spark.sql("select * from values ('a', timestamp'2024-01-01 00:00:00', 'A'), ('a', timestamp'2024-01-02 00:00:00', 'B'), ('b', timestamp'2024-01-01 00:00:00', 'A') as t(entity, ts, state)")
    first.write.parquet(base)
    stream = lambda: changes.transitions(spark.readStream.schema(shape).parquet(base))
    check = str(tmp_path / "cp")
    one = changes.drained(stream(), check)
    assert rows(one, "entity", "change") == [("a", "added"), ("a", "modified"), ("b", "added")]
    spark.sql("select 'a' as entity, timestamp'2024-01-03 00:00:00' as ts, 'B' as state").write.mode("append").parquet(base)
    spark.sql("select 'b' as entity, timestamp'2024-01-03 00:00:00' as ts, cast(null as string) as state").write.mode("append").parquet(base)
    two = changes.drained(stream(), check)
    assert rows(two, "entity", "change", "before") == [("a", "added", None), ("a", "modified", "A"), ("b", "added", None), ("b", "removed", "A")]
    assert two.where("previous_event_id is not null").join(two.select(F.col("id").alias("previous_event_id")), "previous_event_id").count() == 2


def test_ordered_hash_moves_compressed_chunks(spark):
    from annalist.operators import streamed

    df = spark.range(4000).select("id", F.repeat(F.concat(F.lit("the same words again "), F.col("id") % 3), 50).alias("t"))
    found = streamed.ordered_hash(df, [], ["id"], F.col("t"))
    # all parts are ranged once, 4 MB of text; the one task that hashes gets them compressed
    assert exchanged(spark, found) < 1.5 * df.agg(F.sum(F.length("t"))).first()[0]
    assert found.first().sha256 == hashlib.sha256("".join(r.t for r in df.orderBy("id").collect()).encode()).hexdigest()


def test_operation_texts_are_made_once(spark, tmp_path):
    from annalist import plans

    spark.range(300).selectExpr("id AS p_partkey", "cast(id % 50 as int) AS p_size").write.parquet(f"{tmp_path}/part.parquet")
    found = plans.QUERIES["openapi_operations"](spark, str(tmp_path))
    assert exchanged(spark, found) < 100_000
    assert rows(found.where("partkey in (3, 4, 5)"), "partkey", "endpoint", "kinds") == [(3, None, None), (4, "POST /v4", '["a","b"]'), (5, "POST /v5", None)]


def test_excerpts_of_one_digest(spark, monkeypatch):
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("ab\u00e9\U0001f600? ") for _ in range(n))
    texts = [("s", rng.choice("de"), word(rng.randrange(40))) for _ in range(60)] + [("s", "d", None)]
    cuts = [(s, d, t[i : i + rng.randrange(25)]) for s, d, t in texts if t for i in [rng.randrange(len(t))]]
    excerpts = [*cuts, *[(s, d, word(rng.randrange(14))) for s, d, _ in texts], ("s", "d", ""), ("s", "none", "a"), ("s", "d", None), ("s", "d", "?"), ("s", "d", "\U0001f600" * 9)]
    own = spark.createDataFrame(excerpts, "source string, digest string, excerpt string")
    blocks = spark.createDataFrame(texts, "source string, digest string, text string")
    want = {e for e in excerpts if e[2] is not None and any(t is not None and (s, d) == e[:2] and e[2] in t for s, d, t in texts)}
    for pairs in (0, 64):
        monkeypatch.setattr(claims, "PAIRS", pairs)
        assert sorted(map(tuple, claims.occurring_excerpts(own, blocks).collect())) == sorted(want)


def test_claims_of_one_digest_are_not_compared_pair_by_pair(spark):
    n = 40_000
    rules = spark.range(n).select(F.col("id").cast("string").alias("rule"), F.lit("s").alias("source"), F.lit("d").alias("digest"), F.concat(F.lit("claim "), "id").alias("excerpt"))
    blocks = rules.where("rule % 2 = 0").select("source", "digest", F.concat(F.lit("so: "), "excerpt", F.lit(".")).alias("text"))
    begun = time.monotonic()
    found = claims.supported(rules, blocks).groupBy("supported").count().collect()
    # a claim is in the block of its own number, or of a longer one that begins with it
    want = sum(k % 2 == 0 or k * 10 < n for k in range(n))
    assert {r.supported: r["count"] for r in found} == {True: want, False: n - want}
    assert time.monotonic() - begun < 40


def test_reviews_are_met_without_their_own_address(spark):
    url = "https://x/" + "u" * 2000
    rules = spark.range(200).select(F.col("id").cast("string").alias("id"), F.lit("c").alias("category"), F.lit("s").alias("summary"), F.concat(F.lit("s"), "id").alias("source"))
    digest = F.sha2(F.col("source"), 256)
    sources = rules.select("source", F.when(F.length("source") > 0, url).alias("url"), digest.alias("sha256"))
    reviews = rules.select("id", "source", F.lit("supported").alias("verdict"), digest.alias("context_sha256"), digest.alias("sha256"), F.when(F.col("id") == "7", "https://x/other").otherwise(url).alias("url"))
    registry = rules.select(F.col("id").alias("rule"), "source", digest.alias("context_sha256"), digest.alias("sha256"), F.when(F.length("source") > 0, url).alias("url"), F.lit("supported").alias("verdict"))
    found = checks.review_violations(rules.drop("source").withColumn("status", F.lit("recommended")), rules, reviews, registry, sources)
    moved = exchanged(spark, found)
    assert rows(found, "rule", "key") == [("review-verdict", "7")]
    assert moved < 5.5 * 200 * len(url), moved / (200 * len(url))


def test_pages_with_one_text_do_not_carry_it(spark):
    text = "# API\n\n## Evaluation endpoint\n\n```http\nPOST https://api.example.com/a\n```\n\n" + "word " * 4000
    pages = spark.range(300).select(F.col("id").alias("api"), F.lit("prose").alias("source_id"), F.when(F.col("id") >= 0, text).alias("text"), F.sha2(F.lit(text), 256).alias("sha256"))
    old = spark.createDataFrame([], "api long, claim string, status string, value string")
    found = openapi.api_facts(pages, ["endpoint"], old, "prose", by=["api"])
    assert exchanged(spark, found) < 2_000_000
    assert rows(found.where("api = 5"), "status", "value") == [("verified", '"POST https://api.example.com/a"')] and found.count() == 300


def test_ended_chains_are_walked_no_further(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(history, "cut", lambda df, real=history.cut: (out := real(df), seen.append(out.count()))[0])
    links = [(str(i), str(i - 1) if 0 < i < 40 else None) for i in range(500)]
    found = history.walked(spark.createDataFrame(links, "id string, previous_event_id string"))
    assert rows(found.where("depth > 0"), "id", "root", "depth") == sorted([(str(i), "0", i) for i in range(1, 40)], key=repr) and found.count() == 500
    assert seen == [500, 39, 38, 36, 32, 24, 8], seen


def test_results_are_put_away_slice_by_slice():
    import tracemalloc

    import pyarrow as pa

    from annalist.functions import markup

    values = pa.array(["x" * 1000] * 3000)
    tracemalloc.start()
    out = markup.by_slices(lambda v: [{"kind": v[i]} for i in range(200)], pa.list_(pa.struct([("kind", pa.string())])), values)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out) == 3000 and peak < 20_000_000
    assert markup.by_slices(lambda a, b: a + b, pa.int64(), pa.array([1, 2]), pa.array([3, 4])).to_pylist() == [4, 6] and len(markup.by_slices(str, pa.string(), pa.array([], pa.string()))) == 0
