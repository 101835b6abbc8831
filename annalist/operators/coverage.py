"""Coverage of a discovered set of pages by what was fetched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def covered(pages: DataFrame, artifacts: DataFrame) -> DataFrame:
    """pages (source_id, canonical_url, title) with status (fetched or failed) and sha256."""
    a = artifacts.select("source_id", "sha256")
    return pages.join(a, "source_id", "left").withColumn("status", F.when(F.col("sha256").isNotNull(), "fetched").otherwise("failed"))


def counts(pages: DataFrame, retained: DataFrame | None = None) -> DataFrame:
    """One row: discovered, fetched, failed, retained, complete; all true of nothing is true."""
    row = pages.agg(
        F.count("*").alias("discovered"),
        F.count_if(F.col("status") == "fetched").alias("fetched"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.coalesce(F.bool_and(F.col("status") == "fetched"), F.lit(True)).alias("complete"),
    )
    kept = retained.agg(F.count("*").alias("retained")) if retained is not None else None
    return row.join(kept) if kept is not None else row.withColumn("retained", F.lit(0).cast("long"))


def delta(current: DataFrame, previous: DataFrame, key: str = "source_id") -> DataFrame:
    """(key, delta): newly-discovered and disappeared keys, one shuffle."""
    both = current.select(key, F.lit(1).alias("n")).unionByName(previous.select(key, F.lit(2).alias("n"))).groupBy(key).agg(F.bit_or("n").alias("n"))
    return both.where("n <> 3").select(key, F.when(F.col("n") == 1, "newly-discovered").otherwise("disappeared").alias("delta"))


def violations(pages: DataFrame, summary: DataFrame) -> DataFrame:
    """(rule, key) where a coverage table contradicts itself: repeated ids or URLs, pages not fetched, counts or flags that disagree."""
    twice = lambda c, rule: pages.groupBy(F.col(c).alias("key")).count().where("count > 1").select(F.lit(rule).alias("rule"), "key")
    failed = pages.where(F.coalesce(F.col("status") != "fetched", F.lit(True))).select(F.lit("page-not-fetched").alias("rule"), F.col("source_id").alias("key"))
    real = counts(pages).select(*[F.col(c).alias(f"r_{c}") for c in ("discovered", "fetched", "failed", "complete")])
    wrong = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"r_{c}")), F.lit(c)) for c in ("discovered", "fetched", "failed", "complete")], F.when(F.col("r_discovered") == 0, "empty"), F.when(~F.coalesce("removal_safe", F.lit(False)), "removal-unsafe")))
    totals = summary.crossJoin(real).select(F.explode(wrong).alias("key")).select(F.lit("summary-disagrees").alias("rule"), "key")  # one row on each side
    return twice("source_id", "repeated-id").unionByName(twice("canonical_url", "repeated-url")).unionByName(failed).unionByName(totals)


def diagnostics(current: DataFrame, previous: DataFrame, events: DataFrame, fetches: DataFrame, key: str = "source_id") -> DataFrame:
    """One row about an attempt: discovered pages, those new and those gone (in order), events in all and by category, and the last fetch that succeeded.

    fetches: status, fetched_at. The lists are what a site's page list is, not what its pages hold.
    """
    moved = delta(current, previous, key)
    lists = moved.agg(*[F.array_sort(F.collect_list(F.when(F.col("delta") == kind, F.col(key)))).alias(name) for kind, name in (("newly-discovered", "newly_discovered"), ("disappeared", "disappeared"))])
    pages = current.agg(F.count("*").alias("discovered_page_count"))
    by = events.groupBy("category").count().agg(F.coalesce(F.sum("count"), F.lit(0)).alias("candidate_event_count"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "count")))).alias("candidate_event_counts"))
    last = fetches.agg(F.max(F.when(F.col("status") == 200, F.col("fetched_at"))).alias("last_successful_fetch"))
    return pages.crossJoin(lists).crossJoin(by).crossJoin(last)  # one row each
