"""Snapshots: manifests, carried-forward times, differences and their classification.

A difference of two snapshots is one grouped aggregation over their tagged
union rather than a full outer join: one shuffle on the key, combined before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hashing, urls
from .streamed import ordered_hash

DOCUMENT_TYPES = ("documentation-index", "documentation-page", "documentation-sitemap")


def manifest(artifacts: DataFrame, previous: DataFrame, now: Column, title: Column | None = None, description: Column | None = None) -> DataFrame:
    """The manifest rows of artifacts: content hashed and measured once, times carried forward while the hash stays.

    upstream_last_modified is the artifact's own, else the previous row's while
    the hash is the same; observed_at is the previous row's while it is the same, else now.
    """
    before = previous.select("source_id", F.col("sha256").alias("p_sha"), F.col("observed_at").alias("p_at"), F.col("upstream_last_modified").alias("p_mod"))
    rows = artifacts.withColumn("sha256", hashing.content_sha256(F.col("content"))).join(before, "source_id", "left")
    same = F.col("sha256").eqNullSafe(F.col("p_sha"))
    return rows.select(
        "source_id",
        "source_type",
        urls.canonical(F.col("url")).alias("canonical_url"),
        F.col("url").alias("fetch_url"),
        "discovered_via",
        F.coalesce("upstream_last_modified", F.when(same, F.col("p_mod"))).alias("upstream_last_modified"),
        "upstream_commit",
        "source_tag",
        "sha256",
        F.length("content").cast("long").alias("bytes"),
        (title if title is not None else F.lit(None).cast("string")).alias("title"),
        (description if description is not None else F.lit("")).alias("description"),
        F.when(same, F.col("p_at")).otherwise(now).alias("observed_at"),
    )


def carried(current: DataFrame, previous: DataFrame, key: str, state: str, stamp: str, now: Column) -> DataFrame:
    """current with stamp: previous' stamp of the key while its state is the same, else now."""
    before = previous.select(key, F.col(state).alias("__s"), F.col(stamp).alias("__t"))
    return current.join(before, key, "left").withColumn(stamp, F.when(F.col(state).eqNullSafe(F.col("__s")), F.coalesce("__t", now)).otherwise(now)).drop("__s", "__t")


def last_items(rows: DataFrame, key: str, position: str) -> DataFrame:
    """One row for each key that is not null, the last by position."""
    own = [c for c in rows.columns if c != key]
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*own), F.col(position)).alias("r")).select(key, "r.*")


def first_items(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row for each key, the first by order (least struct of the order columns, combined before the shuffle)."""
    rest = [c for c in rows.columns if c not in keys and c not in order]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*order, *rest), F.struct(*order)).alias("r")).select(*keys, "r.*")


def changed(old: DataFrame, new: DataFrame, keys: Sequence[str], state: str, keep: Sequence[str] = ()) -> DataFrame:
    """(keys, change, before, after, kept columns of the newer side) where state differs, a missing key and a null state apart.

    change is added, removed or modified; a removed key has no after, whatever
    its state was. Keys are unique on each side.
    """
    side = lambda df, is_new: df.select(*keys, F.col(state).alias("__v"), *keep, F.lit(is_new).alias("__n"))
    pick = lambda c, is_new: F.max(F.when(F.col("__n") == is_new, F.col(c)))
    had = lambda is_new: F.coalesce(F.bool_or(F.col("__n") == is_new), F.lit(False))
    both = side(old, False).unionByName(side(new, True)).groupBy(*keys)
    merged = both.agg(pick("__v", False).alias("before"), pick("__v", True).alias("after"), had(False).alias("__old"), had(True).alias("__new"), *[F.coalesce(pick(c, True), pick(c, False)).alias(c) for c in keep])
    kind = F.when(~F.col("__old"), "added").when(~F.col("__new"), "removed").otherwise("modified")
    differs = (F.col("__old") != F.col("__new")) | ~F.col("before").eqNullSafe(F.col("after"))
    return merged.where(differs).select(*keys, kind.alias("change"), "before", "after", *keep)


def source_events(old: DataFrame, new: DataFrame, observed_at: Column, namespace: str = hashing.NAMESPACE) -> DataFrame:
    """One event for each documentation source of two manifests whose hash differs."""
    docs = F.col("source_type").isin(*DOCUMENT_TYPES)
    found = changed(old.where(docs), new.where(docs), ["source_id"], "sha256", ["canonical_url"])
    entity = F.concat(F.lit("source:"), F.col("source_id"))
    return found.select(
        hashing.event_id(entity, F.col("change"), F.col("before"), F.col("after"), namespace).alias("id"),
        F.lit("source").alias("category"),
        F.col("source_id").alias("entity"),
        "change",
        F.col("before").alias("before_sha256"),
        F.col("after").alias("after_sha256"),
        observed_at.alias("observed_at"),
        F.concat_ws(" ", F.col("source_id"), F.col("change")).alias("summary"),
        F.array(F.struct("source_id", F.col("canonical_url").alias("url"), F.coalesce("after", "before").alias("sha256"))).alias("sources"),
    )


#: Layers whose rows are defined by code (their arrival and loss are no news), and layers that begin as one baseline.
ITEMS = ('{"items":[', ",", "]}")  # the JSON around a layer's items
CODE_DEFINED, WHOLE_BASELINE = ("practices", "primitives"), ("model-limitations", "cookbooks", "evaluation-tool")


def layer_events(old: DataFrame, new: DataFrame, code_defined: Sequence[str] = CODE_DEFINED, whole: Sequence[str] = WHOLE_BASELINE, namespace: str = hashing.NAMESPACE) -> DataFrame:
    """Events of rows (layer, id, state) of two snapshots of all layers.

    state is the hash of the columns that count. A whole-baseline layer that was
    absent gives one baseline event, of the hash of its (id, state) rows; in
    code-defined layers added is a baseline and removed is untracked.
    """
    began = new.where(F.col("layer").isin(*whole)).join(old.select("layer").distinct(), "layer", "left_anti")
    once = ordered_hash(began, ["layer"], ["id", "state"], hashing.canonical_json(F.struct("id", "state")), *ITEMS).withColumnRenamed("sha256", "after")
    baseline = once.select("layer", F.lit(None).cast("string").alias("id"), F.lit("baseline").alias("change"), F.lit(None).cast("string").alias("before"), "after")
    rows = changed(old, new, ["layer", "id"], "state").join(began.select("layer").distinct(), "layer", "left_anti")
    fixed = F.col("layer").isin(*code_defined)
    kind = F.when(fixed & (F.col("change") == "added"), "baseline").when(fixed & (F.col("change") == "removed"), "untracked").otherwise(F.col("change"))
    events = rows.withColumn("change", kind).select("layer", "id", "change", "before", "after").unionByName(baseline)
    entity = F.concat_ws(":", "layer", "id")
    return events.withColumn("event_id", hashing.event_id(entity, F.col("change"), F.col("before"), F.col("after"), namespace))


def retained(new: DataFrame, old: DataFrame, key: str, status: str = "status", value: str = "unknown") -> DataFrame:
    """new, and the rows of old whose key is missing in it, their status unknown: absence removes nothing."""
    gone = old.join(new.select(key), key, "left_anti").withColumn(status, F.lit(value))
    return new.unionByName(gone, allowMissingColumns=True)


def merged_membership(index: DataFrame, found: DataFrame, key: str, attributes: Sequence[str], provenance: str = "provenance") -> DataFrame:
    """Rows of either side with indexed and discovered flags; the index's attributes win, provenance is of both."""
    i = index.select(key, *[F.col(c).alias(f"i_{c}") for c in (*attributes, provenance)], F.lit(True).alias("__i"))
    d = found.select(key, *[F.col(c).alias(f"d_{c}") for c in (*attributes, provenance)], F.lit(True).alias("__d"))
    empty = F.array().cast(index.schema[provenance].dataType)
    both = i.join(d, key, "full_outer")
    return both.select(
        key,
        *[F.coalesce(f"i_{c}", f"d_{c}").alias(c) for c in attributes],
        F.coalesce("__i", F.lit(False)).alias("indexed"),
        F.coalesce("__d", F.lit(False)).alias("discovered"),
        F.concat(F.coalesce(f"i_{provenance}", empty), F.coalesce(f"d_{provenance}", empty)).alias(provenance),
    )


def fetched_with_fallback(pages: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """pages (source_id) with content: of the first form, of the second only where the first gave 404."""
    a = first.select("source_id", F.col("status").alias("s1"), F.col("content").alias("c1"))
    b = second.select("source_id", F.col("status").alias("s2"), F.col("content").alias("c2"))
    content = F.when(F.col("s1") == 200, F.col("c1")).when((F.col("s1") == 404) & (F.col("s2") == 200), F.col("c2"))
    return pages.join(a, "source_id", "left").join(b, "source_id", "left").select("source_id", content.alias("content"), F.when(F.col("s1") == 404, F.col("s2")).otherwise(F.col("s1")).alias("status"))


def held_streams(candidate: DataFrame, previous: DataFrame, key: str, discrepancies: str) -> DataFrame:
    """candidate rows, but previous' row (held true) where the candidate has discrepancies and a previous row exists."""
    c, p = candidate.select(key, F.struct(*candidate.columns).alias("c")), previous.select(key, F.struct(*candidate.columns).alias("p"))
    held = (F.size(f"c.{discrepancies}") > 0) & F.col("p").isNotNull()
    return c.join(p, key, "left").select(F.when(held, F.col("p")).otherwise(F.col("c")).alias("r"), held.alias("held")).select("r.*", "held")


def readmitted(candidate: DataFrame, previous: DataFrame, stream: Column, held: DataFrame, key: str = "source_id") -> DataFrame:
    """Records of a snapshot in which some streams are held: candidate's rows of these as candidate:<key>, with previous' rows of them back.

    stream: the stream of a record's key (null: none); held: stream.
    """
    names = F.broadcast(held.select(F.col("stream").alias("__held")).distinct())
    mark = lambda df: df.withColumn("__stream", stream).join(names, F.col("__stream") == F.col("__held"), "left")
    rest = [c for c in candidate.columns if c != key]
    moved = mark(candidate).select(F.when(F.col("__held").isNotNull(), F.concat(F.lit("candidate:"), key)).otherwise(F.col(key)).alias(key), *rest)
    back = mark(previous).where("__held is not null").select(key, *rest)
    return moved.join(back.select(key), key, "left_anti").unionByName(back)


def provenance(items: DataFrame, sources: DataFrame, section: Column | None = None) -> DataFrame:
    """items (id, position, source_id, ...) -> (id, provenance): their sources that exist, in order, as (source_id, url, sha256); the url with a section's anchor if one is given."""
    url = F.col("url") if section is None else F.concat("url", F.coalesce(F.concat(F.lit("#"), section), F.lit("")))
    found = items.join(sources.select("source_id", "url", "sha256"), "source_id")
    rows = F.array_sort(F.collect_list(F.struct("position", F.struct("source_id", url.alias("url"), "sha256").alias("s"))))
    return found.groupBy("id").agg(F.transform(rows, lambda x: x["s"]).alias("provenance"))


def with_lastmod(pages: DataFrame, entries: DataFrame, url: str = "canonical_url") -> DataFrame:
    """pages with upstream_last_modified, the lastmod of the sitemap entry (url, lastmod) of their page; an empty one is null."""
    e = entries.select(F.col("url").alias("__url"), F.nullif(F.col("lastmod"), F.lit("")).alias("upstream_last_modified"))
    return pages.join(e, F.col(url) == F.col("__url"), "left").drop("__url")


def historical(previous: DataFrame, current: DataFrame, identity: Sequence[str], position: str) -> DataFrame:
    """Earlier citations that are no longer current: null-safe anti-join on identity, first of equals by position."""
    mark = current.select(*[F.col(c).alias(f"__{c}") for c in identity]).distinct()
    same = F.lit(True)
    for c in identity:
        same &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    first = Window.partitionBy(*identity).orderBy(position)
    return previous.join(mark, same, "left_anti").withColumn("__r", F.row_number().over(first)).where("__r = 1").drop("__r")


def observed(states: DataFrame, previous: DataFrame, now: Column, key: str = "layer") -> DataFrame:
    """states (key, state: canonical JSON) with fingerprint and observed_at, the time of the previous state while the fingerprint stays.

    previous: key, fingerprint, observed_at.
    """
    return carried(states.withColumn("fingerprint", hashing.content_sha256(F.col("state"))).withColumn("observed_at", now), previous, key, "fingerprint", "observed_at", now)


def derived(layers: dict[str, DataFrame], previous: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """The layers of one snapshot: (layer, id, state) of all their items, and one row for each layer with fingerprint and observed_at.

    layers: the items of each layer (id and what counts; a layer of one item has
    one row). A layer's fingerprint is the hash of the JSON of its items in order
    of id, taken as they pass; a layer without items is there too.
    """
    from .classify import projected

    items = None
    for name, rows in layers.items():
        own = rows.select(F.lit(name).alias("layer"), F.col("id").cast("string").alias("id"), projected(rows).alias("state"))
        items = own if items is None else items.unionByName(own)
    names = items.sparkSession.createDataFrame([(name,) for name in layers], "layer string")
    hashes = ordered_hash(items, ["layer"], ["id", "state"], F.col("state"), *ITEMS)
    empty = hashing.content_sha256(F.lit(ITEMS[0] + ITEMS[2]))
    whole = names.join(hashes, "layer", "left").select("layer", F.coalesce("sha256", empty).alias("fingerprint")).withColumn("observed_at", now)
    return items, carried(whole, previous, "layer", "fingerprint", "observed_at", now)
