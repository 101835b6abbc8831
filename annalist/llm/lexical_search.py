"""Ranked lexical search: the best documents of each item under integer BM25 weights.

Postings (term, document, occurrences) are a table bucketed by term and sorted
within a bucket, so that a few terms are read without the rest. An item's terms
are joined to them, every match is scored in integers, matches are summed by item
and document, and a window numbers the best.

Words that very many documents hold are not multiplied with the items that hold
them: as in maximum-score retrieval, the tenth best of some documents bounds from
below what the result needs, and an item's terms whose greatest scores together
stay under that bound cannot bring a document in by themselves. Their postings
are looked up for the documents that the other terms leave. The result is that of
scoring every match.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .workspace import discard, materialise, spread

#: Score bounds of the weighting: occurrences saturate, long documents count less.
LENGTH_SHARE, SATURATION, SCALE = 90, 8, 1_000_000_000
#: Documents that the rarest terms of an item are looked up in at first; no influence on results.
SEED_MATCHES = 1000
#: Layers in which the weaker terms are looked up; no influence on results.
LAYERS = 4
#: Rows of a side that may be broadcast; a larger side is joined by shuffle.
BROADCAST_ROWS = 1 << 18
#: A-Z become a-z; all other ASCII characters that are no letter or digit become a space.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Terms in their order: runs of ASCII letters and digits and of all characters beyond ASCII."""
    return text.translate(FOLD).split()


def counted_terms(rows: DataFrame, key: list[str], text: Column) -> DataFrame:
    """key columns, term, tf and n (all terms of the row with repeats); each row also has one line with an empty term and tf 0."""
    kept = rows.select(*key, text.cast("binary").alias("t"))

    def explode(batches):
        for batch in batches:
            own, term, tf, size = [], [], [], []
            for i, t in enumerate(batch.column("t")):
                found = terms_of(t.as_py() or b"")
                by = Counter(found)
                by[b""] = 0
                own += [i] * len(by)
                size += [len(found)] * len(by)
                term += by.keys()
                tf += by.values()
                if len(own) >= 1 << 17:
                    yield out(batch, own, term, tf, size)
                    own, term, tf, size = [], [], [], []
            yield out(batch, own, term, tf, size)

    def out(batch, own, term, tf, size):
        at = pa.array(own, pa.int32())
        columns = [batch.column(c).take(at) for c in key]
        return pa.RecordBatch.from_arrays([*columns, pa.array(term, pa.binary()).cast(pa.string()), pa.array(tf, pa.int64()), pa.array(size, pa.int64())], [*key, "term", "tf", "n"])

    schema = ", ".join(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in key)
    return kept.mapInArrow(explode, f"{schema}, term string, tf long, n long")


def _sent(df: DataFrame, at_most: int) -> DataFrame:
    """df, marked for a broadcast if it has few rows at most."""
    return F.broadcast(df) if at_most <= BROADCAST_ROWS else df


def postings(docs: DataFrame, terms: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Materialised postings (term, row, doc_id, tf, n) bucketed by term, of the given terms (column term) or of all.

    row numbers the documents, so rows that share an id are documents of their
    own. Every document has a line with an empty term, which carries its length.
    """
    own = spread(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))).withColumn("row", F.monotonically_increasing_id())
    found = counted_terms(own, ["row", "doc_id"], F.col("t"))
    if terms is not None:
        found = found.join(_sent(terms.select("term").distinct(), terms.count()), "term", "left_semi")
    # buckets by term; the adaptive plan splits one with a word of very many documents
    return materialise(found.hint("rebalance", "term").sortWithinPartitions("term", "row"), "postings", 3)


def _weighted(posts: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(postings (term, row, doc_id, s) with s the share of the weight that the occurrences earn; asked (item, term) with weight w, df and greatest score).

    Terms that cannot score above 0 are in neither.
    """
    sizes = posts.where("term = ''").agg(F.count_if(F.col("n") > 0).alias("n_docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_terms"))
    m = f"(100 - {LENGTH_SHARE} + (({LENGTH_SHARE} * n * n_docs) div n_terms))"
    share = F.expr(f"({SCALE} * tf) div (1000 * tf + {SATURATION} * {m})")
    scored = posts.where("term <> ''").crossJoin(F.broadcast(sizes)).select("term", "row", "doc_id", "n_docs", share.alias("s"))  # one row
    by_term = (
        scored.groupBy("term", "n_docs")
        .agg(F.count("*").alias("df"), F.max("s").alias("most"))
        .withColumn("w", F.floor(F.lit(1000) * F.log((2 * F.col("n_docs") + 2) / (2 * F.col("df") + 1))).cast("long"))
    )
    terms = asked.join(by_term, "term").where("w > 0 AND most > 0").select("item", "term", "w", "df", (F.col("w") * F.col("most")).alias("bound"))
    return scored.where("s > 0").select("term", "row", "doc_id", "s"), terms


def _matches(scored: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    return scored.join(wanted, on).withColumn("s", F.col("w") * F.col("s"))


def _added(scored: DataFrame, found: DataFrame, asked: DataFrame, at_most: int, n_terms: int) -> DataFrame:
    """found (item, row, doc_id, part) with the scores of asked's terms of the item added to part; at most so many look-ups."""
    own = scored.drop("doc_id").join(_sent(asked.select("term").distinct(), n_terms), "term", "left_semi")
    wanted = found.select("item", "row").join(_sent(asked.select("item", "term", "w"), n_terms), "item")
    more = _matches(own, _sent(wanted, at_most), ["term", "row"]).groupBy("item", "row").agg(F.sum("s").alias("more"))
    return found.join(more, ["item", "row"], "left").select("item", "row", "doc_id", (F.col("part") + F.coalesce("more", F.lit(0))).alias("part"))


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score) of the k documents of highest score above 0 for every item, fewer if there are no more.

    Weights follow the numbers of documents with terms and of all their terms. A
    document or item without a term (null or empty text) is in no result. Rows
    that share an id, null ids among them, are documents and items of their own;
    equal scores go by id, nulls last, and rank numbers them all. Other columns
    are not read. Texts are taken whole, one at a time. With no documents or no
    items the result is empty.
    """
    own_items = items.select(F.monotonically_increasing_id().alias("item"), F.col(item_col).alias("item_id"), F.col(item_text_col).alias("t"))
    asked = materialise(counted_terms(own_items, ["item", "item_id"], F.col("t")), "item-terms")
    named = asked.where("term = ''").select("item", "item_id")
    # a line with an empty term keeps the documents' lengths
    posts = postings(docs, asked.select("term"), id_col, text_col)
    scored, terms = _weighted(posts, asked.where("term <> ''").select("item", "term"))
    terms = materialise(terms, "item-weights")
    n_terms = terms.count()

    rarest = Window.partitionBy("item").orderBy("df", "term").rowsBetween(Window.unboundedPreceding, -1)
    seeds = terms.withColumn("before", F.coalesce(F.sum("df").over(rarest), F.lit(0))).where(F.col("before") < SEED_MATCHES).drop("before")
    best = Window.partitionBy("item")
    partial = _matches(scored, _sent(seeds.select("item", "term", "w"), n_terms), ["term"]).groupBy("item", "row", "doc_id").agg(F.sum("s").alias("part"))
    leading = partial.withColumn("r", F.row_number().over(best.orderBy(F.desc("part"), "row"))).where(F.col("r") <= k).drop("r")
    others = terms.join(seeds.select("item", "term"), ["item", "term"], "left_anti")
    leading = materialise(leading, "leading")
    bounds = (
        _added(scored, leading, others, k * n_terms, n_terms)
        .groupBy("item")
        .agg(F.when(F.count("*") == k, F.min("part")).otherwise(0).alias("least"))
    )
    # an item's terms from the weakest on, as far as they stay under the bound together, cannot bring a document in; they
    # are looked up in layers, each of which holds half of what the terms still to come can add
    weakest = best.orderBy("bound", "term").rowsBetween(Window.unboundedPreceding, 0)
    upto = terms.withColumn("upto", F.sum("bound").over(weakest)).join(bounds, "item", "left").withColumn("least", F.coalesce("least", F.lit(0)))
    most = F.max(F.when(F.col("upto") < F.col("least"), F.col("upto"))).over(best)
    layer = F.when(F.col("upto") >= F.col("least"), -1).otherwise(F.least(F.lit(LAYERS - 1), F.floor(F.log2(most / F.col("upto")))))
    split = materialise(upto.withColumn("layer", layer), "split-terms")
    widest = {r.layer: r.n for r in split.groupBy("layer", "item").count().groupBy("layer").agg(F.max("count").alias("n")).collect()}
    found, used = None, []
    for layer in range(-1, LAYERS):
        if layer >= 0 and layer not in widest:
            continue
        own = split.where(F.col("layer") == layer)
        if found is None:
            found = _matches(scored, _sent(own.select("item", "term", "w"), n_terms), ["term"]).groupBy("item", "row", "doc_id").agg(F.sum("s").alias("part"))
        else:
            found = _added(scored, found, own, found.count() * widest[layer], n_terms)
        found = materialise(found, "candidates")
        # the k-th best so far bounds the result from below as well
        kth = found.withColumn("r", F.row_number().over(best.orderBy(F.desc("part"), "row"))).where(F.col("r") == k).select("item", F.col("part").alias("kth"))
        slack = split.groupBy("item").agg(F.max("least").alias("least"), F.coalesce(F.max(F.when(F.col("layer") > layer, F.col("upto"))), F.lit(0)).alias("slack"))
        limit = slack.join(kth, "item", "left").select("item", (F.greatest("least", "kth") - F.col("slack")).alias("limit"))
        limit = materialise(limit, "limits")
        used += [found, limit]
        found = found.join(_sent(limit, n_terms), "item").where("part >= limit").drop("limit")
    top = best.orderBy(F.desc("part"), F.asc_nulls_last("doc_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k)
    out = materialise(ranked.join(named, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", F.col("part").alias("score")), "ranked")
    discard(asked, posts, terms, leading, split, *used)
    return out
