"""Mixing sources to target weights by Pareto order sampling.

A source that must supply r times its words gives every document floor(r)
certain copies; the rest is a sample in which a document's inclusion
probability is its source's fraction of r. Documents are ranked by random odds
over inclusion odds, least first, and taken in that order until the source's
remaining words are reached.

The cut in each source's ranking is found by two rounds of bucket sums and a
window over the rows of one last bucket, so no task ever sorts a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .workspace import NULL_ID, materialise

WEIGHTS, TOTAL, MOST = (5.0, 2.0, 1.0), 1.5, 2.0
CELLS = 1024
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _draw(id_col: str, text_col: str, seed: str) -> Column:
    """A number in [0, 1) from 52 bits of a hash of seed and id, without an id of seed and text: the same on every run."""
    own = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), own)), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from rows (source, size): shares of total * all sizes by weight.

    Sources in code point order, null last, take the weights in turn. A target
    stops at most * source_size; the excess goes to the others by weight until
    none is above. The level at which sources stop is found from running sums
    over the sources (one row each).
    """
    by = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    ranked = by.withColumn("w", weight).withColumn("full", F.lit(float(most)) * F.col("source_size"))
    rising = Window.orderBy(F.col("full") / F.col("w"), F.col("source").isNull(), "source")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.lit(float(total)) * F.sum("source_size").over(every) - F.coalesce(F.sum("full").over(before), F.lit(0.0))) / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    levelled = ranked.withColumn("level", level).withColumn("level", F.max(F.when(F.col("level") <= F.col("full") / F.col("w"), F.col("level"))).over(every))
    target = F.least("full", F.coalesce(F.col("level") * F.col("w"), F.col("full")))
    return levelled.select("source", "source_size", target.alias("target"))


def _ranked(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """sizes with its source's plan and x, the Pareto ranking variable q mapped to q / (1 + q) (null: no sample in this source)."""
    q = F.col("u") / (1 - F.col("u")) / (F.col("part") / (1 - F.col("part")))
    joined = sizes.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    return joined.withColumn("x", F.when(F.col("part") > 0, q / (1 + q)))


def _place(ranked: DataFrame, cut: DataFrame, *levels: str) -> DataFrame:
    """The ranked rows that lie in their source's cut (equal in levels), with the words still wanted there."""
    same = F.col("source").eqNullSafe(F.col("s"))
    for c in levels:
        same &= F.col(c) == F.col(f"cut_{c}")
    return ranked.join(cut.select(F.col("source").alias("s"), *[F.col(c).alias(f"cut_{c}") for c in levels], "wanted"), same).drop("s", *[f"cut_{c}" for c in levels])


def source_plan(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """One row for each source of sizes (doc_id, source, size, u): source_size, target, certain copies, and where its sample ends."""
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = source_targets(sizes, weights, total, most).withColumn("certain", F.floor(ratio).cast("long")).withColumn("part", ratio - F.floor(ratio))
    plan = materialise(plan, "targets")
    ranked = _ranked(sizes, plan).where("x is not null and size > 0").withColumn("cell", F.floor(F.col("x") * CELLS)).withColumn("fine", F.floor(F.col("x") * CELLS * CELLS))
    cut, levels = plan.where("part > 0").select("source", (F.col("target") - F.col("certain") * F.col("source_size")).alias("wanted")), []
    for level in ("cell", "fine"):
        sums = _place(ranked.select("source", "size", "cell", "fine"), cut, *levels).groupBy("source", level).agg(F.sum("size").alias("words"), F.first("wanted").alias("wanted"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy(level))
        crossed = sums.withColumn("upto", upto).where("upto >= wanted").groupBy("source").agg(F.min(F.struct(level, (F.col("wanted") - F.col("upto") + F.col("words")).alias("wanted"))).alias("f"))
        cut, levels = materialise(crossed.select("source", F.col(f"f.{level}").alias(level), F.col("f.wanted").alias("wanted")), f"cut-{level}"), [level]
    key = F.struct("x", "k", "size")
    order = Window.partitionBy("source").orderBy("x", "k", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = _place(ranked, cut, "fine").withColumn("k", F.coalesce("doc_id", F.lit(NULL_ID))).withColumn("upto", F.sum("size").over(order))
    over, under = F.col("upto") - F.col("wanted"), F.col("wanted") - F.col("upto") + F.col("size")
    ends = last.where("upto >= wanted").groupBy("source").agg(F.min(F.struct(key.alias("end"), (over <= under).alias("keep_end"))).alias("c")).select(F.col("source").alias("s"), "c.end", "c.keep_end")
    return materialise(plan.join(ends, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"), "plan")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), _draw(id_col, text_col, seed).alias("u"))


def _taken(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    key = F.struct("x", F.coalesce("doc_id", F.lit(NULL_ID)).alias("k"), "size")
    chosen = F.col("x").isNotNull() & (F.col("end").isNull() | (key < F.col("end")) | ((key == F.col("end")) & F.col("keep_end")))
    copies = F.when(F.col("size") > 0, F.col("certain") + F.when(chosen, 1).otherwise(0)).otherwise(0).cast("long")
    return _ranked(sizes, plan).withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", weights: tuple[float, ...] = WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """One row for each row of docs: its id, source, size, source_size, target, copies and taken (words).

    copies is floor(target / source_size), plus one for sampled documents; taken
    is copies * size and never above `most` * size for a whole `most`. In each
    source the sample ends at the document that brings the taken words nearest
    to the target, so they differ from it by half that document at most. A null
    text has size 0, as has one without words, and is never taken; a null source
    is a source of its own. Rows with equal id, source and size share one draw
    and are alike; rows without an id draw by their text. No documents give no rows.
    """
    sizes = materialise(_sized(docs, id_col, text_col, source_col, seed), "sizes")
    out = _taken(sizes, source_plan(sizes, weights, total, most))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", weights: tuple[float, ...] = WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """docs with every row as often as the mix takes it; columns as in docs."""
    sizes = materialise(_sized(docs, id_col, text_col, source_col, seed), "sizes")
    plan = source_plan(sizes, weights, total, most)
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), _draw(id_col, text_col, seed).alias("u"))
    return _taken(whole, plan).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.greatest("copies", F.lit(1))))).where("copies > 0").select("row.*")
