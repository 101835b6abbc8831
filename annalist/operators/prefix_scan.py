"""Ordered state over keys of any size: slices by range, a partial state of each, and what is carried from one to the next.

A window over a key's rows runs in one task, however many they are. Here the rows
are dealt by range of key and order, so a key with all rows is many slices; each
slice is summed up in one row, a window over these few rows (as many as there are
partitions) gives what a slice begins or ends with, and a window within the slice
does the rest. Slices are a table, so their bounds stay the same for all steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import cut


class Slices:
    """rows in slices of keys (may be none) and order (columns that tell all rows of a key apart)."""

    def __init__(self, rows: DataFrame, keys: list[str], order: list[str], parts: int | None = None):
        by = [*keys, *order]
        dealt = rows.repartitionByRange(parts, *by) if parts else rows.repartitionByRange(*by)
        self.keys, self.order = keys, order
        self.rows = cut(dealt.withColumn("__part", F.spark_partition_id()))
        self._in = Window.partitionBy(*keys, "__part").orderBy(*order)
        self._of = Window.partitionBy(*keys).orderBy("__part")
        self._before = self._of.rowsBetween(Window.unboundedPreceding, -1)
        self._after = self._of.rowsBetween(1, Window.unboundedFollowing)

    def _joined(self, partial: DataFrame, carried: dict[str, Column]) -> DataFrame:
        """The rows with what the windows over the partial states give for their slice."""
        own = partial.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(self.keys)], F.col("__part").alias("__p"), *[c.alias(n) for n, c in carried.items()])
        on = F.col("__part") == F.col("__p")
        for i, k in enumerate(self.keys):
            on &= F.col(k).eqNullSafe(F.col(f"__k{i}"))
        return self.rows.join(own, on).drop("__p", *[f"__k{i}" for i in range(len(self.keys))])

    def _first(self, value: Column) -> Column:
        return F.min_by(value, F.when(value.isNotNull(), F.struct(*self.order)))

    def _last(self, value: Column) -> Column:
        return F.max_by(value, F.when(value.isNotNull(), F.struct(*self.order)))

    def filled(self, value: Column, name: str) -> DataFrame:
        """rows with name: the latest value that is not null, up to and with each row."""
        partial = self.rows.groupBy(*self.keys, "__part").agg(self._last(value).alias("last"))
        out = self._joined(partial, {"__carry": F.last("last", ignorenulls=True).over(self._before)})
        own = F.last(value, ignorenulls=True).over(self._in.rowsBetween(Window.unboundedPreceding, 0))
        return out.withColumn(name, F.coalesce(own, F.col("__carry"))).drop("__carry", "__part")

    def islands(self, inside: Column) -> DataFrame:
        """Rows where inside holds, with island: the number (from 1) of their unbroken run under its keys."""
        flag = F.coalesce(inside, F.lit(False))
        starts = (flag & ~F.coalesce(F.lag(flag).over(self._in), F.lit(False))).cast("long")
        marked = self.rows.select(*self.keys, *self.order, "__part", flag.alias("flag"), starts.alias("starts"))
        partial = marked.groupBy(*self.keys, "__part").agg(self._first(F.col("flag")).alias("first"), self._last(F.col("flag")).alias("last"), F.sum("starts").alias("starts"))
        # a run that goes on from the slice before does not start here
        partial = partial.withColumn("joins", (F.col("first") & F.coalesce(F.lag("last").over(self._of), F.lit(False))).cast("long"))
        out = self._joined(partial, {"__carry": F.coalesce(F.sum(F.col("starts") - F.col("joins")).over(self._before), F.lit(0)) - F.col("joins")})
        numbered = out.withColumn("__starts", starts).withColumn("__flag", flag)
        return numbered.withColumn("island", F.sum("__starts").over(self._in.rowsBetween(Window.unboundedPreceding, 0)) + F.col("__carry")).where("__flag").drop("__carry", "__starts", "__flag", "__part")

    def bounded(self, heading: Column, order: str) -> DataFrame:
        """Headings with start and until: where the next heading under the keys begins (null for the last)."""
        partial = self.rows.groupBy(*self.keys, "__part").agg(self._first(F.when(heading, F.col(order))).alias("first"))
        out = self._joined(partial, {"__carry": F.first("first", ignorenulls=True).over(self._after)}).where(heading)
        return out.withColumn("start", F.col(order)).withColumn("until", F.coalesce(F.lead(order).over(self._in), F.col("__carry"))).drop("__carry", "__part")

    def summed(self, value: Column, name: str) -> DataFrame:
        """rows with name: the sum of value up to and with each row (nulls add nothing)."""
        own = F.coalesce(value, F.lit(0))
        partial = self.rows.groupBy(*self.keys, "__part").agg(F.sum(own).alias("sum"))
        out = self._joined(partial, {"__carry": F.coalesce(F.sum("sum").over(self._before), F.lit(0))})
        return out.withColumn(name, F.sum(own).over(self._in.rowsBetween(Window.unboundedPreceding, 0)) + F.col("__carry")).drop("__carry", "__part")
