"""Connected components: contraction in bounded parts, then alternating large-star and small-star steps.

Tasks of at most CHUNK edges each hang the vertices that their own edges connect
on the least of them. One such part is all there is to do; several are joined by
star steps. Every step is a grouped minimum (combined before the shuffle) joined back to
the edges. Vertices of very high degree, of which there can be few only, get
their minimum by broadcast, so no task holds the edges of one. Nothing is
gathered per vertex and nothing goes to the driver but one row per round.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import discard, materialise

#: Edges that one task contracts, held as a table of its vertices.
CHUNK = 500_000
#: A vertex with more than this part of all edges counts as hot; there are at most 2 * PART of them, of 16 bytes each.
PART = 100_000


def _hung(edges: DataFrame, m, hot: int) -> DataFrame:
    """edges (u, v) with m of u: an aggregate of the edges, broadcast for vertices with more than `hot` of them."""
    least = edges.groupBy("u").agg(m.alias("m"), F.count("*").alias("degree"))
    marked = edges.join(F.broadcast(least.where(F.col("degree") > hot).select("u", F.col("m").alias("top"))), "u", "left")
    cold = marked.where("top is null").select("u", "v").join(least.where(F.col("degree") <= hot).select("u", "m"), "u")
    return marked.where("top is not null").select("u", "v", F.col("top").alias("m")).unionByName(cold)


def _star(edges: DataFrame, large: bool, hot: int) -> DataFrame:
    """edges (u, v); large: hang every larger neighbour of u on the least one; else hang u and its smaller neighbours."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        out = _hung(both, F.least(F.min("v"), F.col("u")), hot).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        hung = _hung(down, F.min("v"), hot)
        out = hung.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
    return out.where("u <> v").distinct()


def _contracted(edges: DataFrame) -> DataFrame:
    """edges (u, v) -> of each partition (u, v): its vertices but the least of what they connect, with that one."""

    def run(batches):
        root: dict[int, int] = {}

        def find(x):
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        for batch in batches:
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
                u, v = find(u), find(v)
                root[max(u, v)] = min(u, v)
        hung = [(x, r) for x in list(root) if (r := find(x)) != x]
        yield pa.RecordBatch.from_arrays([pa.array([h[i] for h in hung], pa.int64()) for i in (0, 1)], ["u", "v"])

    return edges.mapInArrow(run, "u long, v long")


def components(edges: DataFrame, max_rounds: int = 60, chunk: int = CHUNK) -> DataFrame:
    """edges (u long, v long) -> (id, component): every vertex on an edge with the least vertex it reaches.

    Loops, repeated and reversed edges and edges with a null end are allowed
    (the latter are ignored); no edges give no rows.
    """
    given = materialise(edges.select("u", "v").where("u <> v"), "edges")
    parts = max(1, -(-given.count() // chunk))
    edges = materialise(_contracted(given.coalesce(parts)), "contracted")
    discard(given)
    size = edges.count()
    for _ in range(max_rounds if parts > 1 else 0):
        hot = size // PART + 1
        stars = materialise(_star(_star(edges, True, hot), False, hot), "stars")
        discard(edges)
        edges = stars
        # done when every edge hangs a vertex with no other on one that hangs on none
        ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("n")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("n")))
        row = ends.groupBy("x").agg(F.sum("n").alias("n"), F.min("n").alias("least")).agg(F.count_if(F.expr("n > 1 or (n = 1 and least = 0)")).alias("open"), F.sum("n").alias("size")).first()
        size = row.size or 0
        if not row.open:
            break
    else:
        if parts > 1:
            raise RuntimeError("components: no fixed point")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
