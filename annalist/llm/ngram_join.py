"""Exact n-gram Jaccard self-join by a grouped prefix join.

1. Every text becomes its set of distinct word shingles; rows with equal sets
   are one class.
2. Shingles are put in one global order, the common ones last, and a class is
   indexed by the prefix of its set that any partner must share.
3. Classes with identical prefix and size form one group (in parts of bounded
   size). Groups that meet under a prefix shingle are compared by size and
   position and, expanded to their members, by a parity signature of fixed
   width that bounds the overlap from above.
4. Surviving pairs are compared by bitmaps as wide as their sets, and those that
   are left verified on the words of their whole texts.

Classes that are already connected need no further pair between them. First
the groups of each shingle meet within blocks of bounded size, and each block
emits a spanning forest, closest pairs first. What may still be missing - where
a pair of a forest did not link, or a shingle has several blocks - is gone
through again in rounds: only classes of clusters that are not settled, only
pairs across components, first a forest of them, then for each class its closest
candidates and then more, until no candidate is left out. Rounds compare blocks
cell by cell, leaving out cells within one component or with sizes too far apart.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .kernels import LOWER_BYTES, distinct, mix, shingle_sets, word_numbers, words
from .workspace import discard, materialise

#: Shingles that are put last in the global order: at most so many, each seen so often.
COMMON_SHINGLES, COMMON_COUNT = 1 << 17, 8
#: Shingle hashes held at once while a task looks for common ones.
HELD = 2_000_000
#: Bits of the signatures that groups meet with; pairs are compared by bitmaps as wide as their sets too.
BITS = 512
#: Most groups in one block of a shingle's list, and members in one part of a group.
BLOCK, GROUP = 512, 16
#: Prefixes that one task sees of a common shingle, about; more are dealt to several.
DEAL = 1 << 13
#: Shingles of a set for each task more that its cells are dealt to.
SPREAD = 4096
#: What rows meet under: cells of one deal are compared one after another.
KEY = ["deal", "token", "cell"]
#: Candidates of each class that the rounds take: first a forest, last all.
CLOSEST = (0, 64, None)
#: Most ids that are broadcast to pick texts (8 bytes each); more are joined by shuffle.
SENT = 1_000_000
#: Members whose signatures a task compares at once.
ROWS = 1 << 13


def bitmap(own: np.ndarray) -> bytes:
    """Parity of the number of shingles that fall on each bit: BITS, or the least power of two that is not below the set's size.

    Halves of a bitmap XORed are the bitmap of half the width.
    """
    bits = max(BITS, 1 << max(0, len(own) - 1).bit_length())
    parity = np.bincount((mix(own) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: bytes, width: int = BITS) -> np.ndarray:
    """A bitmap brought down to width bits."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, "<u8").reshape(-1, width // 64), axis=0)


def _text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("t"))


def common_shingles(docs: DataFrame, n: int, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Hashes (ascending) and counts of the most common shingles, COMMON_SHINGLES at most.

    A task counts the documents of each shingle it sees and passes on those with
    two or more; sums over tasks are what orders shingles. The order only decides
    how selective prefixes are, never which pairs are found.
    """

    def count(batches):
        held, size = [], 0

        def flush():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            keep = counts > 1
            return pa.RecordBatch.from_arrays([pa.array(values[keep].view(np.int64)), pa.array(counts[keep])], ["h", "c"])

        for batch in batches:
            for own in shingle_sets(batch.column(0), n):
                held.append(own)
                size += len(own)
                if size >= HELD:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    counted = docs.select(F.col(text_col).cast("binary")).mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    top = counted.where(F.col("c") >= COMMON_COUNT).orderBy(F.desc("c"), "h").limit(COMMON_SHINGLES).toArrow()
    h, c = top.column("h").to_numpy().view(np.uint64), top.column("c").to_numpy()
    order = np.argsort(h)
    return h[order], c[order]


def _records(docs: DataFrame, n: int, percent: int, common: tuple[np.ndarray, np.ndarray], id_col: str, text_col: str) -> DataFrame:
    """row (a number of its own), doc_id, n (set size), set_key, prefix_key, prefix (hashes in order), sig, wide (null: as sig)."""
    shared = docs.sparkSession.sparkContext.broadcast(common)
    names = ["row", "doc_id", "n", "set_key", "prefix_key", "prefix", "sig", "wide"]

    def read(batches):
        values, counts = shared.value
        task = TaskContext.get()
        row = (task.partitionId() if task else 0) << 36
        for batch in batches:
            at = 0
            out: list[list] = [[] for _ in names[2:]]
            held = 0
            for k, own in enumerate(shingle_sets(batch.column(1), n)):
                bits = bitmap(own)
                weight = np.zeros(len(own), np.int64)
                if len(values) and len(own):
                    near = np.minimum(np.searchsorted(values, own), len(values) - 1)
                    weight = np.where(values[near] == own, counts[near], 0)
                first = own[np.argsort(weight, kind="stable")[: len(own) + (-percent * len(own) // 100) + 1]]
                record = (len(own), xxhash.xxh3_128_digest(own.tobytes()), xxhash.xxh3_128_digest(first.tobytes()), first.view(np.int64), folded(bits).tobytes(), bits if 8 * len(bits) > BITS else None)
                for column, value in zip(out, record, strict=True):
                    column.append(value)
                held += 8 * len(first) + len(bits)
                if held > ROWS << 8 or k + 1 == batch.num_rows:
                    ends = np.cumsum([0, *map(len, out[3])]).astype(np.int32)
                    prefix = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(out[3])))
                    rows = pa.array(np.arange(row + at, row + k + 1))
                    cols = [rows, batch.column(0).slice(at, k + 1 - at), pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary()), prefix, pa.array(out[4], pa.binary()), pa.array(out[5], pa.binary())]
                    yield pa.RecordBatch.from_arrays(cols, names)
                    at, held, out = k + 1, 0, [[] for _ in names[2:]]
            row += batch.num_rows

    return _text(docs, id_col, text_col).mapInArrow(read, "row long, doc_id long, n long, set_key binary, prefix_key binary, prefix array<long>, sig binary, wide binary")


def _groups(classes: DataFrame) -> DataFrame:
    """classes (class_id, comp, n, prefix_key, sig, row) -> parts of groups of equal size and prefix.

    (gid, n, group, parts, size, members): gid is the row of a record that has
    the prefix, members (id, comp, sig) are at most about GROUP.
    """
    large = classes.groupBy("n", "prefix_key").count().where(F.col("count") > GROUP)
    parts = F.coalesce(F.ceil(F.col("count") / GROUP), F.lit(1)).cast("int")
    dealt = classes.join(large, ["n", "prefix_key"], "left").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("class_id"), F.col("parts")))
    own = F.struct(F.col("class_id").alias("id"), "comp", "sig")
    found = dealt.groupBy("n", "prefix_key", "part").agg(F.min("row").alias("gid"), F.first("parts").alias("parts"), F.count("*").alias("size"), F.collect_list(own).alias("members"))
    return found.select("gid", "n", F.xxhash64("n", "prefix_key").alias("group"), "parts", "size", "members")


def _spread(groups: DataFrame, records: DataFrame) -> DataFrame:
    """(token, gid, n, pos, inner): every prefix shingle of every group; the members of a group of several meet under one token more (inner)."""
    shingles = records.select(F.col("row").alias("gid"), "prefix").join(groups.select("gid", "n"), "gid").select(F.posexplode("prefix").alias("pos", "token"), "gid", "n")
    own = groups.where("size > 1 or parts > 1").select(F.col("group").alias("token"), "gid", "n", F.lit(0).alias("pos"), F.lit(True).alias("inner"))
    return shingles.select("token", "gid", "n", "pos", F.lit(False).alias("inner")).unionByName(own)


def _meet(cells: DataFrame, groups: DataFrame, percent: int, closest: int | None = 0) -> DataFrame:
    """cells (deal, token, cell, side, gid, n, pos) -> distinct candidate pairs (a, b) of classes in different components.

    Of a cell with sides (0 and 1; -1: none) only pairs across them: a spanning
    forest of the components in cells of one deal, closest pairs of a cell first
    (closest 0), or each class's closest candidates in each cell (None: all);
    where some are left out, there is a pair of nulls.
    """

    def run(batches):
        held, forest = None, _Forest()
        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch])
            key = np.stack([np.asarray(held.column(c)) for c in KEY])
            cut = np.flatnonzero(np.any(key[:, 1:] != key[:, :-1], axis=0)) + 1
            if len(cut):
                yield from _found(held.slice(0, cut[-1]), percent, closest, forest)
                held = held.slice(cut[-1])
        if held is not None and held.num_rows:
            yield from _found(held, percent, closest, forest)

    filled = cells.join(groups.select("gid", "members"), "gid").select(*KEY, "side", "n", "pos", "members")
    return filled.repartition("deal").sortWithinPartitions(*KEY).mapInArrow(run, "a long, b long").distinct()


class _Forest:
    """Which components the pairs given so far connect, within one deal."""

    def __init__(self):
        self.deal, self.root = None, {}

    def begin(self, deal: int) -> None:
        if deal != self.deal:
            self.deal, self.root = deal, {}

    def find(self, x: int) -> int:
        root = self.root
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    def joins(self, x: int, y: int) -> bool:
        """Connect x and y; False if they are already."""
        x, y = self.find(x), self.find(y)
        self.root[max(x, y)] = min(x, y)
        return x != y


def _found(rows: pa.RecordBatch, percent: int, closest: int | None, forest: _Forest):
    """Candidate pairs of whole cells, batch by batch of about ROWS members."""
    key = np.stack([np.asarray(rows.column(c)) for c in KEY])
    start = np.concatenate([[0], np.flatnonzero(np.any(key[:, 1:] != key[:, :-1], axis=0)) + 1, [rows.num_rows]])
    members = rows.column("members")
    ends = members.offsets.to_numpy()
    # several small cells at once, a large one alone
    first = 0
    while first < len(start) - 1:
        last = max(first + 1, int(np.searchsorted(ends[start], ends[start[first]] + ROWS, "right")) - 1)
        a, b = start[first], start[last]
        cell = np.repeat(np.arange(last - first), np.diff(start[first : last + 1]))
        count = np.diff(ends[a : b + 1])
        n, pos, side = (np.repeat(np.asarray(rows.column(c)).astype(np.int64)[a:b], count) for c in ("n", "pos", "side"))
        own = members.values.slice(ends[a], ends[b] - ends[a])
        ids, comp = (np.asarray(own.field(c)) for c in ("id", "comp"))
        sig = np.frombuffer(b"".join(own.field("sig").to_pylist()), "<u8").reshape(-1, BITS // 64)
        cell = np.repeat(cell, count)
        x, y, far = _pairs(cell, ids, comp, n, pos, side, sig, percent)
        keep = np.ones(len(x), bool)
        if closest == 0:
            keep = _spanning(cell[x], x, y, comp, far, ids, key[0][start[first:last]], forest)
        elif closest is not None and len(x):
            keep = _nearest(x, y, far, closest)
        if keep.any():
            low, high = np.minimum(ids[x], ids[y])[keep], np.maximum(ids[x], ids[y])[keep]
            pairs = np.unique(np.stack([low, high], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])
        if closest and not keep.all():
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([None], pa.int64())], ["a", "b"])
        first = last


def _pairs(cell, ids, comp, n, pos, side, sig, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the ends of candidate pairs within cells, and how far these are apart."""
    order = np.lexsort((ids, n, cell))
    cell, comp, n, pos, side, sig = cell[order], comp[order], n[order], pos[order], side[order], sig[order]
    out, active, k = [], np.arange(len(cell)), 0
    while len(active):
        k += 1
        active = active[active + k < len(cell)]
        j = active + k
        near = (cell[j] == cell[active]) & (n[j] * percent <= n[active] * 100)
        i = active = active[near]
        j = j[near]
        ok = (comp[i] != comp[j]) & ((side[i] != side[j]) | (side[i] < 0))
        need = -(-percent * (n[i] + n[j]) // (100 + percent))
        ok &= np.minimum(pos[i], pos[j]) + np.minimum(n[i] - pos[i], n[j] - pos[j]) >= need
        i, j, need = i[ok], j[ok], need[ok]
        if len(i):
            apart = np.bitwise_count(sig[i] ^ sig[j]).sum(axis=1).astype(np.int64)
            ok = apart <= n[i] + n[j] - 2 * need
            out.append((i[ok], j[ok], apart[ok] / n[j[ok]]))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0)
    i, j, far = (np.concatenate(x) for x in zip(*out, strict=True))
    return order[i], order[j], far


def _spanning(cell, x, y, comp, far, ids, deals, forest: _Forest) -> np.ndarray:
    """Which pairs (rows x and y) make a spanning forest of the components, cell after cell, closest first."""
    by = np.lexsort((np.maximum(ids[x], ids[y]), np.minimum(ids[x], ids[y]), far, cell))
    keep = np.zeros(len(x), bool)
    cut = np.flatnonzero(np.diff(cell[by], prepend=-1, append=-1)) if len(by) else np.zeros(0, np.int64)
    for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        own = by[s:e]
        forest.begin(int(deals[cell[own[0]]]))
        # what earlier cells of the deal connect is left out at once
        rows = distinct(np.concatenate([x[own], y[own]]))
        roots = np.fromiter(map(forest.find, comp[rows].tolist()), np.int64, len(rows))
        own = own[roots[np.searchsorted(rows, x[own])] != roots[np.searchsorted(rows, y[own])]]
        for k, a, b in zip(own.tolist(), comp[x[own]].tolist(), comp[y[own]].tolist(), strict=True):
            keep[k] = forest.joins(a, b)
    return keep


def _nearest(x, y, far, closest: int) -> np.ndarray:
    """Which pairs are among the closest of one of their ends."""
    ends, far = np.concatenate([x, y]), np.concatenate([far, far])
    by = np.lexsort((far, ends))
    new = np.flatnonzero(np.diff(ends[by], prepend=-1))
    rank = np.empty(len(by), np.int64)
    rank[by] = np.arange(len(by)) - np.repeat(new, np.diff(np.append(new, len(by))))
    return np.minimum(rank[: len(x)], rank[len(x) :]) < closest


def _first_cells(spread: DataFrame, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Entries (deal, token, cell, side, gid, n, pos, long) of shingles that several groups have; long: the shingle has more than one cell.

    One shuffle puts the entries of a shingle together; those of a shingle that
    is known to be common go to several tasks. A cell has at most about BLOCK
    entries, and the cells of shingles whose lists begin with the same group, as
    those of near copies do, are one deal (two of each list's cells).
    """
    hot = common[1] > DEAL
    salts = spread.sparkSession.createDataFrame([(int(h), int(-(-c // DEAL))) for h, c in zip(common[0][hot].view(np.int64), common[1][hot], strict=True)], "token long, salts long")
    dealt = spread.join(F.broadcast(salts), "token", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    dealt = dealt.select("token", "gid", "n", "pos", "inner", "salts", F.pmod(F.xxhash64("gid", "token"), "salts").alias("salt"))
    whole = Window.partitionBy("token", "salt")
    counted = dealt.withColumn("len", F.count("*").over(whole)).withColumn("least", F.min("gid").over(whole)).withColumn("size", F.min("n").over(whole)).where("len > 1 or salts > 1 or inner")
    # a group is in the same block of every list of about the same length, so their forests are much the same
    blocks = F.greatest(F.lit(1), F.pow(F.lit(2), F.ceil(F.log2(F.col("len") / BLOCK)))).cast("long")
    block = F.pmod(F.xxhash64("gid"), blocks)
    # long texts have many shingles, so their cells are dealt to more tasks
    share = F.pmod(F.xxhash64("token"), 2 + F.floor(F.col("size") / SPREAD))
    return counted.select(F.xxhash64("least", block, share).alias("deal"), "token", (F.col("salt") * (1 << 32) + block).alias("cell"), F.lit(-1).alias("side"), "gid", "n", "pos", (F.col("salts") * blocks > 1).alias("long"))


def _band(n: Column, percent: int) -> Column:
    """Sizes of partners are at most one band apart."""
    return F.floor(F.log(n) / math.log(100 / percent) - 1e-9) if percent < 100 else n


def _cells(entries: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """entries of _first_cells() and groups with components -> (deal, token, cell, side, gid, n, pos): all cells that can hold pairs across components.

    A shingle with one cell keeps it. The list of any other is put in blocks:
    entries of one component with many of them by that component, the others by
    size band; cells are pairs of blocks but for those within one component or
    with sizes too far apart.
    """
    short = entries.where("not long").drop("long")
    open_ = entries.where("long").select("token", "gid", "n", "pos").join(groups.select("gid", "low", "high"), "gid")
    lists = open_.groupBy("token").agg(F.min("low").alias("l"), F.max("high").alias("h")).where("l < h").select("token")
    long_ = materialise(open_.join(lists, "token"), "long-lists").withColumn("comp", F.when(F.col("low") == F.col("high"), F.col("low")))
    if long_.isEmpty():
        return short
    big = long_.where("comp is not null").groupBy("token", "comp").agg(F.count("*").alias("big")).where(F.col("big") >= BLOCK)
    slot = F.when(F.col("big").isNotNull(), F.xxhash64(F.lit("c"), "comp")).otherwise(F.xxhash64(F.lit("b"), _band(F.col("n"), percent)))
    slotted = materialise(long_.join(big, ["token", "comp"], "left").select("token", "gid", "n", "pos", F.col("big").isNotNull().alias("pure"), slot.alias("slot")), "slots")
    sizes = slotted.groupBy("token", "slot").agg(F.ceil(F.count("*") / BLOCK).alias("subs"))
    blocked = materialise(slotted.join(sizes, ["token", "slot"]).withColumn("sub", F.pmod(F.xxhash64("gid", "token"), "subs")), "blocks")
    blocks = materialise(blocked.groupBy("token", "slot", "sub", "pure").agg(F.min("n").alias("least"), F.max("n").alias("most")), "block-sizes")
    x, y = (blocks.select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("slot", "sub", "pure", "least", "most")]) for s in "xy")
    before, same = F.struct("slot_x", "sub_x") < F.struct("slot_y", "sub_y"), (F.col("slot_x") == F.col("slot_y")) & (F.col("sub_x") == F.col("sub_y"))
    within = F.col("pure_x") & F.col("pure_y") & (F.col("slot_x") == F.col("slot_y"))
    fit = (F.col("least_x") * percent <= F.col("most_y") * 100) & (F.col("least_y") * percent <= F.col("most_x") * 100)
    pairs = x.join(y, "token").where((before | same) & ~within & fit).withColumn("cell", F.xxhash64("slot_x", "sub_x", "slot_y", "sub_y"))
    one = F.array(F.struct(F.col("slot_x").alias("slot"), F.col("sub_x").alias("sub"), F.lit(-1).alias("side")))
    two = F.array(F.struct(F.col("slot_x").alias("slot"), F.col("sub_x").alias("sub"), F.lit(0).alias("side")), F.struct(F.col("slot_y").alias("slot"), F.col("sub_y").alias("sub"), F.lit(1).alias("side")))
    sides = pairs.select("token", "cell", F.explode(F.when(same, one).otherwise(two)).alias("s")).select("token", "cell", "s.*")
    crossed = blocked.join(materialise(sides, "sides"), ["token", "slot", "sub"]).select(F.xxhash64("token", "cell").alias("deal"), "token", "cell", "side", "gid", "n", "pos")
    return short.unionByName(crossed)


def _within_reach(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with near: whether their bitmaps, as wide as the smaller set, leave room for the overlap that a link needs."""

    def check(batches):
        for batch in batches:
            near = []
            for m, n, x, y in zip(*(batch.column(c).to_pylist() for c in ("m", "n", "x", "y")), strict=True):
                width = 8 * min(len(x), len(y))
                apart = int(np.bitwise_count(folded(x, width) ^ folded(y, width)).sum())
                near.append(apart <= m + n - 2 * -(-percent * (m + n) // (100 + percent)))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(near, pa.bool_())], ["a", "b", "near"])

    # sets that the signatures cover whole have no wider bitmap
    wide = classes.select(F.col("class_id"), "n", F.coalesce("wide", "sig").alias("bits"))
    x, y = wide.select(F.col("class_id").alias("a"), F.col("n").alias("m"), F.col("bits").alias("x")), wide.select(F.col("class_id").alias("b"), "n", F.col("bits").alias("y"))
    found = pairs.join(x, "a").join(y, "b").select("a", "b", "m", "n", "x", "y").mapInArrow(check, "a long, b long, near boolean")
    return found.groupBy("a", "b").agg(F.bool_or("near").alias("near"))  # an id may have several sets


def overlap(x: bytes, y: bytes, n: int) -> tuple[int, int]:
    """Sizes of the intersection and the union of two texts' sets of n-word shingles, by their words themselves."""
    lower = (x + b"\n" + y).translate(LOWER_BYTES)
    h, start, end, text = words(np.frombuffer(lower, np.uint8), np.array([0, len(x) + 1, len(lower)]))
    numbers, many = word_numbers(lower, h, start, end)
    single = np.split(numbers, [np.searchsorted(text, 1)])
    if min(map(len, single)) < n:
        # fewer words than n are one shingle of another length, or none
        a, b = ({tuple(w[i : i + n].tolist()) for i in range(max(1, len(w) - n + 1))} if len(w) else set() for w in single)
        return len(a & b), len(a | b)
    runs, size = single, many
    for j in range(1, n):
        if size * many >= 1 << 63:
            # runs of j words get numbers without gaps
            numbered = np.unique(np.concatenate(runs), return_inverse=True)[1]
            runs, size = np.split(numbered, [len(runs[0])]), len(numbered)
        # a run of j + 1 words is its first j and its next
        runs, size = [r[:-1] * many + w[j:] for r, w in zip(runs, single, strict=True)], size * many
    a, b = map(distinct, runs)
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common, len(a) + len(b) - common


def judged(pairs: DataFrame, docs: DataFrame, n: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pairs (a, b) of document ids with overlap and united, the sizes for their whole texts, and whether they link."""

    def check(batches):
        for batch in batches:
            out = [overlap(x.as_py(), y.as_py(), n) for x, y in zip(batch.column("x"), batch.column("y"), strict=True)]
            cols = [pa.array([v[i] for v in out], pa.int64()) for i in (0, 1)]
            links = pa.array([u > 0 and 100 * i >= percent * u for i, u in out], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *cols, links], ["a", "b", "overlap", "united", "links"])

    wanted = materialise(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "wanted")
    if wanted.count() <= SENT:
        wanted = F.broadcast(wanted)
    # a text repeated under one id is one
    texts = _text(docs, id_col, text_col).join(wanted, "doc_id").dropDuplicates(["doc_id", "t"])
    x, y = texts.select(F.col("doc_id").alias("a"), F.col("t").alias("x")), texts.select(F.col("doc_id").alias("b"), F.col("t").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long, overlap long, united long, links boolean")


def _reached(pairs: DataFrame) -> DataFrame:
    """(class_id, component) of the classes on these pairs."""
    return components(pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))).withColumnRenamed("id", "class_id")


def _regrouped(groups: DataFrame, open_: DataFrame) -> DataFrame:
    """The parts of groups with their members in open_ (class_id, comp) only, under these components."""
    members = groups.select("gid", "n", F.explode("members").alias("m")).select("gid", "n", F.col("m.id").alias("class_id"), F.col("m.sig").alias("sig"))
    own = members.join(open_, "class_id").select("gid", "n", "comp", F.struct(F.col("class_id").alias("id"), "comp", "sig").alias("m"))
    return own.groupBy("gid", "n").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.collect_list("m").alias("members"))


def _labelled(classes: DataFrame, reached: DataFrame) -> DataFrame:
    """classes with comp: the component reached, or the class itself."""
    return classes.drop("comp").join(reached, "class_id", "left").withColumn("comp", F.coalesce("component", "class_id")).drop("component")


def _unsettled(tried: DataFrame, reached: DataFrame, entries: DataFrame, groups: DataFrame) -> DataFrame:
    """class_id of classes that may have links not found yet: of components between which a pair failed, and of shingles with several cells and components."""
    failed = tried.where("not links").select("a", "b")
    ends = _labelled(_labelled(failed.withColumnRenamed("a", "class_id"), reached).withColumnsRenamed({"class_id": "a", "comp": "x", "b": "class_id"}), reached)
    apart = ends.where("x <> comp").select(F.explode(F.array("x", "comp")).alias("comp")).distinct()
    first = apart.select(F.col("comp").alias("class_id")).unionByName(reached.join(apart.withColumnRenamed("comp", "component"), "component", "left_semi").select("class_id"))
    held = entries.where("long").select("token", "gid").join(groups.select("gid", F.explode("members.id").alias("class_id")), "gid").select("token", "class_id")
    named = _labelled(held, reached)
    mixed = named.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("token")
    return first.unionByName(named.join(mixed, "token", "left_semi").select("class_id")).distinct()


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, class_id, component_id for every row of docs.

    Two texts link when 100 * |intersection| >= percent * |union| of their sets
    of n-word shingles (A-Z lower-cased, words split at ASCII whitespace; fewer
    words than n are one shingle). Links are decided on the words themselves;
    sets are equal when the 128-bit digests of their 64-bit shingle hashes are.
    class_id is the least id with an equal set, component_id the least id
    reachable over links. A text that is null or has no word is empty, links with
    nothing and is its own component. Rows that share an id are one node; a row
    with a null id takes its class's component (null when no row of the class has
    an id). No rows give no rows. What is kept of a text is in proportion to its
    length, whatever it is.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent is from 50 to 100")
    tables: list[DataFrame] = []

    def kept(df: DataFrame, name: str) -> DataFrame:
        tables.append(materialise(df, name))
        return tables[-1]

    def verified(pairs: DataFrame) -> DataFrame:
        """(a, b, links) of pairs: by their words where their bitmaps leave it open."""
        near = kept(_within_reach(kept(pairs, "pairs"), classes, percent), "near")
        tried = kept(judged(near.where("near").select("a", "b"), docs, n, percent, id_col, text_col).select("a", "b", "links"), "tried")
        return tried.unionByName(near.where("not near").select("a", "b", F.lit(False).alias("links")))

    common = common_shingles(docs, n, text_col)
    records = kept(_records(docs, n, percent, common, id_col, text_col), "records")
    full = records.where("n > 0 and doc_id is not null")
    one = full.groupBy("set_key", "n").agg(F.min(F.struct("doc_id", "row", "prefix_key", "sig", "wide")).alias("one"))
    classes = kept(one.select(F.col("one.doc_id").alias("class_id"), F.col("one.doc_id").alias("comp"), "n", "one.row", "one.prefix_key", "one.sig", "one.wide"), "classes")
    groups = kept(_groups(classes), "groups")
    entries = kept(_first_cells(_spread(groups, records), common), "entries")
    tried = verified(_meet(entries, groups, percent))
    reached = kept(_reached(tried.where("links")), "reached")
    unsettled = kept(_unsettled(tried, reached, entries, groups), "unsettled")
    if not unsettled.isEmpty():
        cells = None
        for closest in CLOSEST:
            if cells is None:  # else nothing has linked since, and the same cells are compared again
                parts = kept(_regrouped(groups, _labelled(unsettled, reached)), "parts")
                cells = _cells(entries, parts, percent)
            met = kept(_meet(cells, parts, percent, closest), "met")
            more = verified(met.where("a is not null").join(tried.select("a", "b"), ["a", "b"], "left_anti"))
            tried = tried.unionByName(more)
            linked = more.where("links").count()
            # a forest says all if each of its pairs links, closest candidates if none is left out
            done = (met.count() == linked) if closest == 0 else met.where("a is null").isEmpty()
            if linked:
                reached = kept(_reached(tried.where("links")), "reached")
                cells = None
            if done:
                break
    least = records.where("doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("class_id"))
    owned = least.join(reached, "class_id", "left").select("set_key", "class_id", F.coalesce("component", "class_id").alias("component_id"))
    out = records.select("doc_id", "n", "set_key").join(owned, "set_key", "left")
    own = lambda c: F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col(c)).alias(c)
    found = materialise(out.select("doc_id", F.col("n").alias("n_shingles"), own("class_id"), own("component_id")), "components")
    discard(*tables)
    return found


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with, of each component, only the document of least id; all columns kept.

    Different texts under one id are documents of their own, of which the one of
    least hash has the id and the others come after all ids, as do texts without
    an id. Rows with equal id and text, a null id included, are one row
    afterwards; which of them stays is open where their other columns differ. A
    text that is null or has no word links with nothing and stays. Texts of any
    length are taken whole, no rows give no rows, and columns of any name pass.
    """
    key = "__node_id" + "_" * max([0, *map(len, docs.columns)])  # no column has this name
    least = key + "least"
    own, text = F.col(id_col).cast("long"), F.xxhash64(F.col(text_col))
    # usually no id has two texts, and the table is small enough for Spark to broadcast it
    hashes = docs.where(F.col(id_col).isNotNull()).select(own.alias(key), text.alias("th")).groupBy(key).agg(F.min("th").alias(least), F.max("th").alias("most"))
    shared = materialise(hashes.where(F.col(least) < F.col("most")).drop("most"), "shared-ids")
    after = F.lit(1 << 62).bitwiseOR(F.shiftrightunsigned(F.xxhash64(own, F.col(text_col)), 2))
    rows = docs.withColumn(key, own).join(shared, key, "left")
    has_id = F.col(key).isNotNull() & (F.col(least).isNull() | (F.col(least) == text))
    nodes = rows.withColumn(key, F.when(has_id, F.col(key)).otherwise(after)).drop(least)
    found = jaccard_components(nodes, n, percent, key, text_col)
    keep = found.where("doc_id = component_id").select(F.col("doc_id").alias(key)).distinct()
    return nodes.join(keep, key, "left_semi").dropDuplicates([key]).select(*docs.columns)
