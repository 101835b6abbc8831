"""Suffix-array deduplication: bytes covered by any long string that starts elsewhere too.

Every window of `length` bytes names an anchor, the least k-gram hash in it, so
equal windows name the same anchor at the same place. The windows of a text
that name one anchor form a region, and only regions whose anchor occurs more
than once can hold a repeat. Regions with equal bytes are one; the different
regions of an anchor go to one shard, whose suffixes are put in order by
external induced sorting with common prefixes (induced_sort). Neighbours that
share `length` bytes are repeats, and every text collects the bytes its
repeated windows cover.

An anchor with more bytes of regions than a share of a shard is split without
loss: windows that are equal have the anchor at the same offset, so a region is
cut in the windows of the lower and of the upper half of the offsets, and each
half is grouped by the bytes all its windows share, more than the anchor. Halves
are cut again until a group is small; a single window shares all its bytes.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .induced_sort import HELD, sorted_blocks
from .kernels import PORTION, U64, buffers, portions
from .workspace import NULL_ID, materialise

LENGTH, GRAM = 200, 32
#: Bytes of regions that a shard aims at, and positions hashed at once.
SHARD_BYTES, SLICE = 2 << 20, 1 << 18
#: Part of a shard that the regions of one group may fill before the group is split.
GROUP_SHARE = 8
_BASE = 0x9E3779B97F4A7C15
_ODD = np.random.default_rng(7).integers(1, 2**63, 32, dtype=np.uint64) | U64(1)


def _gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the gram bytes (a multiple of eight) from each position on."""
    raw = np.ascontiguousarray(raw)
    eights = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))  # the eight bytes from each position on
    size = len(raw) - gram + 1
    acc = eights[:size] * _ODD[0]
    for j in range(1, gram // 8):
        acc ^= acc >> U64(31)
        acc += eights[8 * j : 8 * j + size] * _ODD[j]
    acc ^= acc >> U64(29)
    acc *= U64(_BASE)
    acc ^= acc >> U64(32)
    return acc


def _window_least(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first window, windows) of each least value of windows of width values, the leftmost of equals, in order.

    Small values (one in 32) decide nearly every window; where a window has none,
    all values around it count.
    """
    n = len(h)
    c = np.flatnonzero(h < U64(1 << 59))
    fence = np.concatenate([[-1], c, [n]])
    for a in np.flatnonzero(np.diff(fence) > width).tolist():
        c = np.concatenate([c, np.arange(fence[a] + 1, fence[a + 1])])
    c.sort()
    v = h[c]
    bounds = []
    for way in (-1, 1):
        stop = np.full(len(c), -width if way < 0 else n + width)
        active, k = np.arange(len(c)), 0
        while len(active):
            k += 1
            j = active + way * k
            near = (j >= 0) & (j < len(c))
            active, j = active[near], j[near]
            near = np.abs(c[j] - c[active]) < width
            active, j = active[near], j[near]
            less = v[j] <= v[active] if way < 0 else v[j] < v[active]
            stop[active[less]] = c[j[less]]
            active = active[~less]
        bounds.append(stop)
    low = np.maximum(np.maximum(c - width + 1, bounds[0] + 1), 0)
    high = np.minimum(np.minimum(c, bounds[1] - width), n - width)
    own = low <= high
    return c[own], low[own], (high - low + 1)[own]


def regions(raw: np.ndarray, offs: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, windows, anchor's place) of every region of texts that stand one after another, in order.

    A region lies within one text; a text shorter than length has none.
    """
    width, total = length - gram + 1, len(raw)
    ends = np.unique(offs[1:])
    parts = []
    for at in range(0, total - length + 1, SLICE):
        end = min(total, at + SLICE + length - 1)
        h = _gram_hashes(raw[at:end], gram)
        # a gram that runs over the end of a text is no anchor
        over = (ends[(ends > at) & (ends < end + gram)][:, None] - np.arange(1, gram)).ravel() - at
        h[over[(over >= 0) & (over < len(h))]] = np.iinfo(np.uint64).max
        place, first, count = _window_least(h, width)
        parts.append((h[place], first + at, count, place + at))
    if not parts:
        none = np.zeros(0, np.int64)
        return np.zeros(0, U64), none, none, none
    h, start, count, place = (np.concatenate(x) for x in zip(*parts, strict=True))
    new = np.flatnonzero(np.diff(place, prepend=-1))  # a region that a slice cut in two is one
    h, start, count, place = h[new], start[new], np.add.reduceat(count, new), place[new]
    text = np.searchsorted(offs, place, "right") - 1
    low, high = np.maximum(start, offs[text]), np.minimum(start + count - 1, offs[text + 1] - length)
    own = low <= high
    return h[own], low[own], (high - low + 1)[own], place[own]


def _rows(docs: DataFrame, length: int, full: bool) -> DataFrame:
    """a: anchors of all regions; if full also r (hash of the region's bytes), k, th, s (first window), n (bytes), p (place of the anchor in the region)."""

    def run(batches):
        names = ["a", "r", "k", "th", "s", "n", "p"]
        types = [pa.int64(), pa.binary(), *[pa.int64()] * 5]
        for batch in batches:
            at = 0
            for part in portions(batch.column("t")):
                raw, offs = buffers(part)
                ids, ths = (np.asarray(batch.column(c).slice(at, len(part))) for c in ("k", "th"))
                at += len(part)
                h, start, count, place = regions(raw, offs, length)
                if not len(h):
                    continue
                cols = [h.view(np.int64)]
                if full:
                    text = np.searchsorted(offs, start, "right") - 1
                    size, whole = count + length - 1, memoryview(raw)
                    digests = [xxhash.xxh3_128_digest(whole[s : s + n]) for s, n in zip(start.tolist(), size.tolist(), strict=True)]
                    cols += [digests, ids[text], ths[text], start - offs[text], size, place - start]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=False)], names[: len(cols)])
                pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, "a long, r binary, k long, th long, s long, n long, p long" if full else "a long")


def _halves(level: DataFrame, length: int) -> DataFrame:
    """level (c, body, p, lo, hi): regions and their offsets lo to hi -> (c, at, g, d, body, p, lo, hi) of the two halves.

    at is where a half's body begins in its region's, d the hash of the body and
    g that of the bytes all windows of these offsets share.
    """

    def run(batches):
        names = ["c", "at", "g", "d", "body", "p", "lo", "hi"]
        types = [pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 3]
        for batch in batches:
            out = []
            for c, body, p, lo, hi in zip(*(batch.column(x).to_pylist() for x in ("c", "body", "p", "lo", "hi")), strict=True):
                mid = (lo + hi) // 2
                for x, y in ((lo, mid), (mid + 1, hi)):
                    first, last = max(0, p - y), min(len(body) - length, p - x)
                    if first <= last:
                        own = body[first : last + length]
                        g = xxhash.xxh3_64_intdigest(body[p - x : p - y + length], seed=x * length + y)
                        out.append((c, first, g - (1 << 63), xxhash.xxh3_128_digest(own), own, p - first, x, y))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(list(zip(*out, strict=True)) or [[]] * 8, types, strict=True)], names)

    return level.mapInArrow(run, "c binary, at long, g long, d binary, body binary, p long, lo long, hi long")


def _split(level: DataFrame, length: int, limit: int) -> tuple[list[DataFrame], list[DataFrame], list[DataFrame]]:
    """(links (c, at, d), whole (r, spans), groups (a, r, body) to be sorted) of each level, until no group is over limit bytes."""
    links, whole, groups = [], [], []
    while True:
        halves = materialise(_halves(level, length), "halves")
        kinds = materialise(halves.groupBy("g", "d").agg(F.count("*").alias("times"), F.first(F.struct("body", "p", "lo", "hi")).alias("one")).select("g", "d", "times", "one.*"), "half_kinds")
        several = materialise(kinds.groupBy("g").agg(F.count("*").alias("kinds"), F.sum(F.length("body")).alias("bytes"), F.max(F.col("hi") - F.col("lo")).alias("wide")).where("kinds > 1"), "half_groups")
        large = several.where((F.col("bytes") > limit) & (F.col("wide") > 0)).select("g")
        small = kinds.join(F.broadcast(large), "g", "left_anti").join(several.select("g"), "g")
        links.append(halves.select("c", "at", "d"))
        whole.append(kinds.where("times > 1").select(F.col("d").alias("r"), F.array(F.lit(0), F.length("body")).alias("spans")))
        groups.append(small.select(F.col("g").alias("a"), F.col("d").alias("r"), "body"))
        if large.isEmpty():
            return links, whole, groups
        level = kinds.join(F.broadcast(large), "g").select(F.col("d").alias("c"), "body", "p", "lo", "hi")


def _sorted_shards(contents: DataFrame, length: int, held: int) -> DataFrame:
    """contents (shard, a, r, body), together by shard and sorted -> (a, r, starts): window starts of each region that repeat."""

    def run(batches):
        shard, own = None, []
        for batch in batches:
            for s, a, r, body in zip(*(batch.column(c).to_pylist() for c in ("shard", "a", "r", "body")), strict=True):
                if s != shard and own:
                    yield _repeats(own, length, held)
                    own = []
                    pa.default_memory_pool().release_unused()
                shard = s
                own.append((a, r, body))
        if own:
            yield _repeats(own, length, held)

    return contents.mapInArrow(run, "a long, r binary, spans array<int>")


def _repeats(own: list[tuple[int, bytes, bytes]], length: int, held: int) -> pa.RecordBatch:
    """The covered stretches (start, end, start, end, ...) of each region of one shard, relative to the region."""
    sizes = np.array([len(x[2]) + 1 for x in own])
    ends = np.cumsum(sizes)
    text = np.zeros(ends[-1] + 1, np.int16)
    text[: ends[-1]] = np.frombuffer(b"".join(x[2] + b"\0" for x in own), np.uint8)
    text[: ends[-1]] += 2
    text[ends - 1], text[-1] = 1, 0
    hit = np.zeros(len(text), bool)
    previous = None
    for pos, lcp in sorted_blocks(text, 258, length, held):
        again = lcp >= length
        if previous is not None and again[0]:
            hit[previous] = True
        hit[pos[again]] = True
        hit[pos[:-1][again[1:]]] = True
        previous = pos[-1]
    at = np.flatnonzero(hit[:-1])
    region = np.searchsorted(ends, at, "right")
    inside = ends[region] - 1 - at >= length  # bytes from a position to its region's end
    at, region = at[inside], region[inside]
    base = ends - sizes
    spans: list[list[int]] = [[] for _ in own]
    if len(at):
        new = np.flatnonzero(np.concatenate([[True], (region[1:] != region[:-1]) | (at[1:] - at[:-1] > length)]))
        last = np.append(new[1:] - 1, len(at) - 1)
        for w, a, b in zip(region[new].tolist(), at[new].tolist(), at[last].tolist(), strict=True):
            spans[w] += [int(a - base[w]), int(b - base[w] + length)]
    keep = [i for i, s in enumerate(spans) if s]
    return pa.RecordBatch.from_arrays([pa.array([own[i][0] for i in keep], pa.int64()), pa.array([own[i][1] for i in keep], pa.binary()), pa.array([spans[i] for i in keep], pa.list_(pa.int32()))], ["a", "r", "spans"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", held: int = HELD, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """docs' other columns with n_bytes, n_removed, n_spans, spans (start, end, ...) and kept (the bytes that remain).

    A byte goes when a string of `length` bytes that covers it also starts
    elsewhere, in the same text or another; overlaps count, and all is judged on
    the input. Texts are UTF-8 bytes, a null text is empty. Rows that share an id
    are different texts, and rows that are repeated whole are repeats of each
    other. The text column is replaced by kept (binary, for a cut may split a
    character), all others pass through whatever their names. A very long text
    is one of many regions to the sorter, but is cut as a whole. No documents give
    no rows.
    """
    made = ("n_bytes", "n_removed", "n_spans", "spans", "kept")
    rest = [c for c in docs.columns if c not in (*made, text_col)]
    keyed = docs.select(F.struct(*rest).alias("row"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("t"), F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("k")).withColumn("th", F.xxhash64("t"))
    slim = keyed.select("k", "th", "t")
    repeated = _rows(slim, length, False).groupBy("a").count().where("count > 1").select("a")
    found = materialise(_rows(slim, length, True).join(repeated, "a"), "regions")
    # regions with equal bytes: all of each is repeated when there are two
    kinds = materialise(found.groupBy("a", "r").agg(F.count("*").alias("times"), F.min(F.struct("k", "th", "s", "n", "p")).alias("one")), "kinds")
    limit = max(1, shard_bytes // GROUP_SHARE)
    several = materialise(kinds.groupBy("a").agg(F.count("*").alias("kinds"), F.sum("one.n").alias("bytes")).where("kinds > 1"), "several")
    large = several.where(F.col("bytes") > limit).select("a")
    small = kinds.join(F.broadcast(large), "a", "left_anti").join(several.select("a"), "a")
    wanted = materialise(small.select("a", "r", "one.*"), "wanted")

    def pull(batches):
        names, types = ["a", "r", "body", "p"], [pa.int64(), pa.binary(), pa.binary(), pa.int64()]
        seen = set()  # rows of the same id and text give their regions once
        for batch in batches:
            out, held = [[], [], [], []], 0
            for k, th, t, own in zip(batch.column("k").to_pylist(), batch.column("th").to_pylist(), batch.column("t"), batch.column("spots"), strict=True):
                if (k, th) in seen:
                    continue
                seen.add((k, th))
                t = t.as_py()
                for x in own.as_py():
                    body = t[x["s"] : x["s"] + x["n"]]
                    held += len(body)
                    for column, value in zip(out, (x["a"], x["r"], body, x["p"]), strict=True):
                        column.append(value)
                if held > PORTION >> 2:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, types, strict=True)], names)
                    out, held = [[], [], [], []], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, types, strict=True)], names)

    def bodies(rows: DataFrame) -> DataFrame:
        lists = rows.groupBy("k", "th").agg(F.collect_list(F.struct("a", "r", "s", "n", "p")).alias("spots"))
        return slim.join(lists, ["k", "th"]).select("k", "th", "t", "spots").mapInArrow(pull, "a long, r binary, body binary, p long")

    pulled, total = bodies(wanted).select("a", "r", "body"), wanted.agg(F.sum("n")).first()[0] or 0
    links, halved = [], []
    if not large.isEmpty():
        hot = materialise(kinds.join(F.broadcast(large), "a").select("a", "r", "one.*"), "hot")
        links, halved, groups = _split(bodies(hot).select(F.col("r").alias("c"), "body", "p", F.lit(0).cast("long").alias("lo"), F.lit(length - GRAM).cast("long").alias("hi")), length, limit)
        rest = materialise(reduce(DataFrame.unionByName, groups), "groups")
        pulled, total = pulled.unionByName(rest), total + (rest.agg(F.sum(F.length("body"))).first()[0] or 0)
    shards = max(1, -(-total // shard_bytes))
    dealt = pulled.withColumn("shard", F.pmod(F.xxhash64("a"), F.lit(shards)).cast("int")).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "a", "r")
    sorted_ = materialise(_sorted_shards(dealt, length, held), "sorted")
    # what is repeated in a half is repeated in the region it was cut from
    partial = reduce(DataFrame.unionByName, [sorted_.select("r", "spans"), *halved])
    for own in reversed(links):
        moved = own.join(partial, own.d == partial.r).select(F.col("c").alias("r"), F.transform("spans", lambda x: (x + F.col("at")).cast("int")).alias("spans"))
        partial = materialise(partial.unionByName(moved).groupBy("r").agg(F.flatten(F.collect_set("spans")).alias("spans")), "partial")
    whole = kinds.where("times > 1").select("r", F.array(F.lit(0), F.col("one.n").cast("int")).alias("spans"))
    marks = materialise(whole.unionByName(partial.join(whole.select("r"), "r", "left_anti")), "marks")
    covered = found.select("r", "k", "th", "s").join(marks, "r").groupBy("k", "th").agg(F.collect_set(F.struct("s", "spans")).alias("marks"))

    @F.arrow_udf("struct<spans: array<long>, removed: long, kept: binary>")
    def cut(text: pa.Array, marks: pa.Array) -> pa.Array:
        all_spans, removed, kept = [], [], []
        for t, own in zip(text, marks, strict=True):
            t, own = t.as_py(), own.as_py()
            if not own:
                all_spans.append([])
                removed.append(0)
                kept.append(t)
                continue
            pairs = sorted((x["s"] + a, x["s"] + b) for x in own for a, b in zip(x["spans"][::2], x["spans"][1::2], strict=True))
            merged: list[list[int]] = []
            for a, b in pairs:
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            edges = [0, *[x for pair in merged for x in pair], len(t)]
            kept.append(b"".join(t[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            all_spans.append([x for pair in merged for x in pair])
            removed.append(len(t) - len(kept[-1]))
        return pa.StructArray.from_arrays([pa.array(all_spans, pa.list_(pa.int64())), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())], ["spans", "removed", "kept"])

    out = keyed.join(covered, ["k", "th"], "left").select("row", F.length("t").cast("long").alias("n_bytes"), cut(F.col("t"), F.col("marks")).alias("c"))
    return out.select("row.*", "n_bytes", F.col("c.removed").alias("n_removed"), (F.size("c.spans") / 2).cast("long").alias("n_spans"), F.col("c.spans").alias("spans"), F.col("c.kept").alias("kept"))
