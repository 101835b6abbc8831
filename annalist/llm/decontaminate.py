"""Benchmark decontamination: rare n-gram seeds, then local alignment.

Word n-grams of the test items that are rare in the corpus seed candidate
passages in the documents; a passage with as many distinct seeds of an item as
an edited copy must keep is aligned with the item (Smith-Waterman over words)
and scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import buffers, chain, text_bounds, words
from .workspace import materialise

#: Words of a seed; least share of an item's words a copy keeps; document share above which a seed is common.
SEED_WORDS, KEPT, COMMON_SHARE = 3, 0.8, 0.001
MATCH, MISMATCH, GAP = 2, -1, -1
#: Bytes of item text whose seeds are broadcast at once; a larger benchmark is taken in blocks.
BLOCK_BYTES = 16 << 20


class Items:
    """One block of test items: word hashes and n-grams, sorted for look-up."""

    def __init__(self, ids: list[int], texts: list[bytes | None]):
        h, _, _, text = words(*buffers(pa.array([t or b"" for t in texts], pa.binary())))
        bounds = text_bounds(text, len(ids))
        self.ids, self.words, self.by_n = [], [], {}
        for i, a, b in zip(ids, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b > a:
                self.ids.append(i)
                self.words.append(h[a:b])
        for k, w in enumerate(self.words):
            n = min(SEED_WORDS, len(w))
            self.by_n.setdefault(n, []).append((chain(w, n), np.full(len(w) - n + 1, k), np.arange(len(w) - n + 1)))
        for n, parts in self.by_n.items():
            g, item, pos = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((pos, item, g))
            g, item, pos = g[order], item[order], pos[order]
            values, first = np.unique(g, return_index=True)
            self.by_n[n] = (values, np.append(first, len(g)), item, pos)
        self.seed = {n: np.ones(len(v[0]), bool) for n, v in self.by_n.items()}
        self.need = np.ones(len(self.ids), np.int64)

    def choose(self, holders: dict[int, np.ndarray], documents: int) -> None:
        """Keep rare n-grams as seeds: those of at most COMMON_SHARE of the documents, and each item's rarest half in any case."""
        n_seeds, n_grams = np.zeros(len(self.ids), np.int64), np.zeros(len(self.ids), np.int64)
        for n, (values, first, item, _) in self.by_n.items():
            count = np.repeat(holders[n], np.diff(first))
            gram = np.repeat(np.arange(len(values)), np.diff(first))
            order = np.lexsort((count, item))
            start = np.searchsorted(item[order], np.arange(len(self.ids)))
            size = np.bincount(item, minlength=len(self.ids))
            rank = np.arange(len(order)) - start[item[order]]
            half = np.zeros(len(order), bool)
            half[order] = 2 * rank < size[item[order]]
            rare = half | (count <= COMMON_SHARE * documents)
            keep = np.zeros(len(values), bool)
            keep[gram[rare]] = True
            self.seed[n] = keep
            used = keep[gram]
            for total, which in ((n_seeds, used), (n_grams, np.ones(len(item), bool))):
                pairs = np.unique(np.stack([item[which], gram[which]]), axis=1)
                total += np.bincount(pairs[0], minlength=len(self.ids))
        length = np.array([len(w) for w in self.words], np.int64) if self.words else np.zeros(0, np.int64)
        edits = ((1 - KEPT) * length + 1e-9).astype(np.int64)
        self.need = np.maximum(1, n_seeds - edits * SEED_WORDS)

    def hits(self, h: np.ndarray, n: int, seeds_only: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(position in h, index into by_n[n]'s values) of each n-gram of h that an item has."""
        values = self.by_n[n][0]
        g = chain(h, n)
        if not hasattr(self, "_sieve"):
            self._sieve = {}
        if n not in self._sieve:
            self._sieve[n] = np.zeros(1 << 22, bool)
            self._sieve[n][(values & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        maybe = np.flatnonzero(self._sieve[n][(g & np.uint64((1 << 22) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(values, g[maybe]), len(values) - 1)
        ok = values[at] == g[maybe]
        if seeds_only:
            ok &= self.seed[n][at]
        return maybe[ok], at[ok]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment: (score / best possible score, first word, end word) within passage; ties: the earliest end."""
    size = len(passage)
    ramp = np.arange(size + 1) * -GAP
    row, origin = np.zeros(size + 1), np.arange(size + 1)
    best, first, end = 0.0, 0, 0
    for w in item:
        gain = np.where(passage == w, MATCH, MISMATCH)
        diagonal, up = row[:-1] + gain, row[1:] + GAP
        new, start = np.zeros(size + 1), np.arange(size + 1)
        pick = (diagonal >= up) & (diagonal > 0)
        new[1:] = np.maximum(np.maximum(diagonal, up), 0)
        start[1:] = np.where(pick, origin[:-1], np.where(up > 0, origin[1:], start[1:]))
        run = np.maximum.accumulate(new + ramp)
        source = np.maximum.accumulate(np.where(new + ramp >= run, np.arange(size + 1), 0))
        row, origin = run - ramp, start[source]
        k = int(row.argmax())
        if row[k] > best:
            best, first, end = float(row[k]), int(origin[k]), k
    return best / (MATCH * len(item)), first, end


def _passages(items: Items, h: np.ndarray, least: float):
    """(item, score, first word, end word) of each item found in one document's word hashes."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    for n in items.by_n:
        if len(h) < n:
            continue
        _, first, item, pos = items.by_n[n]
        for p, v in zip(*items.hits(h, n), strict=True):
            for k in range(first[v], first[v + 1]):
                found.setdefault(int(item[k]), []).append((int(p) - int(pos[k]), int(p), int(v)))
    for k, seeds in found.items():
        size = len(items.words[k])
        slack = max(2, int(size * (1 / KEPT - 1)) + 1)
        seeds.sort()
        at = 0
        spans = []
        for i, (diagonal, _, _) in enumerate(seeds):
            if i + 1 == len(seeds) or seeds[i + 1][0] - diagonal > slack:
                group = seeds[at : i + 1]
                if len({v for _, _, v in group}) >= items.need[k]:
                    spans.append([max(0, group[0][0] - slack), min(len(h), group[-1][0] + size + slack)])
                at = i + 1
        best = None
        for a, b in spans:
            # a span of many repeated seeds is aligned in overlapping windows, so no part of it is left out
            step = 8 * (size + slack)
            for x in range(a, b, step):
                score, s, e = align(items.words[k], h[x : min(b, x + step + 2 * (size + slack))])
                if best is None or score > best[0]:
                    best = (score, x + s, x + e)
        if best and best[0] >= least:
            yield k, *best


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word): each document with each item it holds a copy of.

    The score is that of the best local alignment over the best possible one
    (match 2, mismatch -1, gap -1 for each word); a copy with a fifth of its words
    replaced scores 0.7, the least that is reported. Words are split at ASCII
    whitespace, A-Z lower-cased. Items and texts that are null or have no word
    match nothing; items shorter than a seed match as a whole. Rows repeated under
    one id are reported each; without documents or items there are no rows.
    """
    spark = docs.sparkSession
    least = (MATCH * KEPT + MISMATCH * (1 - KEPT)) / MATCH - 1e-9
    tests = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("long").alias("i"), F.col(item_text).cast("binary").alias("t"))
    size = tests.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("t"))
    out = None
    for block in range(blocks):
        rows = tests.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block).collect()
        rows.sort(key=lambda r: (r.i, bytes(r.t or b"")))
        items = Items([r.i for r in rows], [r.t and bytes(r.t) for r in rows])
        if items.ids:
            items.choose(*_holders(source, items))
            found = _search(source, items, least)
            out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "doc_id long, item_id long, score double, first_word long, end_word long")
    return out


def _holders(source: DataFrame, items: Items) -> tuple[dict[int, np.ndarray], int]:
    """How many documents hold each n-gram of a block of items, and how many documents there are."""
    shared = source.sparkSession.sparkContext.broadcast(items)

    def count(batches):
        known, total = shared.value, 0
        sums = {n: np.zeros(len(v[0]), np.int64) for n, v in known.by_n.items()}
        for batch in batches:
            raw, offs = buffers(batch.column(1))
            h, _, _, text = words(raw, offs)
            total += len(offs) - 1
            for n, own in sums.items():
                if len(h) >= n:
                    p, v = known.hits(h, n, False)
                    inside = text[p] == text[p + n - 1]
                    pairs = np.unique(text[p[inside]] * len(own) + v[inside])
                    own += np.bincount(pairs % len(own), minlength=len(own))
        ns, index, c = [0], [0], [total]
        for n, own in sums.items():
            at = np.flatnonzero(own)
            ns += [n] * len(at)
            index += at.tolist()
            c += own[at].tolist()
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ns, index, c)], ["n", "v", "c"])

    rows = source.mapInArrow(count, "n long, v long, c long").groupBy("n", "v").agg(F.sum("c").alias("c")).collect()
    sums = {n: np.zeros(len(v[0]), np.int64) for n, v in items.by_n.items()}
    total = 0
    for r in rows:
        if r.n:
            sums[r.n][r.v] = r.c
        else:
            total = r.c
    return sums, total


def _search(source: DataFrame, items: Items, least: float) -> DataFrame:
    shared = source.sparkSession.sparkContext.broadcast(items)

    def search(batches):
        known = shared.value
        for batch in batches:
            raw, offs = buffers(batch.column(1))
            h, _, _, text = words(raw, offs)
            bounds = text_bounds(text, len(offs) - 1)
            touched: set[int] = set()
            for n in known.by_n:
                if len(h) >= n:
                    p, _ = known.hits(h, n)
                    touched.update(np.unique(text[p]).tolist())
            rows = []
            ids = batch.column(0).to_pylist()
            for i in sorted(touched):
                rows += [(ids[i], known.ids[k], s, a, b) for k, s, a, b in _passages(known, h[bounds[i] : bounds[i + 1]], least)]
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "item_id", "score", "first_word", "end_word"])

    return source.mapInArrow(search, "doc_id long, item_id long, score double, first_word long, end_word long")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the documents that hold a copy of a test item, all columns as they are.

    Rows that share an id are one document: a copy in one of them removes all.
    Rows with a null id are judged by their text, equal texts alike.
    """
    keyed = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.col(text_col))).alias("key"), F.col(text_col).alias("t"))
    bad = materialise(contaminated(keyed.select("key", "t"), benchmark, "key", "t").select(F.col("doc_id").alias("key")).distinct(), "contaminated")
    return keyed.join(bad, "key", "left_anti").select("row.*")
