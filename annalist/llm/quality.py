"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed from bytes in numpy, trees are grown on binned values
of a bounded sample of labelled rows, and scoring walks all trees at once over
flat arrays.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .kernels import buffers, text_bounds, words

#: Most labelled rows a model is fitted on.
SAMPLE_ROWS = 20_000
BINS, TREES, DEPTH, RATE, L2, LEAF = 64, 120, 5, 0.1, 1.0, 10.0
THRESHOLD = 0.7

CLASSES = 8
_KIND = np.full(256, 7, np.uint8)  # 7: part of a character beyond ASCII
_KIND[:128] = 5  # control
_KIND[0x20:0x7F] = 4  # sign
_KIND[[0x20, *range(0x09, 0x0E)]] = 3
_KIND[0x30:0x3A] = 2
_KIND[0x41:0x5B] = 1
_KIND[0x61:0x7B] = 0
_KIND[np.frombuffer(b".,;:'\"!?-()", np.uint8)] = 6  # punctuation of prose
STATISTICS = [
    "log_bytes", "log_words", "lower", "upper", "digit", "space", "sign", "control", "prose", "beyond", "word_mean", "word_sd", "word_max",
    "distinct_words", "top_word", "repeated_next", "sign_end_words", "stop_end_words", "log_lines", "line_mean", "distinct_lines", "stop_end_lines", "capital_words", "bigram_distinct",
]


def statistics(column: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text; a null or empty text has zeros."""
    raw, offs = buffers(column)
    n = len(offs) - 1
    out = np.zeros((n, len(STATISTICS)))
    h, start, end, text = words(raw, offs)
    bounds = text_bounds(text, n)
    size = end - start
    kind = _KIND[raw]
    last, first = kind[end - 1] if len(end) else size, kind[start] if len(start) else size
    for i in range(n):
        a, b = offs[i], offs[i + 1]
        if a == b:
            continue
        share = np.bincount(kind[a:b], minlength=CLASSES) / (b - a)
        w, m = slice(bounds[i], bounds[i + 1]), int(bounds[i + 1] - bounds[i])
        row = [np.log1p(b - a), np.log1p(m), share[0], share[1], share[2], share[3], share[4], share[5], share[6], share[7]]
        if m:
            _, counts = np.unique(h[w], return_counts=True)
            s, own = size[w], h[w]
            pairs = len(np.unique(own[1:] * np.uint64(3) + own[:-1])) / (m - 1) if m > 1 else 1.0
            row += [s.mean(), s.std(), s.max(), len(counts) / m, counts.max() / m, np.mean(own[1:] == own[:-1]) if m > 1 else 0.0, np.mean(last[w] == 4), np.mean(last[w] == 6)]
        else:
            row += [0.0] * 8
            pairs = 0.0
        body = raw[a:b].tobytes()
        lines = body.split(b"\n")
        row += [np.log1p(len(lines)), (b - a) / len(lines), len(set(lines)) / len(lines), sum(x.rstrip().endswith((b".", b"!", b"?")) for x in lines) / len(lines), np.mean(first[w] == 1) if m else 0.0, pairs]
        out[i] = row
    return out


@dataclass
class Trees:
    """All trees in flat arrays; a leaf's children are itself."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def score(self, x: np.ndarray, rows: int = 2048) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        out = np.full(len(x), self.base)
        for a in range(0, len(x) if len(self.roots) else 0, rows):
            part = x[a : a + rows]
            at = np.broadcast_to(self.roots, (len(part), len(self.roots))).copy()
            every = np.arange(len(part))[:, None]
            for _ in range(DEPTH):
                at = np.where(part[every, self.feature[at]] > self.cut[at], self.right[at], self.left[at])
            out[a : a + rows] += self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-out))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Trees:
    """Logistic loss, second-order leaf values, level-wise histogram splits.

    Without rows, or with one label only, the score is that label's (smoothed) share.
    """
    n, width = x.shape
    mean = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(mean / (1 - mean)))
    nodes: list[list[float]] = []
    roots: list[int] = []
    if n and 0 < y.sum() < n:
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
        binned = np.stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(width)], axis=1)
        flat = binned + np.arange(width) * BINS
        raw = np.full(n, base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-raw))
            g, hess = p - y, np.maximum(p * (1 - p), 1e-6)
            roots.append(len(nodes))
            level = [(len(nodes), np.arange(n))]
            nodes.append([0, 0, len(nodes), len(nodes), 0])
            for depth in range(DEPTH + 1):
                following = []
                for node, rows in level:
                    gs, hs = g[rows].sum(), hess[rows].sum()
                    best, gain = None, 1e-6
                    if depth < DEPTH and len(rows) >= 2 * LEAF:
                        cells, times = flat[rows].ravel(), width
                        hg = np.bincount(cells, np.repeat(g[rows], times), width * BINS).reshape(width, BINS).cumsum(1)
                        hh = np.bincount(cells, np.repeat(hess[rows], times), width * BINS).reshape(width, BINS).cumsum(1)
                        hn = np.bincount(cells, minlength=width * BINS).reshape(width, BINS).cumsum(1)
                        won = hg**2 / (hh + L2) + (gs - hg) ** 2 / (hs - hh + L2) - gs**2 / (hs + L2)
                        won[(hn < LEAF) | (len(rows) - hn < LEAF)] = -np.inf
                        k = int(won.argmax())
                        if won.flat[k] > gain:
                            best = divmod(k, BINS)
                    if best is None or best[1] >= len(edges[best[0]]):
                        nodes[node][4] = -RATE * gs / (hs + L2)
                        raw[rows] += nodes[node][4]
                        continue
                    f, b = best
                    right = binned[rows, f] > b
                    children = [len(nodes), len(nodes) + 1]
                    nodes += [[0, 0, c, c, 0] for c in children]
                    nodes[node][:4] = [f, edges[f][b], *children]
                    following += [(children[0], rows[~right]), (children[1], rows[right])]
                level = following
    table = np.array(nodes, float).reshape(-1, 5)
    ints = [table[:, c].astype(np.int64) for c in (0, 2, 3)]
    return Trees(ints[0], table[:, 1], ints[1], ints[2], table[:, 4], np.array(roots, np.int64), base)


@F.arrow_udf(ArrayType(DoubleType()))
def measure(text: pa.Array) -> pa.Array:
    found = statistics(text)
    return pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), len(STATISTICS)).cast(pa.list_(pa.float64()))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> Trees:
    """Trees for label_col (0 or 1), from at most `rows` labelled documents.

    Labelled rows are taken by a hash of their id at the rate that gives about
    `rows`, so which are taken does not depend on their order; null labels and
    labels without a document are left out. A document with two different labels
    counts with both, one repeated label counts once. Of documents that repeat an id
    the one of least statistics counts, so at most one row an id and label is read.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(id_col, F.col(label_col).cast("double").alias("__y")).distinct()
    rate = min(1.0, 0.97 * rows / max(1, known.count()))
    taken = known.where(F.pmod(F.xxhash64(id_col, F.lit("quality")), F.lit(1 << 20)) < int(rate * (1 << 20)) + (rate == 1))
    found = docs.select(id_col, text_col).join(F.broadcast(taken), id_col).select(id_col, measure(F.col(text_col).cast("binary")).alias("x"), "__y").groupBy(id_col, "__y").agg(F.min("x").alias("x")).select("x", "__y").toArrow()
    if not found.num_rows:
        return grow(np.zeros((0, len(STATISTICS))), np.zeros(0))
    x = np.stack(found.column("x").to_numpy())
    y = (found.column("__y").to_numpy() > 0).astype(float)
    order = np.lexsort((*x.T, y))
    return grow(x[order], y[order])


def score(docs: DataFrame, model: Trees, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with score (0 to 1, higher: label 1 likelier) and predicted, replacing columns of those names.

    A null or empty text has the score of all-zero statistics, equal texts have
    equal scores, repeated rows are scored each. Statistics are of whole texts; a
    very long one is measured alone. No rows give no rows.
    """

    @F.arrow_udf("double")
    def run(text: pa.Array) -> pa.Array:
        return pa.array(model.score(statistics(text)))

    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    out = docs.select(*rest, run(F.col(text_col).cast("binary")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
