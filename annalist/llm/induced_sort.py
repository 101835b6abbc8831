"""External induced sorting of suffixes with their common-prefix lengths.

Suffixes are sorted by induction from the leftmost-S suffixes: a monotone
priority queue with one first-in-first-out lane for each first symbol hands
out (position, common prefix with the one before) in order, and every suffix
handed out puts the suffix one to its left into a lane. Lanes are kept on disk
beyond a fixed budget of memory. Common prefixes are carried along: one more
than the least seen between two suffixes that put into the same lane.

The order is exact to `depth` symbols, which is all a search for repeats of
that length needs; suffixes alike to that depth stand together in any order.
"""

from __future__ import annotations

import tempfile

import numpy as np

#: Entries of a queue that are held in memory before lanes go to disk.
HELD = 8_000_000
#: A reduced text is sorted by another induction while its symbols are fewer than this share of its length.
DENSE, LANES, BASE = 0.02, 4096, 50_000


class LaneQueue:
    """A monotone priority queue of (position, common prefix) blocks: one lane for each symbol, spilled to disk over HELD entries."""

    def __init__(self, lanes: int, held: int = HELD):
        self.lanes: list[list] = [[] for _ in range(lanes)]
        self.held, self.limit, self.file, self.spilled = 0, held, None, 0

    def push(self, lane: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.lanes[lane].append((pos, lcp))
        self.held += len(pos)
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for lane in self.lanes:
            for i, block in enumerate(lane):
                if len(block) == 2:  # neither spilled nor taken
                    at = self.file.tell()
                    self.file.write(block[0].tobytes())
                    self.file.write(block[1].tobytes())
                    lane[i] = (at, len(block[0]), block[0].dtype)
                    self.spilled += len(block[0])
        self.held = 0

    def pop(self, lane: int):
        """The lane's entries in order, as few blocks as its share of memory allows; entries pushed meanwhile come too."""
        queue, i = self.lanes[lane], 0
        while i < len(queue):
            taken, size = [], 0
            while i < len(queue) and (not taken or size < self.limit // 8):
                block = queue[i]
                if len(block) == 3:
                    self.file.seek(block[0])
                    pos = np.frombuffer(self.file.read(block[1] * block[2].itemsize), block[2])
                    block = (pos, np.frombuffer(self.file.read(block[1]), np.uint8))
                else:
                    self.held -= len(block[0])
                taken.append(block)
                size += len(block[0])
                queue[i] = ()
                i += 1
            yield taken[0] if len(taken) == 1 else tuple(np.concatenate(x) for x in zip(*taken, strict=True))
        self.lanes[lane] = []


def _types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is of type S (smaller than the one to its right); the last symbol is the one least, and S."""
    n = len(text)
    sign = np.sign(np.diff(text.astype(np.int64)))
    # equal neighbours take the type of the next that differ
    index = np.where(sign != 0, np.arange(n - 1), n)
    nearest = np.minimum.accumulate(index[::-1])[::-1] if n > 1 else index
    out = np.ones(n, bool)
    if n > 1:
        known = nearest < n
        out[:-1][known] = sign[nearest[known]] > 0
        out[:-1][~known] = False
    return out


class _Scan:
    """One sweep over the order: puts left neighbours of what it is given into lanes, carrying common prefixes."""

    def __init__(self, text: np.ndarray, small: np.ndarray, want_small: bool, sigma: int, cap: int, held: int):
        self.text, self.small, self.want, self.cap = text, small, want_small, cap
        self.queue = LaneQueue(sigma, held)
        self.least = np.full(sigma, cap, np.uint8)  # of the prefixes since a lane's last entry
        self.used = np.zeros(sigma, bool)

    def give(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        if not len(pos):
            return
        left = pos - 1
        ok = (pos > 0) & (self.small[left] == self.want)
        at = np.flatnonzero(ok)
        symbol = self.text[left[at]]
        # a stable sort of 16-bit keys counts them
        order = np.argsort(symbol.astype(np.uint16) if len(self.least) <= 65536 else symbol, kind="stable")
        at, symbol = at[order], symbol[order]
        low = lcp.min()
        before, self.least = self.least, np.minimum(self.least, low)
        if not len(at):
            return
        cut = np.flatnonzero(np.diff(symbol, prepend=-1))
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(at)], strict=True):
            c, idx = int(symbol[a]), at[a:b]
            starts = np.empty(len(idx), np.int64)
            starts[0], starts[1:] = 0, idx[:-1] + 1
            seg = np.minimum.reduceat(lcp[: idx[-1] + 1], starts)
            seg[0] = min(int(seg[0]), int(before[c]))
            seg = np.minimum(seg.astype(np.int64) + 1, self.cap).astype(np.uint8)
            if not self.used[c]:
                seg[0], self.used[c] = 0, True
            rest = lcp[idx[-1] + 1 :]
            self.least[c] = rest.min() if len(rest) else self.cap
            self.queue.push(c, left[idx], seg)


def _common(text: np.ndarray, a: int, b: int, cap: int) -> int:
    x, y = text[a : a + cap], text[b : b + cap]
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    return int(differ[0]) if len(differ) else n


def induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, seed_lcp: np.ndarray, sigma: int, cap: int, held: int = HELD):
    """Blocks of (position, common prefix with the one before) of all suffixes in descending order.

    seeds: the leftmost-S positions, ascending by suffix, with their common prefixes.
    """
    kind = np.int32 if len(text) < 2**31 else np.int64
    first = text[seeds]
    bounds = np.searchsorted(first, np.arange(sigma + 1))
    up = _Scan(text, small, False, sigma, cap, held)
    large = LaneQueue(sigma, held)
    for c in range(sigma):
        last = None
        for pos, lcp in up.queue.pop(c):
            large.push(c, pos, lcp)
            last = pos[-1]
            up.give(pos, lcp)
        own, lcp = seeds[bounds[c] : bounds[c + 1]].astype(kind), seed_lcp[bounds[c] : bounds[c + 1]].copy()
        if len(own):
            lcp[0] = 0 if last is None else _common(text, int(last), int(own[0]), cap)
            up.give(own, lcp)
    down = _Scan(text, small, True, sigma, cap, held)
    for c in range(sigma - 1, -1, -1):
        last = None
        for pos, lcp in down.queue.pop(c):
            last = pos[-1]
            yield pos, lcp
            down.give(pos, lcp)
        blocks = list(large.pop(c))
        if blocks:
            pos, lcp = (np.concatenate(x) for x in zip(*blocks, strict=True))
            pos, turned = pos[::-1], np.empty_like(lcp)
            turned[0] = 0 if last is None else _common(text, int(last), int(pos[0]), cap)
            turned[1:] = lcp[:0:-1]
            yield pos, turned
            down.give(pos, turned)
    # the end has no right neighbour that would put it into a lane
    yield np.array([len(text) - 1], kind), np.zeros(1, np.uint8)


def _hash_runs(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    base, inverse = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 2**64)
    up, down = np.full(len(text), base, np.uint64), np.full(len(text) + 1, inverse, np.uint64)
    up[:1] = down[0] = 1
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(0x1B873593)) * np.multiply.accumulate(up), out=sums[1:])
    return (sums[end] - sums[start]) * np.multiply.accumulate(down)[start]


def _doubled(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of names, exact to depth symbols, by doubling ranks."""
    rank, step, n = names.astype(np.int64), 1, len(names)
    while True:
        order = np.argsort(rank, kind="stable")
        new = np.flatnonzero(np.diff(rank[order], prepend=-1))
        dense = np.zeros(n, np.int64)
        dense[new] = 1
        rank[order] = np.cumsum(dense) - 1
        if len(new) == n or step >= depth:
            return order
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1 if step < n else 0
        rank = rank * (n + 1) + after
        step *= 2


def seeds_in_order(text: np.ndarray, small: np.ndarray, sigma: int, depth: int, held: int = HELD) -> tuple[np.ndarray, np.ndarray]:
    """Leftmost-S positions ascending by suffix, and their common prefixes (at most 255)."""
    star = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(star) < 2:
        return star, np.zeros(len(star), np.uint8)
    rough = star[np.argsort(text[star], kind="stable")]
    where = np.full(len(text), -1, np.int64)
    where[star] = np.arange(len(star))
    # induction from any order within a symbol sorts the stretches between leftmost-S positions
    order = np.concatenate([where[p] for p, _ in induce(text, small, rough, np.zeros(len(rough), np.uint8), sigma, 255, held)])[::-1]
    order = order[order >= 0]
    end = np.append(star[1:] + 1, len(text))
    h = _hash_runs(text, star, end)[order]
    size = (end - star)[order]
    names = np.empty(len(star), np.int64)
    names[order] = np.cumsum(np.concatenate([[0], ((h[1:] != h[:-1]) | (size[1:] != size[:-1])).astype(np.int64)]))
    kinds = int(names.max()) + 1
    if kinds < len(star):
        # every stretch but the last covers two symbols or more
        reach = depth // 2 + 1
        if kinds <= LANES and kinds <= DENSE * len(star) and len(star) > BASE:
            reduced = np.append(names + 1, 0)
            order = np.array(sorted_suffixes(reduced, kinds + 1, reach, held)[0][::-1])
            order = order[order < len(star)]
        else:
            order = _doubled(names, reach)
    seeds = star[order]
    # seeds whose stretches differ part within the shorter's reach of the longer
    most = np.where(names[order[1:]] == names[order[:-1]], depth, np.maximum((end - star)[order[1:]], (end - star)[order[:-1]]))
    return seeds, _prefixes(text, seeds, most)


def _prefixes(text: np.ndarray, seeds: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Common prefix of each seed with the one before it, at most 255 and most of each pair, by bisection on hashes."""
    a, b = seeds[:-1], seeds[1:]
    low, high = np.zeros(len(a), np.int64), np.minimum(np.minimum(most, 255), len(text) - np.maximum(a, b))
    base, inverse = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 2**64)
    up, down = np.full(len(text), base, np.uint64), np.full(len(text) + 1, inverse, np.uint64)
    up[:1] = down[0] = 1
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(0x1B873593)) * np.multiply.accumulate(up), out=sums[1:])
    down = np.multiply.accumulate(down)
    while len(open_ := np.flatnonzero(low < high)):
        x, y = a[open_], b[open_]
        mid = (low[open_] + high[open_] + 1) // 2
        same = (sums[x + mid] - sums[x]) * down[x] == (sums[y + mid] - sums[y]) * down[y]
        low[open_] = np.where(same, mid, low[open_])
        high[open_] = np.where(same, high[open_], mid - 1)
    return np.concatenate([[0], low]).astype(np.uint8)


def sorted_suffixes(text: np.ndarray, sigma: int, depth: int, held: int = HELD) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes of text in descending order and each one's common prefix with the one before (at most 255).

    text: symbols below sigma, the last one 0 and nowhere else.
    """
    blocks = list(sorted_blocks(text, sigma, depth, held))
    return tuple(np.concatenate(x) for x in zip(*blocks, strict=True))


def sorted_blocks(text: np.ndarray, sigma: int, depth: int, held: int = HELD):
    """As sorted_suffixes, block by block."""
    text = text.astype(np.int32)
    small = _types(text)
    seeds, lcp = seeds_in_order(text, small, sigma, depth, held)
    yield from induce(text, small, seeds, lcp, sigma, min(255, max(depth, 1)), held)
