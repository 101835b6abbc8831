"""Vectorised numpy kernels over the UTF-8 bytes of Arrow batches.

Word boundaries are the ASCII whitespace bytes 0x20 and 0x09-0x0D. No byte of
a multi-byte UTF-8 sequence is below 0x80, so working on bytes gives the same
words as working on code points. Everything is done in slices of bounded size,
cut at whitespace, so memory does not grow with the length of a text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
SLICE = 1 << 20
#: Longest word that is hashed together with the others, in bytes; longer ones are hashed one by one.
SHORT_WORD = 64
#: Bytes of text whose words are held at once; a longer text is held alone.
PORTION = 4 << 20

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
SPACES = bytes(np.flatnonzero(IS_SPACE).astype(np.uint8))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
LOWER_BYTES = LOWER.tobytes()
#: Which bytes of an eight-byte load belong to a word that ends after 0 to 8 of them.
TAILS = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a (large) binary or string column and its n + 1 offsets; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    if column.null_count:
        valid = np.asarray(column.is_valid())
        if np.any(np.diff(offs)[~valid]):
            return buffers(column.fill_null(b""))
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def word_hashes(lower: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each word: eight bytes at a time go through a mixing permutation, long words through xxh3."""
    size = end - start
    padded = np.frombuffer(lower + bytes(8), np.uint8)
    eights = np.ndarray((len(lower) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each position on
    acc = mix((size.astype(U64) + U64(1)) * U64(0x9E3779B97F4A7C15))
    active = np.flatnonzero(size <= SHORT_WORD)
    for at in range(0, SHORT_WORD, 8):
        active = active[size[active] > at]
        if not len(active):
            break
        own = eights[start[active] + at] & TAILS[np.minimum(size[active] - at, 8)]
        acc[active] = mix(acc[active] * U64(0x2545F4914F6CDD1D) ^ own)
    for i in np.flatnonzero(size > SHORT_WORD).tolist():
        acc[i] = xxhash.xxh3_64_intdigest(memoryview(lower)[start[i] : end[i]])
    return acc


def _slices(raw: np.ndarray, offs: np.ndarray):
    """Cut points at whitespace or text ends, about SLICE bytes apart."""
    at, size = 0, len(raw)
    while at < size:
        end = min(at + SLICE, size)
        if end < size:
            cut = offs[np.searchsorted(offs, end, "right") - 1]
            if cut <= at:
                gaps = np.flatnonzero(IS_SPACE[raw[at:end]])
                while not len(gaps) and end < size:
                    more = min(end + SLICE, size)
                    gaps = np.flatnonzero(IS_SPACE[raw[end:more]])[:1] + (end - at)
                    end = more
                cut = at + gaps[-1] + 1 if len(gaps) else size
                cut = min(cut, offs[np.searchsorted(offs, at, "right")])
            end = int(cut)
        yield at, end
        at = end


def words(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end, text index) of every word; A-Z count as lower case in the hash."""
    parts = []
    for a, b in _slices(raw, offs):
        piece = raw[a:b]
        inside = ~IS_SPACE[piece]
        before, after = np.empty_like(inside), np.empty_like(inside)
        before[0] = after[-1] = False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = offs[(offs > a) & (offs < b)] - a
        before[edges] = False
        after[edges - 1] = False
        start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        parts.append((word_hashes(piece.tobytes().translate(LOWER_BYTES), start, end), start + a, end + a))
    if not parts:
        none = np.zeros(0, np.int64)
        return np.zeros(0, U64), none, none, none
    h, start, end = (np.concatenate(x) for x in zip(*parts, strict=True))
    return h, start, end, np.searchsorted(offs, start, "right") - 1


def word_numbers(lower: bytes, h: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, int]:
    """A number for each word (equal words have equal ones) and how many there are; the words of equal hashes are compared."""
    order = np.argsort(h)
    again = h[order[1:]] == h[order[:-1]]
    a, b = order[:-1][again], order[1:][again]
    size = (end - start)[a]
    same = size == (end - start)[b]
    eights = np.ndarray((len(lower) + 1,), "<u8", np.frombuffer(lower + bytes(8), np.uint8), strides=(1,))
    active, at = np.flatnonzero(same & (size <= SHORT_WORD)), 0
    while len(active):
        tail = TAILS[np.minimum(size[active] - at, 8)]
        same[active] &= (eights[start[a[active]] + at] & tail) == (eights[start[b[active]] + at] & tail)
        at += 8
        active = active[size[active] > at]
    for i in np.flatnonzero(same & (size > SHORT_WORD)).tolist():
        same[i] = lower[start[a[i]] : end[a[i]]] == lower[start[b[i]] : end[b[i]]]
    if not same.all():  # two words of one hash: numbered by a table
        known: dict[bytes, int] = {}
        return np.array([known.setdefault(lower[s:e], len(known)) for s, e in zip(start.tolist(), end.tolist(), strict=True)], np.int64), len(known)
    numbers = np.zeros(len(h), np.int64)
    numbers[order[1:]] = np.cumsum(~again)
    return numbers, int(numbers.max(initial=-1)) + 1


def chain(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive word hashes (length len(h) - n + 1)."""
    size = max(0, len(h) - n + 1)
    acc = np.full(size, n, U64)
    for j in range(n):
        acc = mix(acc * U64(0x2545F4914F6CDD1D) + h[j : j + size])
    return acc


def text_bounds(text: np.ndarray, count: int) -> np.ndarray:
    """Offsets into word arrays of each text, from the words' ascending text index."""
    return np.searchsorted(text, np.arange(count + 1))


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, ascending (by sorting, for short arrays many times faster than a table)."""
    own = np.sort(values)
    return own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own


def shingle_sets(column: pa.Array, n: int):
    """For each text its distinct n-word shingle hashes, ascending.

    A text of fewer than n words is one shingle of all its words; one without
    words has none.
    """
    for part in portions(column):
        raw, offs = buffers(part)
        h, _, _, text = words(raw, offs)
        runs = chain(h, n)
        bounds = text_bounds(text, len(offs) - 1)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a >= n:
                yield distinct(runs[a : b - n + 1])
            elif b > a:
                yield chain(h[a:b], int(b - a))
            else:
                yield h[:0]


def portions(column: pa.Array):
    """Consecutive slices of a column, of PORTION bytes or one value each."""
    _, offs = buffers(column)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + PORTION, "right")) - 1)
        yield column.slice(a, b - a)
        a = b
