"""SentencePiece encoding and decoding by vectorised merge rounds.

A text is cut wherever two neighbouring characters stand together in no piece of
the vocabulary: no merge can span such a place, so the parts ("words") are
encoded each by itself and equal words once. The symbols of all words lie in one
flat numpy array. Every round takes the least pair rank of each word (a segmented
minimum), merges its leftmost occurrences that do not overlap, in all words at
once, and closes the gaps; words without a pair leave the array. Rounds go on
until no pair remains.

Two occurrences of a pair are merged in one round only where one after the other
gives the same: where no piece that begins or ends with the merged one ranks as
high or higher. Of other pairs only the leftmost is merged in a round. A word of
more than LONG symbols (a run of many thousand spaces, say), for which rounds over
the whole word would be quadratic, takes the same merges from a heap.
"""

from __future__ import annotations

import heapq
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import spread

SPACE = "▁"
#: Characters that are cut into words at once; a longer text is cut where no merge can span.
PORTION = 1 << 19
#: Words kept encoded by a worker; when full, it begins anew.
KNOWN = 1 << 18
LONG = 512
#: Rank of what is no pair.
NONE = np.int32(np.iinfo(np.int32).max)
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2


def _fields(data: bytes):
    """(number, value) of each field of a protocol-buffer message; fixed-width values as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, data[at : at + size]
        at += size


class Pieces:
    """Vocabulary of a byte-pair model: tables for merging and for output.

    Symbols are numbered as the pieces are; characters that only occur inside
    pieces, and one stand-in for all other characters, come after them.
    """

    def __init__(self, model: bytes):
        names, scores, kinds = [], [], []
        normal = {1: b"", 3: 1, 4: 1, 5: 1}
        trainer = {3: 1, 24: 0, 35: 0, 44: " ⁇ ".encode()}
        for number, value in _fields(model):
            if number == 1:
                own = dict(_fields(value))
                names.append(own[1].decode())
                scores.append(float(np.frombuffer(own.get(2, bytes(4)), "<f4")[0]))
                kinds.append(own.get(3, NORMAL))
            elif number == 2:
                trainer |= dict(_fields(value))
            elif number == 3:
                normal |= dict(_fields(value))
        if trainer[3] != BPE or not trainer[35] or trainer[24]:
            raise ValueError("a byte-pair model with byte fallback and spaces before words is needed")
        if normal[1] != b"identity" or not normal[3] or normal[4] or not normal[5]:
            raise ValueError("an identity normaliser with a space put before texts is needed")
        if {USER_DEFINED, UNUSED} & set(kinds):
            raise ValueError("user-defined or unused pieces are not supported")
        self.names, self.kinds = names, np.array(kinds)
        self.own = {p: i for i, p in enumerate(names) if kinds[i] == NORMAL}
        self.byte = np.zeros(256, np.int32)
        for i, p in enumerate(names):
            if kinds[i] == BYTE:
                self.byte[int(p[1:-1], 16)] = i
        #: 0 is the best rank; equal scores have equal ranks.
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in self.own.values()}, reverse=True))}
        self.rank = np.full(len(names), NONE, np.int32)
        for i in self.own.values():
            self.rank[i] = order[scores[i]]
        self.unknown_surface = trainer[44].decode()
        self._merges()

    def _merges(self) -> None:
        symbols = dict(self.own)
        for c in sorted({c for p in self.own for c in p}):
            symbols.setdefault(c, len(self.names) + len(symbols) - len(self.own))
        self.stand_in = len(self.names) + len(symbols) - len(self.own)
        pairs, glue, alone = {}, set(), np.zeros(int(self.rank[self.rank < NONE].max(initial=0)) + 1, bool)
        for p, i in self.own.items():
            glue.update(zip(p, p[1:], strict=False))
            for k in range(1, len(p)):
                a, b = symbols.get(p[:k]), symbols.get(p[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = i
                for q in (p[:k], p[k:]):
                    if len(q) > 1 and q in self.own and self.rank[i] <= self.rank[self.own[q]]:
                        alone[self.rank[self.own[q]]] = True
        by_rank: dict[int, int] = {}
        for i in self.own.values():
            if by_rank.setdefault(int(self.rank[i]), i) != i:
                alone[self.rank[i]] = True
        self.alone = alone
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.append(np.array([pairs[k] for k in self.keys.tolist()], np.int32), np.int32(-1))
        chars = sorted({c for p in self.own for c in p})
        self.n_classes = len(chars) + 1
        self.char_class = np.zeros(0x110000, np.uint16)
        self.char_symbol = np.full(0x110000, self.stand_in, np.int32)
        for n, c in enumerate(chars):
            self.char_class[ord(c)] = n + 1
            self.char_symbol[ord(c)] = symbols[c]
        self.char_class[0x20], self.char_symbol[0x20] = self.char_class[ord(SPACE)], self.char_symbol[ord(SPACE)]
        self.glue = np.zeros(self.n_classes * self.n_classes, bool)
        for a, b in glue:
            self.glue[int(self.char_class[ord(a)]) * self.n_classes + int(self.char_class[ord(b)])] = True

    @cached_property
    def surface(self) -> list[bytes]:
        """What a piece stands for in decoded text."""
        text = {CONTROL: lambda p: "", UNKNOWN: lambda p: self.unknown_surface, BYTE: lambda p: "", NORMAL: lambda p: p.replace(SPACE, " ")}
        return [text[k](p).encode() for p, k in zip(self.names, self.kinds.tolist(), strict=True)]

    @cached_property
    def plain(self) -> np.ndarray:
        """Pieces whose surface is their own text."""
        return self.kinds == NORMAL

    def cuts(self, codes: np.ndarray) -> np.ndarray:
        """True at each position that no merge joins with the one before it."""
        own = self.char_class[codes].astype(np.int32)
        out = np.ones(len(codes), bool)
        np.logical_not(self.glue[own[:-1] * self.n_classes + own[1:]], out=out[1:])
        return out

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of what each pair of symbols merges to; NONE where it does not."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        piece = np.where(np.append(self.keys, -1)[at] == key, self.merged[at], -1)
        return np.where(piece >= 0, self.rank[piece], NONE), piece

    def _rounds(self, sym: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merge the words whose symbols lie one after another in sym; (symbols, sizes, words in the order of both)."""
        word = np.arange(len(size))
        rank = np.full(len(sym), NONE)
        piece = np.full(len(sym), -1, np.int32)
        last = np.cumsum(size) - 1
        inner = np.ones(len(sym), bool)
        inner[last] = False
        at = np.flatnonzero(inner)
        rank[at], piece[at] = self._pair(sym[at], sym[at + 1])
        done_sym, done_size, done_word = [], [], []
        while len(size):
            first = np.cumsum(size) - size
            low = np.minimum.reduceat(rank, first)
            over = low == NONE
            if over.any():
                own = np.repeat(over, size)
                done_sym.append(sym[own])
                done_size.append(size[over])
                done_word.append(word[over])
                sym, rank, piece = sym[~own], rank[~own], piece[~own]
                size, word, low = size[~over], word[~over], low[~over]
                if not len(size):
                    break
                first = np.cumsum(size) - size
            at = np.flatnonzero(rank == np.repeat(low, size))
            # leftmost that do not overlap: every other one of neighbouring occurrences
            run = np.append(True, np.diff(at) != 1)
            place = np.arange(len(at))
            pick = (place - np.maximum.accumulate(np.where(run, place, 0))) % 2 == 0
            owner = np.searchsorted(first, at, "right") - 1
            pick &= ~(self.alone[low[owner]] & np.append(False, np.diff(owner) == 0))
            at, owner = at[pick], owner[pick]
            sym[at] = piece[at]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            size = size - np.bincount(owner, minlength=len(size))
            sym, rank, piece = sym[stay], rank[stay], piece[stay]
            first = np.cumsum(size) - size
            end = np.zeros(len(sym), bool)
            end[first + size - 1] = True
            new = at - np.arange(len(at))
            touched = np.zeros(len(sym), bool)
            touched[new] = True
            touched[new[new > 0] - 1] = True
            rank[touched & end] = NONE
            open_ = np.flatnonzero(touched & ~end)
            rank[open_], piece[open_] = self._pair(sym[open_], sym[open_ + 1])
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_sym, done_size, done_word))

    def _heap(self, sym: list[int]) -> list[int]:
        """The merges of one long word, least rank and leftmost first, from a heap."""
        after, before = [*range(1, len(sym)), -1], [*range(-1, len(sym) - 1)]
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (p := self.pairs.get(sym[i] << 32 | sym[j])) is not None:
                heapq.heappush(heap, (int(self.rank[p]), i, sym[i], sym[j], p))

        for i in range(len(sym) - 1):
            offer(i)
        while heap:
            _, i, a, b, p = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue
            sym[i], sym[j], after[i] = p, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [s for s in sym if s >= 0]

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, number of ids of each)."""
        size = np.array([len(w) for w in words], np.int64)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        sym = self.char_symbol[codes]
        begin = np.cumsum(size) - size
        long = size > LONG
        kept = np.repeat(~long, size)
        out, count, which = self._rounds(sym[kept], size[~long])
        which = np.flatnonzero(~long)[which]
        for w in np.flatnonzero(long).tolist():
            own = self._heap(sym[begin[w] : begin[w] + size[w]].tolist())
            out, count, which = np.append(out, own), np.append(count, len(own)), np.append(which, w)
        # back in the order of the words
        order = np.argsort(which, kind="stable")
        starts = np.cumsum(count) - count
        out = out[_ranges(starts[order], count[order])] if len(out) else out.astype(np.int64)
        count = count[order]
        return self._bytes(words, out, count, codes, begin)

    def _bytes(self, words: list[str], out: np.ndarray, count: np.ndarray, codes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace symbols that are no pieces by the pieces of their bytes."""
        odd = out >= len(self.names)
        if not odd.any():
            return out.astype(np.int32), count
        # such a symbol stands with no other in a pair, or for one character of its own: find it by counting characters
        lengths = np.ones(len(out), np.int64)
        lengths[~odd] = np.array([len(p) for p in self.names], np.int64)[out[~odd]]
        at = np.cumsum(lengths) - lengths
        raw = [list(chr(c).encode()) for c in codes[at[odd]].tolist()]
        size = np.ones(len(out), np.int64)
        size[odd] = [len(r) for r in raw]
        wide = np.repeat(out, size)
        wide[np.repeat(odd, size)] = self.byte[np.array([b for r in raw for b in r], np.int64)]
        owner = np.repeat(np.arange(len(words)), count)
        return wide.astype(np.int32), np.bincount(owner, weights=size, minlength=len(words)).astype(np.int64)


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for count places, one range after another."""
    total = int(count.sum())
    return np.arange(total) + np.repeat(start - (np.cumsum(count) - count), count)


class Encoder:
    """Encodes texts; keeps the ids of words met before, a bounded number of them."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.start, self.count = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, words: set[str]) -> None:
        new = sorted(words)
        ids, count = self.pieces.words(new)
        self.number.update(zip(new, range(len(self.start), len(self.start) + len(new)), strict=True))
        self.start = np.concatenate([self.start, np.cumsum(count) - count + len(self.flat)])
        self.count = np.concatenate([self.count, count])
        self.flat = np.concatenate([self.flat, ids])

    def _portion(self, text: str, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of text, and how many each part between the edges (begins of texts) has."""
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
        cut = self.pieces.cuts(codes)
        cut[edges] = True
        begin = np.flatnonzero(cut)
        at = begin.tolist()
        words = [text[a:b] for a, b in zip(at, [*at[1:], len(text)], strict=True)]
        if len(self.number) > KNOWN:
            self._forget()
        if new := set(words) - self.number.keys():
            self._learn(new)
        own = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        count = self.count[own]
        ids = self.flat[_ranges(self.start[own], count)]
        return ids, np.add.reduceat(count, np.searchsorted(begin, edges))

    def _long(self, text: str) -> np.ndarray:
        """Ids of one text of any length, cut where no merge can span."""
        out, at = [], 0
        while at < len(text):
            end = at + PORTION
            while end < len(text):
                gaps = np.flatnonzero(self.pieces.cuts(np.frombuffer(text[end - 1 : end + PORTION].encode("utf-32-le"), "<u4"))[1:])
                if len(gaps):
                    end += int(gaps[0])
                    break
                end += PORTION
            out.append(self._portion(text[at:end], np.zeros(1, np.int64))[0])
            at = end
        return np.concatenate(out)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each); an empty or null text has none."""
        count = np.zeros(len(texts), np.int64)
        out: list[np.ndarray] = []
        held: list[int] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if held:
                parts = [" " + texts[i] for i in held]
                ends = np.cumsum([len(p) for p in parts])
                ids, n = self._portion("".join(parts), np.append(0, ends[:-1]))
                count[held] = n
                out.append(ids)
            held.clear()
            size = 0

        for i, t in enumerate(texts):
            if not t:
                continue
            if size + len(t) > PORTION:
                flush()
            if len(t) >= PORTION:
                ids = self._long(" " + t)
                count[i] = len(ids)
                out.append(ids)
            else:
                held.append(i)
                size += len(t) + 1
        flush()
        return np.concatenate(out) if out else np.zeros(0, np.int32), count


def _byte_text(raw: bytes) -> bytes:
    """raw as UTF-8; each byte that begins no valid character as U+FFFD."""
    try:
        return raw.decode().encode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + n].decode().encode())
            except UnicodeDecodeError:
                continue
            at += n
            break
        else:
            out.append("�".encode())
            at += 1
    return b"".join(out)


def decode_ids(pieces: Pieces, ids: np.ndarray) -> bytes:
    """The text of ids: the space put before a text goes, runs of byte pieces become characters, control pieces vanish."""
    if len(ids) and (ids.min() < 0 or ids.max() >= len(pieces.names)):
        raise ValueError("an id is outside the vocabulary")
    out: list[bytes] = []
    at, size, seen = 0, 0, False
    plain = pieces.plain[ids]
    odd = np.append(np.flatnonzero(~plain), len(ids)).tolist()
    own = ids.tolist()
    for stop in odd:
        if stop > at:
            text = b"".join(map(pieces.surface.__getitem__, own[at:stop]))
            if not seen and not size and text.startswith(b" "):
                text, seen = text[1:], True
            out.append(text)
            size += len(text)
        if stop < at or stop == len(own):
            continue
        if pieces.kinds[own[stop]] == BYTE:
            end = stop
            while end < len(own) and pieces.kinds[own[end]] == BYTE:
                end += 1
            text = _byte_text(bytes(int(pieces.names[i][1:-1], 16) for i in own[stop:end]))
            at = end
        else:
            text, at = pieces.surface[own[stop]], stop + 1
        out.append(text)
        size += len(text)
    return b"".join(out)


def _held(model: bytes, make):
    """A function that gives make(Pieces) of the model, built once in each Python worker."""
    state: list = []

    def get():
        if not state:
            state.append(make(Pieces(model)))
        return state[0]

    return get


def encoded(docs: DataFrame, model: bytes, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """docs with ids_col: the piece ids of each text, without begin or end ids (replaces a column of that name).

    model is the content of a byte-pair model file; it travels with the task, so
    executors need no copy of the file. A null or empty text has no ids. Texts are
    taken whole; a very long one is cut where no merge can span, so memory does
    not grow beyond the text and its ids. Rows are independent: repeated rows,
    and rows with null in any other column, are encoded each, alike. An empty
    table gives an empty table.
    """
    get = _held(model, Encoder)

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        ids, count = get().encode(texts.to_pylist())
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)), pa.int32()), pa.array(ids, pa.int32()))

    rest = [c for c in docs.columns if c != ids_col]
    out = spread(docs.select(F.struct(*rest).alias("row"))).select("row", encode(F.col("row").getField(text_col)).alias("ids"))
    return out.select("row.*", F.col("ids").alias(ids_col))


def decoded(docs: DataFrame, model: bytes, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """docs with text_col: the text of each row's ids (replaces a column of that name).

    Null or empty ids give an empty text; an id outside the vocabulary is an
    error. Control ids vanish, the unknown id becomes the model's mark for it, and
    bytes that are no UTF-8 become U+FFFD. Rows are independent, as in `encoded`.
    """
    get = _held(model, lambda pieces: pieces)

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        if isinstance(ids, pa.ChunkedArray):
            ids = ids.combine_chunks()
        return pa.array([decode_ids(get(), x.values.to_numpy() if x.is_valid else np.zeros(0, np.int32)) for x in ids], pa.binary()).cast(pa.string())

    rest = [c for c in docs.columns if c != text_col]
    out = docs.select(F.struct(*rest).alias("row"), decode(F.col(ids_col)).alias("new"))
    return out.select("row.*", F.col("new").alias(text_col))
