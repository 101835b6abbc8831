"""Operators 11 to 13 against the library, exhaustive search and scoring by hand."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from annalist.llm import conversation_repair, lexical_search, piece_codec
from annalist.llm.queries import damaged

HARD = [None, "", " \n\t ", "one", "one", "éß \U0001f600 \x00 x", "A" * 5000, "word " * 200_000, "line\n\nline\n" * 50, " " * 3000, "=" * 900, "▁x ▁"]

# 11


@pytest.fixture(scope="module")
def model():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def random_texts(rng, n):
    alphabets = ["ab", "abcdefghij ", "aeiou \n\t.,!", "  ▁", "é\U0001f600\U00010437ñ世界д ", "=-#$()\"' ", "0123456789abcdefABCDEF", "\x00\x01\x7f\x80​� a"]
    return ["".join(rng.choices("".join(rng.sample(alphabets, rng.choice([1, 3]))), k=rng.choice([1, 3, 10, 40, 300]))) for _ in range(n)]


def test_pieces_are_those_of_the_library(model, monkeypatch):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = piece_codec.Pieces(model)
    texts = HARD + random_texts(random.Random(1), 1500)
    for portion, known, long in ((1 << 19, 1 << 18, 512), (200, 50, 20), (64, 1 << 18, 10**9)):
        for name, value in (("PORTION", portion), ("KNOWN", known), ("LONG", long)):
            monkeypatch.setattr(piece_codec, name, value)
        own = texts if portion > 64 else [t for t in texts if len(t or "") < 1000]
        ids, count = piece_codec.Encoder(pieces).encode(own)
        at = 0
        for t, n in zip(own, count.tolist(), strict=True):
            assert ids[at : at + n].tolist() == library.encode(t or ""), repr(t)[:60]
            at += n


def test_any_ids_decode_as_in_the_library(model):
    sentencepiece = pytest.importorskip("sentencepiece")
    library, pieces, rng = sentencepiece.SentencePieceProcessor(model_proto=model), piece_codec.Pieces(model), random.Random(2)
    for _ in range(3000):
        ids = [rng.choice([0, 1, 2, 3, 100, 195, 200, 230, 243, 28705, 259, 264, rng.randrange(32000), rng.randrange(3, 259)]) for _ in range(rng.choice([0, 1, 2, 5, 20]))]
        assert piece_codec.decode_ids(pieces, np.array(ids, np.int32)).decode() == library.decode(ids), ids
    with pytest.raises(ValueError, match="vocabulary"):
        piece_codec.decode_ids(pieces, np.array([32000], np.int32))


def test_a_model_of_another_kind_is_refused(model):
    with pytest.raises(ValueError, match="normaliser"):
        piece_codec.Pieces(model.replace(b"identity", b"nmt_nfkc"))


def test_encoding_keeps_rows_and_columns(spark, model):
    rows = [(i, t, "own", [7], "own") for i, t in enumerate(HARD)] + [(None, "one", None, None, None), (3, "one", "own", [7], "own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, ids array<int>, decoded string")
    out = piece_codec.decoded(piece_codec.encoded(docs, model), model)
    assert sorted(out.columns) == sorted(docs.columns)
    got = out.collect()
    assert len(got) == len(rows)
    pieces = piece_codec.Pieces(model)
    want = {t: piece_codec.Encoder(pieces).encode([t])[0].tolist() for t in HARD}
    assert all(r.ids == want[r.text] and r.decoded == (r.text or "").replace("▁", " ") for r in got) and {r.row for r in got} == {"own", None}
    assert piece_codec.encoded(docs.limit(0), model).count() == 0


# 12


def cheapest(turns):
    """(cost, audit, lines) of the cheapest edits of (role, text, fault) rows, by trying all of them."""
    best = None
    n = len(turns)
    for edits in itertools.product("KRD", repeat=n):
        for gaps in itertools.product(range(3), repeat=n + 1):
            cost, audit, lines = 0, "", []
            roles: list[str] = []

            def insert(k):
                for _ in range(k):
                    role = "assistant" if roles and roles[-1][:1] == "u" else "user"
                    roles.append(role)
                    lines.append(f"{role}:")

            for (role, text, fault), edit, gap in zip(turns, edits, gaps, strict=False):
                insert(gap)
                cost += 2 * gap
                audit += "I" * gap + edit
                if edit == "D":
                    cost += 3
                    continue
                if fault in ("blank", "duplicate"):
                    cost += 1000
                cost += (2 if edit == "R" else 0) + (fault == "truncated")
                own = role if edit == "K" else "assistant" if roles and roles[-1][:1] == "u" else "user"
                roles.append(own)
                lines.append(f"{own}:{text}")
            insert(gaps[n])
            cost, audit = cost + 2 * gaps[n], audit + "I" * gaps[n]
            if cost < 1000 and re.fullmatch(r"(s?(ua)+)?", "".join(r[:1] or "?" for r in roles)) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, lines
    return best


def by_hand(rows):
    """What a conversation's damaged rows (turn, role, text) give."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, turns = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        turns.append((role, text, "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""))
        seen.add((role, text))
    numbers = [t for t, _, _ in rows if t is not None]
    faults = Counter(f for _, _, f in turns)
    cost, audit, lines = cheapest(turns)
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


SHAPE = "conv_id long, turn long, role string, text string, cost string, c long, seg long"


def repaired(turns):
    repair = conversation_repair.Repair(turns)
    hashes = conversation_repair.joined_hash(repair.turns().select("c", "e", F.concat_ws(":", "role", "text").alias("line")))
    out = repair.conversations().join(hashes, "c", "left").collect()
    empty = hashlib.sha256(b"").hexdigest()
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.sha256 or empty) for r in out}
    assert len(got) == len(out)
    return got


@pytest.mark.parametrize("width", [256, 2])
def test_repairs_are_the_cheapest_of_all(spark, monkeypatch, width):
    monkeypatch.setattr(conversation_repair, "WIDTH", width)
    rng = random.Random(3)
    roles, texts = ["user", "assistant", "system", "tool", "", "User"], ["A.", "B!", "no end", "", " \n", "x?\t ", "é。"]
    rows = {}
    for c in [None, *range(24)]:
        k = c or 0
        rows[c] = [(rng.choice([None, *range(6)]) if k % 5 == 0 else t, rng.choice(roles[: 3 if k % 2 else 6]), rng.choice(texts)) for t in range(rng.randrange(1, 6))]
    df = spark.createDataFrame([(c, t, r, x, "own", 1, 1) for c, own in rows.items() for t, r, x in own], SHAPE).repartition(5)
    assert repaired(df) == {c: by_hand(own) for c, own in rows.items()}


def test_one_conversation_with_all_turns_is_shared_out(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "WIDTH", 8)
    monkeypatch.setattr(conversation_repair, "BATCH_ROWS", 64)
    n = 1100  # more than WIDTH cubed: runs of runs of runs
    own = [(1, i, ("user", "assistant")[i % 2] if i % 7 else "system", f"{i}.", None, 0, 0) for i in range(n)] + [(1, None, "user", "same.", None, 0, 0)] * 300
    got = repaired(spark.createDataFrame(own, SHAPE))[1]
    whole = repaired(spark.createDataFrame(own, SHAPE)) if monkeypatch.undo() is None else None
    assert got == whole[1] and got[2] == 299 and sum(x in "KRD" for x in got[6]) == n + 300
    hard = [(2, i, None if i % 2 else "user", t, None, 0, 0) for i, t in enumerate(HARD)]
    assert repaired(spark.createDataFrame(hard, SHAPE))[2][1] == 4  # null counts as one space
    assert repaired(spark.createDataFrame([], SHAPE)) == {}


def test_damage_is_told_by_a_checksum(spark):
    import zlib

    rows = [(c, t, "assistant", "A. B!") for c in (None, 1, 2) for t in (None, *range(60))]
    got = Counter((r.conv_id, r.turn, r.role, r.text) for r in damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect())
    want: Counter = Counter()
    for c, t, role, text in rows:
        f = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if f:
            want[c, t, "user" if f == 4 else role, {1: "", 2: "A B"}.get(f, text)] += 2 if f == 3 else 1
    assert got == want and set(want.values()) == {1, 2}


# 13


def scored(docs, items, k):
    """(item_id, rank, doc_id, score) rows by scoring every document."""
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    counts = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n_docs, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for (i, c), n in zip(counts, sizes, strict=True):
            if not n:
                continue
            m = 100 - 90 + 90 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seeds,rows", [(1000, 1 << 18), (2, 0), (1, 1 << 18)])
def test_the_best_are_those_of_scoring_everything(spark, monkeypatch, seeds, rows):
    monkeypatch.setattr(lexical_search, "SEED_MATCHES", seeds)
    monkeypatch.setattr(lexical_search, "BROADCAST_ROWS", rows)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["Café", "世界", "x1y2", "\U0001f600"]
    text = lambda n: rng.choice([" ", ", ", "-", "\n"]).join(words[min(int(rng.expovariate(0.08)), len(words) - 1)] for _ in range(n))
    docs = [(i, text(rng.randrange(1, 40))) for i in range(120)] + [(None, "w1 w1 rare"), (None, "w1 w1 rare"), (7, "w1 w1 rare"), (900, None), (901, ""), (902, "!?"), (903, "W1 " * 300_000)]
    docs += [(1000 + i, "the same words w3 w4 rare2") for i in range(40)]  # ties
    items = [(i, text(12)) for i in range(8)] + [(50, "rare, RARE; w1"), (50, "rare2 the"), (None, "same"), (60, None), (61, "nowhere"), (62, "...")]
    d = spark.createDataFrame([(i, t, "own", 1, 1) for i, t in docs], "doc_id long, text string, term string, row long, n long").repartition(7)
    q = spark.createDataFrame([(i, t, "own") for i, t in items], "item_id long, text string, term string")
    for k in (10, 3):
        assert sorted(map(tuple, lexical_search.search(d, q, k).collect()), key=repr) == scored(docs, items, k)


def test_search_of_nothing(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.search(d.limit(0), q).count() == lexical_search.search(d, q.limit(0)).count() == 0
    assert lexical_search.terms_of("A-b Éx_9".encode()) == [b"a", b"b", "Éx".encode(), b"9"]
