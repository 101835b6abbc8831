"""The ten training-data operators on small tables, against brute force where it is short."""

from __future__ import annotations

import hashlib
import itertools
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from annalist.llm import decontaminate, fingerprints, induced_sort, kernels, language_id, line_dedup, mixing, ngram_join, quality, suffix_dedup, token_output, url_filter
from annalist.llm.components import components

SHAPE = "doc_id long, text string, lang string, source string, n_chars long, score string, n long, marks string, k string, copies long"
UP = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, texts, ids=None, sources=None, langs=None):
    """Documents with columns whose names the operators use themselves."""
    rows = [(i, t, lg, s, None, "own", 1, "own", "own", 7) for i, t, s, lg in zip(ids or range(len(texts)), texts, sources or ["s"] * len(texts), langs or ["en"] * len(texts), strict=True)]
    return spark.createDataFrame(rows, SHAPE)


def prose(rng, words, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


HARD = [None, "", " \n\t ", "one", "one", "\u00e9\u00df \U0001f600 \x00 x", "A" * 5000, "word " * 3000, "line\n\nline\n" * 50]


def test_words_do_not_depend_on_slices(monkeypatch):
    rng = random.Random(1)
    texts = [t or "" for t in HARD] + [prose(rng, n) for n in (1, 5, 400)]
    import pyarrow as pa

    column = pa.array([t.encode() for t in texts], pa.binary())
    whole = kernels.words(*kernels.buffers(column))
    want = [w.translate(UP) for t in texts for w in WORD.findall(t)]
    assert len(whole[0]) == len(want)
    assert len(set(zip(whole[0].tolist(), want, strict=True))) == len(set(want)) == len(set(whole[0].tolist()))
    monkeypatch.setattr(kernels, "SLICE", 64)
    for a, b in zip(whole, kernels.words(*kernels.buffers(column)), strict=True):
        assert np.array_equal(a, b)


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (3, 2), (9, 3), (5, 6), (7, 7), (6, 5), (None, 4)] + [(i, i + 1) for i in range(100, 140)], "u long, v long")
    for chunk in (10**6, 7):
        rows = components(edges, chunk=chunk).collect()
        got = {r.id: r.component for r in rows}
        assert len(got) == len(rows) and {i: got[i] for i in (1, 2, 3, 9, 5, 6)} == {1: 1, 2: 1, 3: 1, 9: 1, 5: 5, 6: 5}
        assert all(got[i] == 100 for i in range(100, 141)) and 7 not in got
    assert components(edges.limit(0)).count() == 0


# 1


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation_is_one_to_one_and_keyed(size):
    a, b = (token_output.permute(np.arange(size), size, k) for k in ("x", "y"))
    assert sorted(a.tolist()) == list(range(size)) == sorted(b.tolist())
    assert size < 64 or (a != b).any()


def stream_by_force(rows, length):
    """The sequences of the stream of (id, text) rows in one bucket: by id (null last), then by the text's hash."""
    ids = []
    for _, _, t in sorted((token_output.NULL_ID if i is None else i, xxhash.xxh3_64_intdigest(t or "") - (1 << 63), t or "") for i, t in rows):
        ids += [*token_output.encoder(token_output.VOCABULARY).encode_ordinary(t), token_output.END]
    ids += [token_output.END] * (-len(ids) % length)
    return np.array(ids, np.uint16).reshape(-1, length)


def test_token_round_trip(spark, tmp_path):
    rng = random.Random(2)
    texts = [*HARD, *[prose(rng, rng.randrange(400)) for _ in range(60)], "same text", "same text"]
    ids = [*range(len(texts) - 4), None, None, 7, 7]
    docs = table(spark, texts, ids=ids).repartition(3)
    rows = sorted(token_output.training_order(docs, length=128, shard_rows=16).collect())
    want = stream_by_force(zip(ids, texts, strict=True), 128)
    slots = token_output.permute(np.arange(len(want)), len(want), "order")
    assert [r.slot for r in rows] == list(range(len(want)))
    for q, slot in enumerate(slots.tolist()):
        assert np.array_equal(np.frombuffer(rows[slot].tokens, "<u2"), want[q])
    assert all(r.shard == r.slot // 16 and r.byte_offset == r.slot % 16 * 256 for r in rows)
    assert sum(r.n_tokens for r in rows) == sum(len(list(token_output.encoder(token_output.VOCABULARY).encode_ordinary(t or ""))) + 1 for t in texts)
    assert {r.n_tokens for r in rows if r.slot != slots[-1]} == {128} and all(r.docs > 0 for r in rows)
    assert rows[slots[0]].first_doc == 0 and rows[slots[-1]].first_doc is None
    # bytes do not depend on how the input is split, and can be read from any slot on
    path, other = (f"file://{tmp_path}/{x}" for x in "ab")
    a, b = (token_output.write_shards(d, p, length=128, shard_rows=16).orderBy("shard").collect() for d, p in ((docs, path), (docs.repartition(7, "text"), other)))
    assert a == b and sum(r.rows for r in a) == len(want) and sum(r.bytes for r in a) == 256 * len(want)
    read = token_output.read_slots(path, 5, 40, 128, 16)
    assert np.array_equal(read, np.stack([np.frombuffer(r.tokens, "<u2") for r in rows[5:45]]))
    assert hashlib.sha256(token_output.read_slots(path, 16, 16, 128, 16).tobytes()).hexdigest() == a[1].sha256
    assert token_output.training_order(docs.limit(0)).count() == 0


def test_stream_in_buckets_keeps_every_text(spark, monkeypatch):
    monkeypatch.setattr(token_output, "BUCKET", 500)
    rng = random.Random(21)
    texts = [prose(rng, rng.randrange(60)) for _ in range(80)]
    rows = sorted(token_output.training_order(table(spark, texts), length=64, shard_rows=8).collect())
    order = token_output.permute(np.arange(len(rows)), len(rows), "order")
    ids = np.concatenate([np.frombuffer(rows[s].tokens, "<u2")[: rows[s].n_tokens] for s in order.tolist()])
    ends = np.flatnonzero(ids == token_output.END)
    coder = token_output.encoder(token_output.VOCABULARY)
    assert Counter(coder.decode(x[x != token_output.END].tolist()) for x in np.split(ids, ends + 1)[:-1]) == Counter(texts)


def test_long_texts_are_encoded_whole(monkeypatch):
    text = "alpha beta\n" * 300 + "x" * 500
    coder = token_output.encoder(token_output.VOCABULARY)
    for piece in (1 << 16, 100):
        monkeypatch.setattr(token_output, "PIECE", piece)
        parts = list(token_output.encoded(text))
        ids = np.concatenate(parts)
        assert (len(parts) > 1) == (piece == 100) and ids[-1] == token_output.END and coder.decode(ids[:-1].tolist()) == text


# 2


def test_mix_meets_targets(spark):
    rng = random.Random(3)
    n = 3000
    texts = [None if i % 500 == 0 else prose(rng, rng.choice([0, 1, 5, 20, 60])) for i in range(n)]
    sources = [rng.choice(["a", "a", "a", "b", "c", "d", None]) for _ in range(n)]
    docs = table(spark, texts, sources=sources)
    rows = mixing.mix(docs).collect()
    size = Counter()
    for t, s in zip(texts, sources, strict=True):
        size[s] += len(WORD.findall(t or ""))
    weight = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2], strict=True))
    left, want, open_ = 1.5 * sum(size.values()), {}, set(size)
    while open_:  # the plain procedure: shares by weight, the excess of the full ones dealt again
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * size[s]}
        if not full:
            want |= share
            break
        for s in full:
            want[s] = 2.0 * size[s]
            left -= want[s]
        open_ -= full
    taken = Counter()
    for r in rows:
        assert r.taken <= 2 * r.size and r.taken == r.copies * r.size and r.source_size == size[r.source]
        assert r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 30 for s in size)
    assert sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()), key=repr) == sorted(map(tuple, rows), key=repr)
    many = mixing.mixed(docs)
    assert many.columns == docs.columns and many.count() == sum(r.copies for r in rows)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mix(table(spark, [None, ""])).agg(F.sum("taken")).first()[0] == 0


def test_pareto_draws_are_even(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"))
    rows = mixing.mix(docs, total=0.75, weights=(1.0, 2.0)).collect()
    share = {s: np.mean([r.copies for r in rows if r.source == s]) for s in "ab"}
    assert share["a"] == pytest.approx(0.5, abs=0.001) and share["b"] == pytest.approx(1.0, abs=0.001)
    picked = [r.doc_id for r in rows if r.source == "a" and r.copies]
    assert abs(np.mean(picked) - 1000) < 60


# 3


@pytest.mark.parametrize("recursive", [False, True])
def test_induced_order_against_plain_sorting(monkeypatch, recursive):
    if recursive:
        for name, value in (("DENSE", 1), ("LANES", 10**6), ("BASE", 1)):
            monkeypatch.setattr(induced_sort, name, value)
    rng = random.Random(4)
    for _ in range(120):
        kinds, depth = rng.choice([1, 2, 3, 5]), rng.choice([5, 20, 255])
        t = [rng.randint(1, kinds) for _ in range(rng.randint(1, 150))]
        t += t[3:19] * rng.randint(0, 3) + [0]
        order, common = induced_sort.sorted_suffixes(np.array(t), kinds + 1, depth, rng.choice([10, 10**6]))
        assert sorted(order.tolist()) == list(range(len(t)))
        assert [t[p : p + depth] for p in order.tolist()] == [t[p : p + depth] for p in sorted(range(len(t)), key=lambda p: t[p:], reverse=True)]
        for (a, b), c in zip(zip(order[:-1].tolist(), order[1:].tolist(), strict=True), common[1:].tolist(), strict=True):
            n = 0
            while n < min(len(t) - a, len(t) - b, depth, 255) and t[a + n] == t[b + n]:
                n += 1
            assert min(c, depth) == n


def removed_by_force(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append((len(r), sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(c for c, g in zip(r, gone, strict=True) if not g)))
    return out


def test_repeats_are_removed_as_by_force(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 300)
    rng = random.Random(5)
    shared = [prose(rng, 60) for _ in range(4)]
    texts = [*HARD, "ab" * 400, "x" * 199, "x" * 200]
    texts += [prose(rng, rng.randrange(80)) + rng.choice(shared)[rng.randrange(60) :] + prose(rng, rng.randrange(80)) for _ in range(40)]
    texts += [texts[20], texts[20]]
    docs = table(spark, texts)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs, held=1000, shard_bytes=5000).collect()}
    assert [got[i] for i in range(len(texts))] == removed_by_force(texts, 200)
    same = table(spark, [prose(rng, 100)] * 2, ids=[1, 1])
    assert {r.n_removed == r.n_bytes for r in suffix_dedup.remove_repeats(same).collect()} == {True}
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_a_hot_anchor_is_split_without_loss(spark, monkeypatch):
    rng = random.Random(8)
    line = prose(rng, 80)[:230]
    # lines of 60 to 230 bytes that all documents share, with surroundings of their own; some share more than 200 bytes
    texts = [prose(rng, 60, 5000) + line[: rng.choice([60, 130, 190, 199, 200, 201, 230])] + prose(rng, 60, 5000) for _ in range(120)]
    sizes, own = Counter(), suffix_dedup._repeats

    # Python workers get their own copy of the module, so shards are sorted here
    def here(contents, length, held):
        by = {}
        for x in contents.collect():
            by.setdefault(x.shard, []).append((x.a, bytes(x.r), bytes(x.body)))
            sizes[x.a] += len(x.body)
        out = [(x["a"], x["r"], x["spans"]) for shard in by.values() for x in own(sorted(shard), length, held).to_pylist()]
        return spark.createDataFrame(out, "a long, r binary, spans array<int>")

    monkeypatch.setattr(suffix_dedup, "_sorted_shards", here)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(table(spark, texts), shard_bytes=16000).collect()}
    assert [got[i] for i in range(len(texts))] == removed_by_force(texts, 200)
    assert max(sizes.values(), default=0) <= 16000 // 8


# 4


def test_url_parts_and_rules(spark):
    cases = [
        ("https://WWW.Example.com/en/1?x#y", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("http://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
        ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        ("x://y.net/es/1", "y.net", "/es/1", "net/es/", "block"),
        ("http://a.com", "a.com", "", None, None),
        ("http://a.com?q=/", "a.com", "", None, None),
        ("no scheme", "", "", None, None),
        (None, "", "", None, None),
        ("a://b://c/d\n", "b:", "//c/d\n", None, None),
    ]
    pages = spark.createDataFrame([(i, c[0], "own", "own") for i, c in enumerate(cases)], "page_id long, url string, host string, tokens string")
    got = {r.page_id: r for r in url_filter.judge(pages).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert verdict is None or got[i].verdict == verdict
    assert url_filter.judge(pages.limit(0)).count() == 0


def judged_by_force(known, others, support, confidence):
    """(verdict, score) of each token set of others by all rules of known (token set, verdict) rows, none shortened by a better one."""
    n, whole, with_verdict = len(known), Counter(), Counter()
    for tokens, verdict in known:
        for size in range(1, len(tokens) + 1):
            for ante in itertools.combinations(sorted(tokens), size):
                whole[ante] += 1
                with_verdict[ante, verdict] += 1
    rules = {(a, v): c / whole[a] for (a, v), c in with_verdict.items() if c >= support * n and c / whole[a] >= confidence}
    kept = {(a, v): c for (a, v), c in rules.items() if not any(rules.get((a[:i] + a[i + 1 :], v), 0) >= c for i in range(len(a)))}
    out = []
    for tokens in others:
        fits = [(c, len(a), with_verdict[a, v] / n, v == "block") for (a, v), c in kept.items() if set(a) <= set(tokens)]
        best = max(fits, default=None)
        out.append(("allow", None) if best is None else ("block" if best[3] else "allow", best[0]))
    return out


def test_mined_rules_match_by_force(spark):
    rng = random.Random(26)
    urls = [f"https://{rng.choice(['shop', 'news'])}.{rng.choice('ab')}.{rng.choice(['net', 'com', 'org'])}/{rng.choice(['en', 'es', 'fr'])}/{rng.choice(['x', 'y', 'ad'])}{rng.choice(['', '?u=1'])}" for _ in range(260)]
    urls += [None, "", "none", "https://a.org", "https://x.y.z.org/" + "long-" * 40 + "ad", urls[0], urls[0]]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for support, confidence in ((0.05, 0.8), (0.02, 0.6)):
        got = {r.page_id: r for r in url_filter.judge(pages, support=support, confidence=confidence).collect()}
        host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
        rows = pages.select("page_id", url_filter.tokens_of(F.col("url"), host, path).alias("t"), url_filter.fitting_rule(host, path).alias("r")).collect()
        known = [(set(r.t), r.r.verdict) for r in rows if r.r]
        others = [r for r in rows if not r.r]
        want = judged_by_force(known, [r.t for r in others], support, confidence)
        assert {v for v, _ in want} == {"allow", "block"} and any(s is None for _, s in want)
        for r, (verdict, score) in zip(others, want, strict=True):
            assert got[r.page_id].verdict == verdict and got[r.page_id].score == (score and pytest.approx(score)), urls[r.page_id]
        assert all(got[r.page_id].reason == "rule" and got[r.page_id].verdict == r.r.verdict for r in rows if r.r)
    twice = pages.where("page_id < 3").unionByName(pages.where("page_id < 3"))
    assert url_filter.judge(twice).count() == 6 and url_filter.judge(pages.where("url like '%.org%'")).where("reason <> 'default'").count() == 0


def test_rules_hold_for_single_tokens(spark):
    rng = random.Random(6)
    urls = [f"https://{rng.choice(['shop', 'news', 'm'])}.{rng.choice('abcd')}.example.{rng.choice(['net', 'org'])}/{rng.choice(['en', 'es', 'fr'])}/{rng.randrange(99)}" for _ in range(300)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_filter.judge(pages, support=0.05, confidence=0.9).collect()
    host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
    rows = pages.select("page_id", url_filter.tokens_of(F.col("url"), host, path).alias("t"), url_filter.fitting_rule(host, path).alias("r")).collect()
    known = [(set(r.t), r.r.verdict) for r in rows if r.r]
    singles = {t for ts, _ in known for t in ts}
    frequent = {t for t in singles if sum(t in ts for ts, _ in known) >= 0.05 * len(known)}
    verdicts = {r.page_id: r for r in got}
    for r in rows:
        if r.r:
            assert verdicts[r.page_id].reason == "rule"
            continue
        # the most confident rule of one token bounds what the combination of all gives
        best = max((np.mean([v == w for ts, w in known if t in ts]) for t in set(r.t) & frequent for v in ("allow", "block")), default=0)
        assert verdicts[r.page_id].reason == "default" or verdicts[r.page_id].score >= min(best, 0.9) - 1e-9


def test_late_tokens_of_long_urls_count(spark):
    rng = random.Random(9)
    slug = lambda: "-".join("".join(rng.choices("abcdefghijklmnop", k=9)) for _ in range(40))
    urls = [f"https://a{i % 7}.net/es/{slug()}?spam={i}" if i % 2 else f"https://b{i % 7}.com/{slug()}?page={i}" for i in range(80)]
    urls += [f"https://x.org/{slug()}?spam=1", f"https://x.org/{slug()}?page=1", f"https://x.org/{slug()}"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.verdict, r.reason) for r in url_filter.judge(pages, support=0.2).collect()}
    assert [got[i] for i in (80, 81, 82)] == [("block", "mined"), ("allow", "mined"), ("allow", "default")]
    deep = spark.createDataFrame([("https://a.b.c.d.e.org/",)], "url string").select(url_filter.tokens_of(F.col("url"), F.lit("a.b.c.d.e.org"), F.lit("/"))).first()[0]
    assert "host:a.b.c.d.e.org" in deep


# 5


def test_language_by_compression(spark):
    rng = random.Random(7)
    stems = {"aa": ["thorn", "whisk", "brand"], "bb": ["quelle", "chose", "jour"], "cc": ["strasse", "ziel", "\u00fcber"]}
    make = lambda lang, n: " ".join(rng.choice(stems[lang]) + rng.choice(["", "s", "en", "ly"]) for _ in range(n))
    langs = [rng.choice(list(stems)) for _ in range(240)]
    texts = [make(x, rng.randrange(3, 80)) for x in langs]
    docs = table(spark, texts, langs=langs)
    model = language_id.fit(docs.where("doc_id < 120"))
    assert [x for x, _ in model] == ["aa", "bb", "cc"]
    got = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert np.mean([got[i].lang_pred == langs[i] for i in range(120, 240)]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    odd = language_id.identify(table(spark, [*HARD, "123 ... !!"]), model)
    assert "own" not in {r.score for r in odd.collect()} and odd.columns.count("score") == 1
    kinds = {r.doc_id: r.lang_pred for r in odd.collect()}
    assert [kinds[i] for i in (0, 1, 2, 9)] == ["und"] * 4 and kinds[3] in stems
    assert {r.lang_pred for r in language_id.identify(docs.limit(3), []).collect()} == {"und"}
    assert language_id.fit(docs.limit(0)) == [] and language_id.identify(docs.limit(0), model).count() == 0


# 6


def test_quality_on_held_out(spark):
    rng = random.Random(8)
    good = [". ".join(prose(rng, rng.randrange(5, 20)).capitalize() for _ in range(rng.randrange(1, 8))) + "." for _ in range(300)]
    bad = [rng.choice([prose(rng, 40).upper() + "!!", " ".join([f"w{rng.randrange(9)}"] * 60), " | ".join(prose(rng, 30).split()), "$$$ ".join(prose(rng, 30).split())]) for _ in range(300)]
    docs = table(spark, [*good, *bad, *HARD])
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(600)] + [(5, None), (10**6, 1), (None, 0)], "doc_id long, quality int")
    model = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    assert np.mean([got[i].predicted == int(i < 300) for i in range(1, 600, 2)]) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())
    x = quality.statistics(__import__("pyarrow").array([t.encode() for t in good[:50] + bad[:50]], "binary"))
    plain = []
    for row in x:  # a walk over one tree after another
        total = model.base
        for at in model.roots.tolist():
            while model.left[at] != at:
                at = int(model.right[at] if row[model.feature[at]] > model.cut[at] else model.left[at])
            total += model.value[at]
        plain.append(1 / (1 + np.exp(-total)))
    assert np.allclose(model.score(x), plain)
    none = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs.limit(3), none).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0


# 7


def slow_alignment(item, passage):
    best, row = 0, [0] * (len(passage) + 1)
    for w in item:
        new = [0]
        for j, p in enumerate(passage):
            new.append(max(0, row[j] + (2 if p == w else -1), row[j + 1] - 1, new[j] - 1))
        row, best = new, max(best, *new)
    return best / (2 * len(item))


def test_alignment_against_the_plain_recurrence():
    rng = random.Random(9)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 12))] for _ in range(2))
        score, first, end = decontaminate.align(np.array(a), np.array(b))
        assert score == pytest.approx(slow_alignment(a, b))
        assert score == 0 or slow_alignment(a, b[first:end]) == pytest.approx(score)


def test_contaminated_documents_are_found(spark):
    rng = random.Random(10)
    items = [prose(rng, n, 5000) for n in (2, 12, 30, 60, 80)]
    texts, want = list(HARD), set()
    for k, item in enumerate(items):
        for edits in (0, 1, len(item.split()) // 6):
            w = item.split()
            for p in rng.sample(range(len(w)), edits if len(w) > 10 else 0):
                w[p] = "edited"
            want.add((len(texts), k))
            texts.append(prose(rng, 50, 5000) + "\n" + " ".join(w).upper() + "\t" + prose(rng, 50, 5000))
    clean = len(texts)
    texts += [prose(rng, 100, 5000) for _ in range(30)]
    docs = table(spark, texts)
    bench = spark.createDataFrame([*enumerate(items), (77, None), (78, " "), (None, "null id item")], "item_id long, text string")
    got = decontaminate.contaminated(docs, bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want
    kept = decontaminate.without_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in want} and clean
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0 and decontaminate.contaminated(docs.limit(0), bench).count() == 0


# 8


def test_jaccard_components_as_by_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    monkeypatch.setattr(ngram_join, "GROUP", 2)
    rng = random.Random(11)
    texts = list(HARD)
    for _ in range(12):
        base = prose(rng, rng.randrange(30, 80)).split()
        for _ in range(rng.randrange(1, 7)):
            w = base.copy()
            for p in rng.sample(range(len(w)), rng.randrange(4)):
                w[p] = f"e{rng.randrange(9)}"
            texts.append(" ".join(w))
    texts += [texts[15].upper(), texts[15]]
    docs = table(spark, texts)
    sets = []
    for t in texts:
        w = WORD.findall((t or "").translate(UP))
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set())
    root = list(range(len(sets)))
    for _ in sets:
        for a in range(len(sets)):
            for b in range(a):
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs, 3, 90).collect()}
    assert got == {i: (len(sets[i]), root[i]) for i in range(len(sets))}


def near(words, rng, n, kinds=9):
    """A copy with n words replaced."""
    w = list(words)
    for p in rng.sample(range(len(w)), n):
        w[p] = f"e{rng.randrange(kinds)}"
    return " ".join(w)


def linked_by_force(texts, n, percent):
    sets = []
    for t in texts:
        w = WORD.findall((t or "").translate(UP))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in range(len(sets))}


@pytest.mark.parametrize("closest", [(0, 8, 256, None), (0, 1, None), (None,)])
def test_clusters_at_the_border_need_rounds(spark, monkeypatch, closest):
    # copies near the border of linking: pairs of a forest fail, lists have several blocks
    for name, value in (("BLOCK", 3), ("GROUP", 2), ("DEAL", 4), ("CLOSEST", closest)):
        monkeypatch.setattr(ngram_join, name, value)
    rng = random.Random(31)
    texts = []
    for _ in range(4):
        base = [f"w{rng.randrange(500)}" for _ in range(90)]
        texts += [near(base, rng, rng.randrange(5)) for _ in range(16)]
    texts += ["the same few words in every text " + prose(rng, 12) for _ in range(12)]
    rng.shuffle(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(table(spark, texts), 5, 80).collect()}
    assert got == linked_by_force(texts, 5, 80)


def test_words_decide_links_not_hashes(spark):
    # letters of the Thue-Morse sequence and of its complement collide under any polynomial hash modulo 2 to the 64
    bits = [bin(i).count("1") & 1 for i in range(2048)]
    a, b = ("".join("ab"[x ^ y] for x in bits) for y in (0, 1))
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(table(spark, [a, b, a + " " + b, b + " " + a]), 3, 90).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3}
    for n in (1, 3, 5):
        rng = random.Random(n)
        for _ in range(60):
            x, y = ((" ".join(rng.choice(["a", "b", "B", "\u00e9", "w" * 70, "w" * 69 + "v", "\0"]) for _ in range(rng.randrange(14)))) for _ in range(2))
            (_, _), (size, root) = linked_by_force([x, y], n, 50).values()
            shared, united = ngram_join.overlap(x.encode(), y.encode(), n)
            assert (united > 0 and 2 * shared >= united) == (root == 0)


def test_equal_hashes_of_different_words_are_told_apart():
    text = b"one two one three two"
    h, start, end, _ = kernels.words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    numbers, many = kernels.word_numbers(text, np.zeros_like(h), start, end)
    assert many == 3 and numbers.tolist() == [0, 1, 0, 2, 1]
    numbers, many = kernels.word_numbers(text, h, start, end)
    assert many == 3 and numbers[0] == numbers[2] and numbers[1] == numbers[4] and len(set(numbers.tolist())) == 3


def test_long_near_copies_link_and_tables_stay_in_proportion(spark):
    rng = random.Random(33)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120_000)]
    texts = [" ".join(base), near(base, rng, 2000, 10**6), near(base, rng, 9000, 10**6), " ".join(reversed(base))]
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(table(spark, texts), 5, 80).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 3}
    docs = table(spark, texts)
    for words in (20_000, 40_000):
        docs = table(spark, [" ".join(base[:words]), " ".join(base[: words - 9])])
        records = ngram_join._records(docs, 5, 80, (np.zeros(0, np.uint64), np.zeros(0, np.int64)), "doc_id", "text")
        assert records.selectExpr("max(8 * size(prefix) + length(sig) + coalesce(length(wide), 0)) as b").first().b < 2 * words


def test_ids_that_repeat_are_one_node(spark):
    rng = random.Random(34)
    a, b = prose(rng, 60), prose(rng, 60)
    docs = table(spark, [a, b, a + " x", b + " y", a, None, "", a], ids=[1, 1, 2, 3, 1, 9, 9, None])
    rows = ngram_join.jaccard_components(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in rows) == [(0, 1), (1, 1), (1, 1), (1, 1), (2, 1), (3, 1), (9, 9), (9, 9)]


def test_one_document_of_each_group_stays(spark):
    rng = random.Random(12)
    a = prose(rng, 100)
    docs = table(spark, [a, a + " more", prose(rng, 100), None, a, prose(rng, 40)], ids=[4, 2, 3, 5, None, 3])
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 3, 5]  # two texts of id 3 with nothing in common; a copy without an id goes
    assert ngram_join.jaccard_components(docs.limit(0)).count() == 0


def test_texts_that_share_an_id_or_have_none(spark):
    rng = random.Random(61)
    a, b, c, long = (prose(rng, n) for n in (60, 60, 60, 30_000))
    rows = [(1, a), (1, b), (1, a), (2, b + " end"), (None, c), (None, c), (None, c + " end"), (None, a), (None, None), (None, ""), (7, None), (None, long), (8, long + " end")]
    docs = table(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    kept = sorted(((r.doc_id, r.text) for r in ngram_join.one_of_each(docs).collect()), key=str)
    ids = {i: [t for j, t in kept if j == i] for i in {i for i, _ in kept}}
    assert set(ids) <= {1, 2, 7, 8, None} and ids[7] == [None] and ids[8] == [long + " end"]
    assert sum(t == a for _, t in kept) == 1 and sum(t in (b, b + " end") for _, t in kept) == 1  # near texts leave one, others stay
    assert sum(t in (c, c + " end") for t in ids[None]) == 1 and len(kept) == 7 and {None, ""} <= set(ids[None])
    assert ngram_join.one_of_each(docs.limit(0)).count() == 0


def test_thousands_of_copies(spark):
    """One text a thousand times without an id and as often under one id."""
    rng = random.Random(62)
    body, other = prose(rng, 400) + "\na line that is in all of the copies\n", prose(rng, 50)
    docs = table(spark, [*[body] * 2000, other], ids=[*[None] * 1000, *[5] * 1000, 6])
    assert sorted(r.doc_id for r in ngram_join.one_of_each(docs).collect()) == [5, 6]
    cut = suffix_dedup.remove_repeats(docs).groupBy("n_bytes").agg(F.count("*").alias("n"), F.sum("n_removed").alias("gone")).collect()
    size = len(body.encode())
    assert {(r.n_bytes, r.n, r.gone) for r in cut} == {(size, 2000, 2000 * size), (len(other.encode()), 1, 0)}


def test_fits_read_one_row_of_an_id(spark):
    rng = random.Random(63)
    texts = [prose(rng, 30) for _ in range(8)]
    docs = table(spark, texts, langs=["aa", "bb"] * 4)
    many = docs
    for _ in range(5):
        many = many.unionByName(many)
    assert language_id.fit(docs) == language_id.fit(many)
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    once, often = quality.fit(docs, labels), quality.fit(many, labels)
    assert [r.score for r in quality.score(docs, once).orderBy("doc_id").collect()] == [r.score for r in quality.score(docs, often).orderBy("doc_id").collect()]


# 9


def test_lines_as_by_force(spark):
    rng = random.Random(13)
    pool = ["A common line here", "  a COMMON line here\t", "short", "\u00e9" * 9, "\u00e9" * 10, "another common line", "", "x" * 2000]
    texts = [*HARD, *["\n".join(rng.choice([*pool, prose(rng, 4)]) for _ in range(rng.randrange(12))) for _ in range(60)]]
    docs = table(spark, texts)
    key = lambda line: line.strip(" \t\n\x0b\f\r").translate(UP)
    holders = {}
    for i, t in enumerate(texts):
        for line in (t or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    for i, t in enumerate(texts):
        lines = (t or "").split("\n")
        keep = [x for x in lines if not (len(key(x)) >= 10 and len(holders[key(x)]) > 1 and min(holders[key(x)]) != i)]
        assert (got[i].text, got[i].n_lines, got[i].n_dropped) == ("\n".join(keep), len(lines), len(lines) - len(keep))
    twice = line_dedup.dedup_lines(table(spark, ["a long line to keep"] * 4 + ["a long line to keep\nand one more line"] * 2, ids=[1, 1, None, None, None, None])).collect()
    assert sorted((r.doc_id or 0, r.n_dropped) for r in twice) == [(0, 1), (0, 1), (0, 1), (0, 1), (1, 0), (1, 0)]
    # without ids at all, texts are documents: equal ones keep their lines, a line of two different texts stays in one of them
    none = line_dedup.dedup_lines(table(spark, ["only line of it"] * 2 + ["first line here\nonly line of it"], ids=[None] * 3)).collect()
    assert sorted(r.n_dropped for r in none) in ([0, 0, 1], [0, 1, 1])
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


# 10


def phrases_by_force(data: bytes) -> set[bytes]:
    seen, out, at = set(), set(), 0
    for i in range(1, len(data) + 1):
        if data[at:i] not in seen:
            seen.add(data[at:i])
            out.add(data[at:i])
            at = i
    return out | ({data[at:]} if at < len(data) else set())


def test_phrases_and_signatures():
    rng = random.Random(14)
    for t in [b"", b"a", b"aaaa", b"abab" * 9, *[prose(rng, 60, 30).encode() for _ in range(20)]]:
        h = fingerprints.phrase_hashes(t, fingerprints.Parse().feed(t))
        assert len(h) == len(phrases_by_force(t))
    a, b = prose(rng, 400).encode(), prose(rng, 400).encode()
    mixed = a[: len(a) // 2] + b[: len(a) // 2]
    sig = lambda t: fingerprints.signature(fingerprints.phrase_hashes(t, fingerprints.Parse().feed(t)))
    pa, pm = phrases_by_force(a), phrases_by_force(mixed)
    assert fingerprints.likeness(sig(a), sig(mixed)) == pytest.approx(len(pa & pm) / len(pa | pm), abs=0.15)


@pytest.mark.parametrize("buckets", [1, 3, 50])
def test_documents_follow_each_other(spark, buckets):
    rng = random.Random(15)
    texts = [*HARD, *[prose(rng, rng.randrange(60)) for _ in range(25)]]
    ids = [3 * i for i in range(len(texts) - 2)] + [None, 6]
    docs = table(spark, texts, ids=ids)
    order = sorted(((i, t or "") for i, t in zip(ids, texts, strict=True)), key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    want = []
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        want.append((i, len(t), edited, fingerprints.fingerprint(t), fingerprints.fingerprint(edited)))
    got = fingerprints.fingerprinted(docs, buckets=buckets).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_text, r.fingerprint, r.edited_fingerprint) for r in got), key=repr) == sorted(want, key=repr)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_rows_without_ids_are_spread_and_follow_in_order(spark):
    rng = random.Random(16)
    texts = [prose(rng, rng.randrange(1, 40)) for _ in range(40)]
    got = {}
    for buckets in (1, 7):
        rows = fingerprints.fingerprinted(table(spark, texts, ids=[5, 3] + [None] * 38), buckets=buckets).collect()
        got[buckets] = sorted(((r.doc_id, r.n_chars, r.edited_text, r.near_edited, r.near_next) for r in rows), key=repr)
        assert len(rows) == 40
    assert got[1] == got[7]


def likeness_by_force(a, b):
    """The share of equal bins of two signatures, by the definition of one-permutation minimum hashes."""
    def bins(h):
        own = {}
        for x in h.tolist():
            own[x >> 57] = min(own.get(x >> 57, x), x)
        out = []
        for i in range(fingerprints.BINS):
            k = next(k for k in range(fingerprints.BINS) if (i + k) % fingerprints.BINS in own)
            value = np.array([own[(i + k) % fingerprints.BINS]], np.uint64) + np.array([k], np.uint64) * fingerprints._BASE
            out.append(int(fingerprints.mix(value)[0]) & 0xFFFF)
        return out

    x, y = bins(a), bins(b)
    equal, chance = sum(p == q for p, q in zip(x, y, strict=True)) / len(x), 2.0**-16
    return min(1.0, max(0.0, (equal - chance) / (1 - chance)))


def test_likeness_of_edited_and_next_by_force(spark):
    rng = random.Random(17)
    texts = [prose(rng, rng.randrange(2, 200), 40) for _ in range(12)]
    hashes = lambda t: fingerprints.phrase_hashes(t, fingerprints.Parse().feed(t))
    rows = {r.doc_id: r for r in fingerprints.fingerprinted(table(spark, texts)).collect()}
    for i, t in enumerate(texts):
        after = texts[(i - 1) % len(texts)]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        own, new, its = (hashes(x.encode()) for x in (t, edited, after))
        assert rows[i].near_edited == pytest.approx(likeness_by_force(own, new)) and rows[i].near_next == pytest.approx(likeness_by_force(own, its))


def test_full_dictionaries_are_begun_anew(monkeypatch):
    monkeypatch.setattr(fingerprints, "PHRASES", 50)
    text = prose(random.Random(18), 400).encode()
    parse = fingerprints.Parse().feed(text)
    assert len(parse.known) <= 50 < len(parse.ends)
    halves = fingerprints.Parse().feed(text[:700])
    fork = halves.fork().feed(text[700:])
    assert fork.ends == parse.ends and halves.size == 700
    assert b"".join(text[a:b] for a, b in zip([0, *parse.ends], [*parse.ends, len(text)], strict=True)) == text


def test_no_documents_no_fingerprints(spark):
    empty = fingerprints.fingerprinted(table(spark, ["x"]).limit(0))
    assert empty.count() == 0 and len(empty.columns) == 7
    alone = fingerprints.fingerprinted(table(spark, ["abcd"])).first()
    assert alone.edited_text == "abab" and alone.near_next == 1.0


def test_hash_of_kept_text_is_that_of_bytes(spark):
    row = line_dedup.dedup_lines(table(spark, ["\u00e9\nb"])).select(F.sha2(F.col("text").cast("binary"), 256).alias("h")).first()
    assert row.h == hashlib.sha256("\u00e9\nb".encode()).hexdigest()


# pipeline


def corpus(spark, folder, rows, benchmark):
    shape = "doc_id long, text string, lang string, source string, n_chars long, score double, accepted string, __k string, row string, kept string"
    full = [(i, t, lg, s, None if t is None else len(t), 42.0, "mine", "k", "r", "x") for i, t, lg, s in rows]
    spark.createDataFrame(full, shape).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(benchmark)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_pipeline_stage_by_stage(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(40)
    stems = {"aa": ["thorn", "whisk", "brand", "cliff"], "bb": ["quelle", "chose", "jour", "soir"]}
    make = lambda lang, n: " ".join(rng.choice(stems[lang]) + rng.choice(["", "s", "en", "ly"]) + rng.choice(["", "a", "o", "ix"]) + str(rng.randrange(30)) * (rng.random() < 0.4) for _ in range(n))
    items = [make("aa", 40) for _ in range(3)]
    rows = [(i, make("aa" if i % 2 else "bb", rng.randrange(30, 90)), "aa" if i % 2 else "bb", "s" if i % 3 else None) for i in range(60)]
    copies = [(100 + i, rows[i][1] + " end", rows[i][2], "t") for i in range(6)]
    leaks = [(200 + k, make("bb", 20) + " " + item + " " + make("bb", 20), "bb", "s") for k, item in enumerate(items)]
    odd = [(300, None, None, None), (301, "", "aa", "s"), (302, "12 34 ...", "aa", "s"), (None, make("aa", 50), "aa", "s"), (7, rows[7][1], rows[7][2], rows[7][3])]
    corpus(spark, f"{tmp_path}/d", rows + copies + leaks + odd, items)
    docs = spark.read.parquet(f"{tmp_path}/d/documents.parquet")
    columns, kept = docs.columns, {}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language id", "n-gram jaccard join", "benchmark decontamination", "source mixing", "token output"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, f"{tmp_path}/d")
        assert docs.columns == columns
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        found = docs.collect()
        kept[name] = Counter(r.doc_id for r in found)
        assert {(r.score, r.accepted, r["__k"], r.row, r.kept) for r in found} == {(42.0, "mine", "k", "r", "x")}
    # documents without letters go, others with a clear language stay
    assert not {300, 301, 302} & set(kept["language id"]) and sum(i in kept["language id"] for i in range(60)) > 50
    alike = linked_by_force([r[1] for r in rows + copies + leaks], 5, 80)
    ids = [r[0] for r in rows + copies + leaks]
    groups = {}
    for at, (_, root) in alike.items():
        if ids[at] in kept["language id"]:
            groups.setdefault(root, []).append(ids[at])
    assert {i for i in kept["n-gram jaccard join"] if i is not None} == {min(g) for g in groups.values()} and set(kept["n-gram jaccard join"].values()) == {1}
    assert set(kept["benchmark decontamination"]) == set(kept["n-gram jaccard join"]) - {200, 201, 202}
    plan = {r.doc_id: r.copies for r in mixing.mix(spark.read.parquet(f"{tmp_path}/benchmark decontamination")).collect()}
    assert kept["source mixing"] == Counter({i: n for i, n in plan.items() if n})
    out = corpus_pipeline.STAGES[-1][1](spark, docs, f"{tmp_path}/d")
    ids_of = lambda r: np.frombuffer(r.tokens, "<u2")[: r.n_tokens]
    rows_out = sorted(out.collect(), key=lambda r: r.slot)
    order = token_output.permute(np.arange(len(rows_out)), len(rows_out), "order")
    stream = np.concatenate([ids_of(rows_out[s]) for s in order.tolist()])
    ends = np.flatnonzero(stream == token_output.END)
    coder = token_output.encoder(token_output.VOCABULARY)
    texts = Counter(coder.decode(x[x != token_output.END].tolist()) for x in np.split(stream, ends + 1)[:-1])
    assert texts == Counter(r.text for r in docs.collect())
    whole = corpus_pipeline.run(spark, f"{tmp_path}/d")
    assert sorted(map(tuple, whole.drop("tokens").collect())) == sorted(map(tuple, out.drop("tokens").collect()))


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    corpus(spark, f"{tmp_path}/d", [], [])
    assert corpus_pipeline.run(spark, f"{tmp_path}/d").count() == 0


# all operators


def test_names_of_own_columns_do_not_matter(spark):
    rng = random.Random(50)
    names = ["row", "t", "k", "th", "h", "c", "marks", "gone", "new", "found", "key", "n", "__kept_id"]
    texts = [prose(rng, 60) + "\nthe same line of text\n" for _ in range(6)]
    docs = table(spark, [*texts, None, ""]).select("doc_id", "text", "lang", "source", *[F.concat(F.lit(f"{c}-"), "doc_id").alias(c) for c in names])
    bench = spark.createDataFrame([(0, "nothing of this is there")], "item_id long, text string")
    model = language_id.fit(table(spark, texts, langs=["aa"] * 6))
    for out in (line_dedup.dedup_lines(docs), suffix_dedup.remove_repeats(docs), decontaminate.without_contaminated(docs, bench), language_id.identify(docs, model), language_id.accepted(docs, model), ngram_join.one_of_each(docs), mixing.mixed(docs, total=1.0, weights=(1.0,))):
        for r in out.collect():
            assert [r[c] for c in names] == [f"{c}-{r.doc_id}" for c in names]


def test_rows_that_repeat_and_miss_ids(spark):
    rng = random.Random(51)
    item = prose(rng, 30, 5000)
    texts = [prose(rng, 30) + " " + item, prose(rng, 40), prose(rng, 40)]
    docs = table(spark, [texts[0], texts[0], texts[1], texts[1], texts[2], texts[0]], ids=[1, 1, 2, 2, None, None])
    bench = spark.createDataFrame([(5, item), (6, item), (None, item)], "item_id long, text string")
    found = decontaminate.contaminated(docs, bench).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in found) == [(0, 5), (0, 6), (1, 5), (1, 5), (1, 6), (1, 6)]
    assert sorted(r.doc_id or 0 for r in decontaminate.without_contaminated(docs, bench).collect()) == [0, 2, 2]
    mixed = mixing.mix(docs.unionByName(docs)).collect()
    assert len(mixed) == 12 and len({(r.doc_id, r.size, r.copies) for r in mixed if r.doc_id}) == 2
    gone = suffix_dedup.remove_repeats(table(spark, [prose(rng, 80), prose(rng, 80)] * 2, ids=[None, None, None, 1])).collect()
    assert all(r.n_removed == r.n_bytes for r in gone)
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (2, 1)], "doc_id long, quality int")
    scored = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(scored) == 6 and len({r.score for r in scored if r.doc_id == 1}) == 1


def test_only_the_registry_guards_the_import():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for name in ["corpus_pipeline.py", *(f"annalist/llm/{x}" for x in os.listdir(f"{root}/annalist/llm") if x.endswith(".py"))]:
        with open(f"{root}/{name}") as f:
            assert "ImportError" not in (text := f.read()) and "ModuleNotFoundError" not in text and "localCheckpoint" not in text
