"""Substring duplicates against brute force over all windows."""

import hashlib
import re

import numpy as np

from plumbtable.llm import queries, substrings
from plumbtable.llm.substrings import SuffixAutomaton, anchors, remove_repeats


def by_force(texts, width=20):
    """``words, kept words`` of each ``(id, text)``; rows of one id are not earlier than each other."""
    lists = [(i, re.findall(r"[^\x20\x09-\x0d]+", t or "")) for i, t in texts]
    first = {}
    for i, words in lists:
        for k in range(len(words) - width + 1):
            key = tuple(words[k : k + width])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, words in lists:
        gone, seen = set(), set()
        for k in range(len(words) - width + 1):
            key = tuple(words[k : k + width])
            if key in seen or (key in first and (i is None or first[key] < i)):
                gone.update(range(k, k + width))
            seen.add(key)
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return out


def compare(got, texts, width=20):
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))
    assert order(tuple(r) for r in got) == order(by_force(texts, width))


def corpus(draw, n, words=60):
    """Documents that share passages, near copies, copies, and repeats of their own."""
    vocabulary = [f"w{k}" for k in range(words)]
    passages = [draw.choice(vocabulary, int(draw.integers(5, 90))).tolist() for _ in range(12)]
    texts = []
    for _ in range(n):
        made = []
        for _ in range(int(draw.integers(0, 6))):
            made += draw.choice(vocabulary, int(draw.integers(0, 30))).tolist()
            if draw.random() < 0.7:
                part = list(passages[draw.integers(12)])
                if draw.random() < 0.5:
                    part[draw.integers(len(part))] = f"x{draw.integers(4)}"
                made += part * int(draw.integers(1, 3))
        if draw.random() < 0.1:
            made += ["same"] * int(draw.integers(1, 70))
        texts.append(" ".join(made))
    return texts + texts[: n // 10]


def test_matching_statistics_equal_a_search():
    draw = np.random.default_rng(1)
    for _ in range(80):
        base = draw.integers(0, 3, int(draw.integers(0, 40))).tolist()
        other = draw.integers(0, 4, int(draw.integers(0, 40))).tolist()
        inside = {tuple(base[a:b]) for a in range(len(base)) for b in range(a + 1, len(base) + 1)}
        want = [max((n for n in range(1, t + 2) if tuple(other[t + 1 - n : t + 1]) in inside), default=0) for t in range(len(other))]
        assert SuffixAutomaton(base).matched(other) == want


def test_equal_windows_have_equal_anchors():
    draw = np.random.default_rng(2)
    hashes = draw.integers(0, 5, 400).astype(np.uint64)
    first = np.array([0, 10, 150, 150, 400])
    whole, at, grams = anchors(hashes, first, 20, 12)
    assert whole.tolist() == [*range(10, 131), *range(150, 381)]
    places = {}
    for w, a in zip(whole.tolist(), at.tolist()):
        assert w <= a <= w + 8
        assert places.setdefault(tuple(hashes[w : w + 20]), (a - w, grams[a])) == (a - w, grams[a])


def test_repeats_equal_brute_force(spark):
    draw = np.random.default_rng(6)
    texts = list(zip(draw.permutation(900).tolist(), corpus(draw, 400)))
    rows = [(i, t, "x", 1, 2, "r") for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ref string, h int, key long, runs string")
    compare(remove_repeats(docs.repartition(6)).collect(), texts)


def test_small_shards_and_shared_references(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD", 30)
    monkeypatch.setattr(substrings, "STRETCH", 7)
    monkeypatch.setattr(substrings, "HEAVY", 4)
    draw = np.random.default_rng(7)
    texts = list(enumerate(corpus(draw, 120)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    compare(remove_repeats(docs).collect(), texts)
    compare(remove_repeats(docs, width=9, k=4).collect(), texts, 9)


def test_nulls_repeated_ids_long_and_empty_texts(spark):
    a, b = " ".join(f"a{k}" for k in range(50)), " ".join(f"b{k}" for k in range(30))
    long = " ".join(f"l{k % 60_000}" for k in range(130_000))
    texts = [(None, a), (None, a), (None, b), (3, a + " " + b), (3, a + " " + b), (3, b), (2, "x\ty " + b), (1, None)]
    texts += [(1, ""), (None, None), (0, " \n"), (9, " ".join(b.split()[:19])), (11, long), (12, "q " + long)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    compare(remove_repeats(docs).collect(), texts)
    assert remove_repeats(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {i: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in by_force(docs)}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op11_substrings(spark, sf).collect()}
    assert got == want and sum(gone > 0 for _, gone, _ in want.values()) > 10
