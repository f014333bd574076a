"""Periodic runs against brute force over every period."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from plumbtable.llm import queries
from plumbtable.llm.runs import find_runs, guaranteed_overlap, periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def by_force(words, least=24, periods=3):
    n, found, taken = len(words), [], []
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            smaller = any(s <= start and start + length <= s + m and q % p == 0 for s, m, p in taken)
            if length >= max(least, periods * q) and not smaller:
                found.append((start, length, q))
            if length >= 2 * q:
                taken.append((start, length, q))
    return sorted(found)


def collapsed(words, runs):
    gone = {k for s, m, p in runs for k in range(s + p, s + m)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def numbers(lists):
    return np.array([w for words in lists for w in words], np.int64), np.cumsum([0, *map(len, lists)])


@pytest.mark.parametrize(("least", "periods"), [(24, 3), (6, 3), (40, 5), (2, 3), (100, 4)])
def test_runs_equal_brute_force(least, periods):
    draw = np.random.default_rng(3)
    lists = [[], [1], [1] * 400]
    for _ in range(60):
        words = draw.integers(0, int(draw.integers(2, 40)), int(draw.integers(0, 60))).tolist()
        for _ in range(int(draw.integers(0, 4))):
            unit = draw.integers(0, int(draw.integers(1, 4)) + 1, int(draw.integers(1, 60))).tolist()
            words += unit * int(draw.integers(1, 9)) + unit[: int(draw.integers(0, 4))]
            words += draw.integers(0, 9, int(draw.integers(0, 3))).tolist()
        lists.append(words)
    nested = ([0] * 30 + [1]) * 4 + [2] + ([0, 1] * 15 + [3]) * 5
    lists += [nested, nested * 3, draw.integers(0, 2, 600).tolist()]
    got = periodic_runs(*numbers(lists), least, periods)
    for k, words in enumerate(lists):
        assert got.get(k, []) == by_force(words, least, periods), (k, words)


def test_guaranteed_overlap_of_the_usual_limits():
    assert guaranteed_overlap(24, 3) == 16 and guaranteed_overlap(2, 3) == 2 and guaranteed_overlap(100, 4) == 75


def test_find_runs_takes_nulls_long_texts_and_clashing_names(spark):
    long = "a b c " * 50_000 + "end"
    rows = [(1, None), (2, ""), (None, " x\ty\x0bz "), (4, "w " * 30), (4, "w " * 30), (5, long), (6, "é  " * 24)]
    schema = "doc_id long, text string, id string, runs int, n_words string, collapsed long"
    docs = spark.createDataFrame([(*r, "i", 1, "n", 2) for r in rows], schema)
    got = sorted(find_runs(docs.repartition(3)).collect(), key=lambda r: (r.doc_id or 0, r.n_words))
    assert [(r.doc_id, r.n_words, [tuple(x) for x in r.runs]) for r in got] == [
        (None, 3, []), (1, 0, []), (2, 0, []), (4, 30, [(0, 30, 1)]), (4, 30, [(0, 30, 1)]),
        (5, 150_001, [(0, 150_000, 3)]), (6, 24, [(0, 24, 1)]),
    ]
    assert [r.collapsed for r in got] == ["x y z", "", "", "w", "w", "a b c end", "é "]
    assert find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        find_runs(docs, min_periods=2)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op13_runs(spark, sf).collect()
    assert len(got) == len(docs)
    assert sum(r.n_runs > 0 for r in got) >= 10
    for r in got:
        words = WORD.findall(docs[r.doc_id] or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = by_force(words) if n < 600 else [tuple(x) for x in periodic_runs(*numbers([[hash(w) for w in words]])).get(0, [])]
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None, None, None))
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha("".join(f"{s},{m},{q}\n" for s, m, q in runs))
        assert r.collapsed_sha256 == sha(collapsed(words, runs))
