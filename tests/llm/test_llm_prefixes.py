"""The prefix trie against a trie built from whole rebuilt conversations."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbtable.llm import prefixes, queries

SCHEMA = "conv_id long, turn long, role string, text string, d long, part int, f1 string, head long"


def by_force(rows):
    """The contract's columns, from rebuilt texts."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for *_, r, t in sorted(some)] for c, some in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        made = turns.get(c - int(np.fmod(c, 20)), [])[:h] + turns[c][h:]
        for d in range(len(made) + 1):
            members[tuple(made[:d])].append(c)
        ends[tuple(made)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0d]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in children[node]) or int(not children[node])
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in children[node])
    return sorted(
        (
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children[node]), leaves[node],
            saved[node], hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, own in members.items()
    )


def trie_of(spark, monkeypatch, rows, parts=4):
    docs = spark.createDataFrame([(*r, 5, 6, "f", 7) for r in rows], SCHEMA)
    monkeypatch.setattr(queries, "table", lambda *_: docs.repartition(parts))
    return sorted(tuple(r) for r in queries.op12_prefixes(spark, "").collect())


def test_trie_of_nulls_ties_repeated_rows_and_absent_bases(spark, monkeypatch):
    draw = np.random.default_rng(9)
    rows = [(None, 1, "user", "lost")]
    for conv in [*range(-45, 90), 1001, 1002, 1003]:
        if conv % 20 or conv in (0, 20, 60, -20):
            for turn in range(int(draw.integers(1, 7))):
                text = [None, "", "a b", "a  b", "c\nd e"][draw.integers(5)] if turn else "same first turn"
                rows.append((conv, None if draw.random() < 0.1 else turn, [None, "user"][draw.integers(2)], text))
    rows += rows[5:15] * 2
    monkeypatch.setattr(prefixes, "BLOCK", 2)
    assert trie_of(spark, monkeypatch, rows) == by_force(rows)


def test_one_long_conversation_over_many_tasks_and_many_equal_ones(spark, monkeypatch):
    rows = [(40, k, "user", f"turn {k % 7}") for k in range(3000)] + [(c, 0, "user", "hello there") for c in range(100, 900)]
    rows += [(c, k, "user", f"turn {k % 7}") for c in (41, 42) for k in range(2500)]
    assert trie_of(spark, monkeypatch, rows, 8) == by_force(rows)


def test_no_conversations_no_nodes(spark, monkeypatch):
    assert trie_of(spark, monkeypatch, []) == [] == by_force([])
    assert trie_of(spark, monkeypatch, [(None, 1, "a", "b")]) == []


def test_equal_fingerprints_of_different_turns_end_the_job(spark):
    rows = [(c, 1, 5, 5, 0, 0, r, 0, 2, True) for c, r in ((1, 3), (2, 4))]
    schema = "conv long, d long, f1 long, f2 long, p1 long, p2 long, r1 long, r2 long, words long, ends boolean"
    with pytest.raises(Exception, match="equal fingerprints"):
        prefixes.prefix_trie(spark.createDataFrame(rows, schema)).collect()


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = queries.op12_prefixes(spark, sf)
    assert sorted(tuple(r) for r in got.collect()) == by_force([tuple(r) for r in rows])
    assert got.where(F.col("depth") == 0).count() == 1
