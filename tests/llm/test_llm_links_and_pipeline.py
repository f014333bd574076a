"""Near-duplicate operators and the pipeline against brute force."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plumbtable.llm import embeddings, minhash
from plumbtable.llm.components import connected_components
from plumbtable.llm.decontaminate import find_benchmark_hits
from plumbtable.llm.embeddings import near_vectors
from plumbtable.llm.minhash import least_matches, near_duplicates, shingle_sets, signatures, survivors
from plumbtable.session import fresh_path

EXTRA = "doc_id long, text string, node long, component string, key long, id string"


def smallest_reachable(ids, linked):
    """Component of each id by repeated scans of the links."""
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < 5:
        return frozenset({tuple(words)} if words else ())
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def components_by_force(texts, percent=85):
    sets = {k: shingles(t) for k, t in texts.items()}
    linked = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return sets, smallest_reachable(sets, linked)


def changed(words, share, draw):
    words = list(words)
    for at in draw.choice(len(words), max(1, int(share * len(words))), replace=False):
        words[at] = f"w{draw.integers(1 << 30)}"
    return words


@pytest.fixture(scope="module")
def near_texts():
    """Groups of near copies about the threshold, exact copies, and texts without or with few words."""
    draw = np.random.default_rng(11)
    texts = []
    for group in range(6):
        base = [f"g{group}v{draw.integers(500)}" for _ in range(int(draw.integers(60, 300)))]
        for share in draw.uniform(0.001, 0.05, 30):
            texts.append(" ".join(changed(base, share, draw)))
        texts += [" ".join(base)] * 5 + [" ".join(base).upper()]
    texts += [None, None, "", "  \n", "one two", "One  two", "one two three", "x" * 40_000]
    order = draw.permutation(len(texts))
    return {k: texts[i] for k, i in enumerate(order)}


def check_documents(got, texts):
    sets, want = components_by_force(texts)
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (
            len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id,
        )


def test_near_duplicates_equal_brute_force(spark, near_texts):
    docs = spark.createDataFrame([(k, t, 1, "c", 2, "i") for k, t in near_texts.items()], EXTRA).repartition(5)
    check_documents(near_duplicates(docs).collect(), near_texts)


def test_near_duplicates_in_small_blocks(spark, near_texts, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    docs = spark.createDataFrame(list(near_texts.items()), "doc_id long, text string")
    check_documents(near_duplicates(docs).collect(), near_texts)


def test_near_duplicates_on_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    check_documents(near_duplicates(docs).collect(), texts)


def test_near_duplicates_edges(spark):
    assert near_duplicates(spark.createDataFrame([], EXTRA)).count() == 0
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (None, None), (9, None)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.component_id, r.kept) for r in got if r.doc_id) == [
        (2, 2, True), (2, 2, True), (3, 2, False), (9, 9, True),
    ]
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)] * 2


def test_signatures_estimate_similarity_and_survivors_are_safe():
    draw = np.random.default_rng(2)
    bounds = least_matches(0.85, 1e-5)
    words = [f"w{k}" for k in range(400)]
    for share in (0.005, 0.01, 0.03, 0.2):
        texts = [" ".join(words), " ".join(changed(words, share, draw))]
        sets = shingle_sets(__import__("pyarrow").array(texts))
        rows = signatures(sets)
        similar = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
        assert abs((rows[0] == rows[1]).mean() - similar) < 0.15
        kept = len(survivors(rows[:1], rows[1:], bounds))
        assert kept or similar < 0.85
        assert not kept or similar > 0.5
    assert bounds[0][1] <= 0.85 * 20 and bounds[-1][0] == minhash.BANDS * minhash.ROWS


def test_connected_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(7, k) for k in range(300, 420)]
    other = [(5, 5), (None, 3), (900, 901), (901, 900), (901, 902)]
    links = spark.createDataFrame(chain + star + other, "a long, b long")
    got = {r.node: r.component for r in connected_components(links).collect()}
    want = smallest_reachable(
        {n for link in chain + star + other[2:] for n in link}, chain + star + other[2:]
    )
    assert got == want
    assert connected_components(links.limit(0)).count() == 0


def test_vectors_equal_brute_force(spark):
    draw = np.random.default_rng(4)
    rows, centres = [], draw.normal(size=(12, 16))
    for k in range(700):
        v = centres[draw.integers(12)] + draw.normal(size=16) * draw.choice([0.05, 0.2, 1.0])
        rows.append((k, [float(np.float32(x)) for x in v], int(draw.integers(3))))
    rows += [(1000 + k, rows[0][1], rows[0][2]) for k in range(50)]
    rows += [(2000, None, 1), (2001, rows[1][1], None), (2002, [0.0] * 16, 1), (2003, [None] * 16, 1), (2004, [], 1)]
    rows += [(2005, [float("nan")] * 16, 1), (2006, [float("inf")] + [0.0] * 15, 1), (2007, [1.0, 2.0], 1), (2008, [2.0, 4.0], 1)]
    rows = [(i, v, c, 1, "n") for i, v, c in rows]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node int, digest string")
    got = {r.vec_id: r for r in near_vectors(vectors.repartition(4)).collect()}
    assert len(got) == len(rows)
    good = {}
    for i, v, c, *_ in rows:
        if v and c is not None and None not in v and np.isfinite(v).all() and any(v):
            good[i] = (np.array(v), c)
    linked = []
    for a, (x, c) in good.items():
        for b, (y, d) in good.items():
            if a < b and c == d and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.93:
                linked.append((a, b))
    want = smallest_reachable([r[0] for r in rows], linked)
    counts = {i: sum(i in pair for pair in linked) for i in got}
    for i, r in got.items():
        assert (r.n_links, r.component_id, r.kept) == (counts[i], want[i], want[i] == i)
    assert near_vectors(vectors.limit(0)).count() == 0


def test_vectors_in_small_blocks_and_any_number_of_tasks(spark, monkeypatch):
    """Dense and loose groups over many blocks and levels: linked as a whole, compared, or skipped."""
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    monkeypatch.setattr(embeddings, "PARTS", 3)
    monkeypatch.setattr(embeddings, "PARTNERS", 4)
    draw = np.random.default_rng(14)
    centres = draw.normal(size=(5, 6))
    rows = []
    for k in range(500):
        c = int(draw.integers(5))
        x = centres[c] + draw.normal(size=6) * (0.002, 0.02, 0.15, 0.4, 1.0)[c]
        rows.append((k, x.tolist(), int(draw.integers(2))))
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    x = np.array([r[1] for r in rows])
    label = np.array([r[2] for r in rows])
    norms = np.linalg.norm(x, axis=1)
    near = ((x @ x.T) / np.outer(norms, norms) >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    want = smallest_reachable(range(500), list(zip(*np.nonzero(near))))
    for tasks in ("3", "32"):
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        try:
            got = {r.vec_id: r for r in near_vectors(vectors).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert {k: (r.n_links, r.component_id) for k, r in got.items()} == {k: (near[k].sum(), want[k]) for k in range(500)}


STAGES = dict(corpus_pipeline.STAGES)
SF = "/root/testdata/sf0.001"


def test_pipeline_stages_act_on_what_they_get(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = fresh_path(spark, f"test-{name}")
        stage(spark, rows, SF).write.parquet(path)
        before, rows = rows, spark.read.parquet(path)
        assert rows.columns == docs.columns
        if name == "quality":
            good = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id")
            assert rows.join(good, "doc_id").count() >= 0.98 * good.count()
            assert rows.count() < docs.count()
        elif name == "near_duplicates":
            texts = {r.doc_id: r.text for r in before.collect()}
            _, want = components_by_force(texts, corpus_pipeline.NEAR_PERCENT)
            assert {r.doc_id for r in rows.collect()} == {k for k in texts if want[k] == k}
        elif name == "decontamination":
            items = spark.read.parquet(f"{SF}/benchmark.parquet")
            assert find_benchmark_hits(rows, items).where("size(items) > 0").count() == 0
            clean = find_benchmark_hits(before, items).where("size(items) = 0").select("doc_id")
            assert rows.join(clean, "doc_id").count() == clean.count()
        elif name == "pii":
            old = {r.doc_id: r.text for r in before.collect()}
            for r in rows.collect():
                for value in re.findall(r"\S+@\S+\.com|\+1 \(\d{3}\) \d{3}-\d{4}", old[r.doc_id]):
                    assert value not in r.text
            assert rows.count() == before.count()
    pieces = corpus_pipeline.packed(spark, rows, SF)
    got = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).collect()
    assert all(r.n == r["all"] for r in got) and len(got) == rows.count()


def test_quality_stage_drops_bad_and_keeps_good_documents(spark):
    larger = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    kept = corpus_pipeline.good_quality(spark, docs, larger).join(spark.read.parquet(f"{larger}/labels.parquet"), "doc_id")
    counts = {r.quality: r["count"] for r in kept.groupBy("quality").count().collect()}
    labels = spark.read.parquet(f"{larger}/labels.parquet").groupBy("quality").count().collect()
    totals = {r.quality: r["count"] for r in labels}
    assert counts[1] >= 0.98 * totals[1] and counts.get(0, 0) <= 0.1 * totals[0]


def test_stages_take_empty_tables_nulls_and_clashing_names(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, gone long, kept_0 string"
    some = [(None, "plain words of a text that are kept as they are", "en", None, None, 1, "x"), (4, None, None, "s", 1, 2, "y")]
    some += [(4, None, None, "s", 1, 2, "y"), (5, "", "en", "s", 0, 3, "z")]
    for rows in (some, []):
        docs = spark.createDataFrame(rows, schema)
        out = corpus_pipeline.one_of_near_copies(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == (3 if rows else 0)
        out = corpus_pipeline.without_personal_data(spark, corpus_pipeline.without_benchmark(spark, out, SF), SF)
        assert out.columns == docs.columns and out.count() == (3 if rows else 0)
        assert corpus_pipeline.good_quality(spark, docs, SF).columns == docs.columns
        assert corpus_pipeline.packed(spark, out, SF).count() == (3 if rows else 0)


def test_near_copies_from_80_percent_on_are_one_document(spark):
    """Pairs on both sides of 80 and 85 percent, by brute force at 80."""
    draw = np.random.default_rng(5)
    texts, between = {}, 0
    for group in range(40):
        base = [f"g{group}v{k}" for k in range(int(draw.integers(150, 250)))]
        other = list(base)
        at = int(draw.integers(10, 40))
        other[at : at + int(draw.integers(5, 30))] = [f"g{group}n{k}" for k in range(int(draw.integers(5, 30)))]
        texts |= {2 * group: " ".join(base), 2 * group + 1: " ".join(other)}
    for k in range(0, 80, 2):
        a, b = shingles(texts[k]), shingles(texts[k + 1])
        between += 80 <= 100 * len(a & b) / len(a | b) < 85
    assert between >= 3
    given = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id is not null").select("doc_id", "text").collect()
    texts |= {1000 + r.doc_id: r.text for r in given}
    sets = {k: shingles(t) for k, t in texts.items()}
    holders = {}
    for k, own in sets.items():
        for shingle in own:
            holders.setdefault(shingle, []).append(k)
    pairs = {(a, b) for some in holders.values() for a in some for b in some if a < b}
    want = smallest_reachable(
        texts, [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    )
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.one_of_near_copies(spark, docs, SF).collect()}
    assert kept == {k for k in texts if want[k] == k}
