"""Near-duplicate documents: banded MinHash candidates, sequential Bayesian verification, exact confirmation.

Documents with equal shingle sets are one class first, so exact copies cost one row each. Candidates are
classes that share a band of the signature, and they are compared in two rounds:

1. every member of a band's bucket with the bucket's hub, the member that shares most buckets with others;
   the confirmed links give first components;
2. the pairs of a bucket whose members still lie in different components, block by block inside tasks, which
   return links that join components and no others.

So a bucket of many near copies costs rows per member, not per pair, and no pair of a bucket that could
connect two components is left out. A pair is compared batch by batch of its signature and dropped as soon as
the posterior probability that it reaches the threshold falls below ``miss``; what survives is confirmed on the
full shingle sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbtable.llm.components import connected_components
from plumbtable.llm.text import byte_class, flat, lower_ascii, mix, slices, span_hashes, window_hashes, word_spans
from plumbtable.session import settle

WIDTH = 5
BANDS, ROWS = 24, 5
BATCH = 20
#: Members of a bucket compared as one block; larger buckets are divided into blocks, compared two by two.
BLOCK = 512
#: Rows at most of the broadcast table that keeps texts without candidates out of a shuffle.
HASHES = 1 << 20
#: Pairs held at once by a task that compares blocks.
PAIRS = 50_000

_IN_WORD = ~byte_class((0x09, 0x0D), (0x20, 0x20))
_MIXERS = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64))
_A = (_MIXERS[: BANDS * ROWS] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (_MIXERS[BANDS * ROWS :] >> np.uint64(32)).astype(np.uint32)


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles; a shorter text is one shingle, an empty one has none."""
    buffer, offsets = flat(texts)
    buffer = lower_ascii(buffer)
    starts, ends, first = word_spans(buffer, offsets, _IN_WORD)
    words = span_hashes(buffer, starts, ends)
    windows = window_hashes(words, width)
    sets = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
        if hi - lo >= width:
            sets.append(np.unique(windows[lo : hi - width + 1]))
        else:
            sets.append(window_hashes(words[lo:hi], hi - lo) if hi > lo else np.empty(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 16-bit minima per set; the sets must not be empty."""
    out = np.empty((len(sets), BANDS * ROWS), np.uint16)
    at = 0
    while at < len(sets):
        stop, size = at, 0
        while stop < len(sets) and (stop == at or size + len(sets[stop]) <= 1 << 17):
            size += len(sets[stop])
            stop += 1
        lengths = [len(s) for s in sets[at:stop]]
        firsts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        x = (np.concatenate(sets[at:stop]) >> np.uint64(32)).astype(np.uint32)
        x ^= x >> np.uint32(15)
        for k in range(BANDS * ROWS):
            least = np.minimum.reduceat(x * _A[k] + _B[k], firsts)
            out[at:stop, k] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
        at = stop
    return out


def least_matches(threshold: float, miss: float, total: int = BANDS * ROWS, batch: int = BATCH) -> list[tuple[int, int]]:
    """``(hashes seen, fewest matches to go on)`` after each batch.

    With a uniform prior the similarity after m matches of k is Beta(m + 1, k - m + 1); its tail beyond the
    threshold is the sum of the binomial terms 0..m of k + 1 trials.
    """
    out = []
    for k in range(batch, total + 1, batch):
        tail, m = 0.0, 0
        while m <= k:
            tail += math.comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
            if tail >= miss:
                break
            m += 1
        out.append((k, m))
    return out


def survivors(left: np.ndarray, right: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Positions of the signature pairs that pass every batch."""
    at = np.arange(len(left))
    matches = np.zeros(len(left), np.int32)
    done = 0
    for k, least in bounds:
        if not len(at):
            break
        matches += (left[at, done:k] == right[at, done:k]).sum(axis=1, dtype=np.int32)
        go = matches >= least
        at, matches, done = at[go], matches[go], k
    return at


def _signature_array(column: pa.Array) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.uint16).reshape(-1, BANDS * ROWS)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sets = shingle_sets(part.column("text"))
            some = [s for s in sets if len(s)]
            rows = iter(signatures(some)) if some else iter(())
            digests, sketches = [], []
            for s in sets:
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sketches.append(next(rows).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(sketches, pa.binary()),
                ],
                ["id", "n_shingles", "digest", "signature"],
            )


def _posterior(bounds):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (_signature_array(batch.column(c)) for c in ("left", "right"))
                at = pa.array(survivors(left, right, bounds))
                yield pa.RecordBatch.from_arrays([batch.column(c).take(at) for c in ("a", "b")], ["a", "b"])

    return keep


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sets = [s.tobytes() for s in shingle_sets(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.binary())], ["node", "shingles"])


def _linked(x: bytes, y: bytes, percent: int) -> bool:
    """Whether two sets of sorted hashes reach the threshold."""
    small, large = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    common = int((large[at] == small).sum())
    return 100 * common >= percent * (len(small) + len(large) - common)


def _confirmed(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("left").to_pylist(), batch.column("right").to_pylist())
            keep = [_linked(x, y, percent) for x, y in pairs]
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], ["a", "b"])

    return confirm


def _sets_of(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, shingles`` of the nodes, written.

    The nodes' hash values modulo ``HASHES`` are a table of at most that many rows; it is broadcast to keep most
    other texts out of the shuffle. The join on the node decides.
    """
    value = lambda c: F.pmod(F.xxhash64(c), F.lit(HASHES)).cast("int")
    hashes = nodes.select(value("node").alias("hash")).distinct()
    near = texts.withColumn("hash", value("node")).join(F.broadcast(hashes), "hash", "left_semi").drop("hash")
    return settle(near.join(nodes, "node").mapInArrow(_full_sets, "node long, shingles binary"), "shingle-sets")


def _confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold, written."""
    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), texts)
    joined = (
        pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b")
        .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a")
        .select("a", "b", "left", "right")
    )
    return settle(joined.mapInArrow(_confirmed(percent), "a long, b long").distinct(), "links")


def _block_links(bounds, percent: int):
    """Links between components among rows ``key, i, j, node, block, component, band, signature, shingles``.

    The rows are sorted by the first three. A pair whose components were joined meanwhile is passed by, so at
    most one link less than there are components comes out of a run of groups.
    """

    def pairs(rows: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        changes = [rows[c][1:] != rows[c][:-1] for c in ("key", "i", "j")]
        group = np.flatnonzero(np.concatenate([[True], changes[0] | changes[1] | changes[2]]))
        sizes = np.diff(np.append(group, len(rows["key"])))
        # Every row with each later row of its group, a bounded number of pairs at a time.
        within = np.arange(len(rows["key"])) - np.repeat(group, sizes)
        later = np.repeat(sizes, sizes) - within - 1
        total = np.cumsum(later)
        at = 0
        while at < len(later):
            base = total[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(total, base + PAIRS, side="right")))
            count = later[at:stop]
            x = np.repeat(np.arange(at, stop), count)
            ends = np.cumsum(count)
            y = x + 1 + np.arange(len(x)) - np.repeat(ends - count, count)
            at = stop
            go = rows["component"][x] != rows["component"][y]
            go &= (rows["i"][x] == rows["j"][x]) | (rows["block"][x] != rows["block"][y])
            x, y = x[go], y[go]
            if not len(x):
                continue
            kept = survivors(rows["signature"][x], rows["signature"][y], bounds)
            x, y = x[kept], y[kept]
            # Of the bands that a pair shares, only the first one's bucket compares it.
            equal = rows["signature"][x] == rows["signature"][y]
            own = np.argmax(equal.reshape(-1, BANDS, ROWS).all(axis=2), axis=1) == rows["band"][x]
            order = np.argsort(-equal[own].sum(axis=1), kind="stable")
            yield x[own][order], y[own][order]

    def links(rows: dict) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(c: int) -> int:
            while (up := parent.get(c, c)) != c:
                parent[c] = c = parent.get(up, up)
            return c

        sets = rows["shingles"]
        for xs, ys in pairs(rows):
            found = []
            for x, y in zip(xs.tolist(), ys.tolist()):
                one, other = root(int(rows["component"][x])), root(int(rows["component"][y]))
                if one != other and _linked(sets[x], sets[y], percent):
                    parent[max(one, other)] = min(one, other)
                    found.append(sorted((int(rows["node"][x]), int(rows["node"][y]))))
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: batch.column(c).to_numpy() for c in ("key", "i", "j", "node", "block", "component", "band")}
            rows["signature"] = _signature_array(batch.column("signature"))
            rows["shingles"] = np.array([*batch.column("shingles").to_pylist(), None], object)[:-1]
            if held is not None:
                rows = {c: np.concatenate([held[c], rows[c]]) for c in rows}
            # The last group may go on in the next batch.
            last = [rows[c] == rows[c][-1] for c in ("key", "i", "j")]
            cut = len(last[0]) - int((last[0] & last[1] & last[2]).sum())
            held = {c: v[cut:] for c, v in rows.items()}
            if cut:
                yield from links({c: v[:cut] for c, v in rows.items()})
        if held is not None:
            yield from links(held)

    return run


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 85,
    miss: float = 1e-5,
) -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` for each row.

    Documents are linked where 100 * shared shingles >= ``percent`` * all their shingles; the component id is
    the smallest id reachable. Null and empty texts link with nothing and are their own component; a null id
    links with nothing, has no component and is kept; rows that share an id are one document; an empty table
    gives no rows; other columns are not read.
    """
    bounds = least_matches(percent / 100, miss)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketch = settle(
        rows.mapInArrow(_sketch, "id long, n_shingles long, digest binary, signature binary"), "sketches"
    )
    classes = settle(
        sketch.where("digest is not null and id is not null")
        .groupBy("digest")
        .agg(F.min("id").alias("node"), F.first("signature").alias("signature")),
        "classes",
    )
    size = 2 * ROWS
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.struct(
            b.alias("band"), F.xxhash64(b, F.substring("signature", b * size + 1, F.lit(size))).alias("key")
        ),
    )
    banded = classes.select("node", F.explode(keys).alias("of")).select("node", "of.band", "of.key")
    buckets = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = settle(banded.join(buckets, "key"), "members")
    shared = members.groupBy("node").agg(F.sum("n").alias("shared"))
    hubs = (
        members.join(shared, "node")
        .groupBy("key")
        .agg(F.max_by("node", F.struct("shared", -F.col("node"))).alias("hub"))
    )
    spokes = (
        members.join(hubs, "key")
        .where("node <> hub")
        .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
        .distinct()
    )
    marks = classes.select("node", "signature")
    near = (
        spokes.join(marks.select(F.col("node").alias("a"), F.col("signature").alias("left")), "a")
        .join(marks.select(F.col("node").alias("b"), F.col("signature").alias("right")), "b")
        .mapInArrow(_posterior(bounds), "a long, b long")
    )
    near = settle(near, "pairs")
    texts = rows.where("id is not null").select(F.col("id").alias("node"), "text")
    links = _confirm(near, texts, percent)
    first = connected_components(links)

    # Buckets whose members are not yet one component.
    placed = settle(
        members.join(first, "node", "left").withColumn("component", F.coalesce("component", "node")), "placed"
    )
    open_buckets = (
        placed.groupBy("key")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n"))
        .where("lo <> hi")
        .select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    blocked = (
        placed.select("key", "band", "node", "component")
        .join(open_buckets, "key")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "key",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "node",
            "block",
            "component",
            "band",
        )
    )
    blocked = settle(blocked, "open-buckets")
    sets = _sets_of(blocked.select("node").distinct(), texts)
    more = (
        blocked.join(marks, "node")
        .join(sets, "node")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
        .mapInArrow(_block_links(bounds, percent), "a long, b long")
    )
    links = links.unionByName(settle(more, "links"))
    final = settle(connected_components(links), "components")
    named = classes.select("digest", "node").join(final, "node", "left")
    named = named.select("digest", F.coalesce("component", "node").alias("component"))
    return (
        sketch.select("id", "n_shingles", "digest")
        .join(named, "digest", "left")
        .select(
            F.col("id").alias(id_col),
            "n_shingles",
            F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
        )
        .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
    )
