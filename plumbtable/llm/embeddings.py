"""Near-duplicate embeddings: an epsilon grid order join on leading principal dimensions.

Unit vectors are projected on ``dims`` leading principal directions, which never lengthens a distance, and sorted
by the grid cells of side epsilon they fall into, epsilon being the distance that belongs to the least cosine.
The sorted sequence of a label is cut into blocks of about ``BLOCK`` vectors, however many tasks sorted it, with
bounding boxes. Intervals of the sequence are joined recursively: a pair of intervals whose boxes are farther apart
than epsilon is skipped, any other is divided into the pairs of their parts, down to blocks. Blocks whose enclosing
balls lie within epsilon of each other are linked as a whole without their vectors; the vectors of the other
pairs are compared in double precision. Each block gives its own components first; a pair of blocks adds links only
where two components meet, and counts are summed per block before they leave the task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbtable.llm.components import connected_components
from plumbtable.session import settle

#: Vectors of a block, and on average of the sample that fixes the principal directions.
BLOCK = 512
SAMPLE = 20_000
#: Parts into which an interval of the sequence is divided, and partners of a block that one task compares with it.
PARTS = 16
PARTNERS = 256


def _directions(classes: DataFrame, dims: int) -> dict[int, np.ndarray]:
    """Leading principal directions for each vector length, from a hash sample of bounded size.

    They only set the order and the pruning; the join is exact whatever they are.
    """
    sizes = classes.groupBy("size").count().collect()  # one row per vector length
    out = {}
    for size, n in ((r["size"], r["count"]) for r in sizes):
        share = max(1, -(-n // SAMPLE))
        picked = classes.where((F.col("size") == size) & (F.pmod(F.xxhash64("node"), F.lit(share)) == 0))
        rows = [r["embedding"] for r in picked.select("embedding").limit(2 * SAMPLE).collect()]
        x = np.array(rows, np.float64).reshape(-1, size)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        x -= x.mean(axis=0) if len(x) else 0
        values, vectors = np.linalg.eigh(x.T @ x)
        out[size] = np.ascontiguousarray(vectors[:, np.argsort(-values)[:dims]])
    return out


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _projector(directions: dict[int, np.ndarray], dims: int, eps: float):
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                own = batch.filter(pa.array(sizes == size))
                x = _matrix(own.column("embedding"), size)
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                p = np.zeros((len(x), dims))
                p[:, : directions[size].shape[1]] = x @ directions[size]
                cells = np.floor(p / eps).astype(np.int64)
                arrays = [*own.columns, pa.array(list(p)), pa.array(list(cells))]
                yield pa.RecordBatch.from_arrays(arrays, [*own.schema.names, "place", "cells"])

    return project


_PIECE = "label string, size int, piece long, n long, lo array<double>, hi array<double>, nodes array<long>, copies array<long>, vectors binary"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of at most ``BLOCK`` vectors of one label and length, in the order of the sequence; runs end with the task."""
    task, made = TaskContext.get().partitionId(), 0
    held: list[dict] = []

    def piece() -> dict:
        nonlocal made
        made += 1
        place = np.array([r["place"] for r in held])
        return {
            "label": held[0]["label"],
            "size": held[0]["size"],
            "piece": task << 32 | made,
            "n": len(held),
            "lo": place.min(axis=0).tolist(),
            "hi": place.max(axis=0).tolist(),
            "nodes": [r["node"] for r in held],
            "copies": [r["copies"] for r in held],
            "vectors": np.array([r["embedding"] for r in held], np.float64).tobytes(),
        }

    numbers = pa.list_(pa.int64())
    schema = pa.schema(
        [
            ("label", pa.string()),
            ("size", pa.int32()),
            ("piece", pa.int64()),
            ("n", pa.int64()),
            ("lo", pa.list_(pa.float64())),
            ("hi", pa.list_(pa.float64())),
            ("nodes", numbers),
            ("copies", numbers),
            ("vectors", pa.binary()),
        ]
    )
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if held and (len(held) == BLOCK or (held[0]["label"], held[0]["size"]) != (row["label"], row["size"])):
                done.append(piece())
                held = []
            held.append(row)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
    if held:
        yield pa.RecordBatch.from_pylist([piece()], schema)


def _rows(vectors: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and their lengths."""
    x = np.frombuffer(vectors, np.float64).reshape(n, -1)
    return x, np.linalg.norm(x, axis=1)


def _near(a: tuple, b: tuple, least: float) -> np.ndarray:
    return (a[0] @ b[0].T) / np.outer(a[1], b[1]) >= least


class _Components:
    """Components of the nodes met so far; ``join`` tells whether two were apart."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, node: int) -> int:
        path = []
        while (above := self.up.get(node, node)) != node:
            path.append(node)
            node = above
        for k in path:
            self.up[k] = node
        return node

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


_BLOCK = (
    "label string, size int, block long, lo array<double>, hi array<double>, centre array<double>, radius double, "
    "total long, nodes array<long>, copies array<long>, roots array<long>, links array<long>, vectors binary"
)


def _finisher(least: float):
    """Blocks put together from pieces, with their ball, their own links and their own components."""

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pieces = sorted(row["pieces"], key=lambda p: p["piece"])
                nodes = [n for p in pieces for n in p["nodes"]]
                copies = np.array([n for p in pieces for n in p["copies"]], np.int64)
                vectors = b"".join(p["vectors"] for p in pieces)
                own = _rows(vectors, len(nodes))
                x = own[0] / own[1][:, None]
                centre = x.mean(axis=0)
                near = _near(own, own, least)
                np.fill_diagonal(near, False)
                root = np.array(nodes)
                while True:  # smallest node that the block's links reach
                    low = np.minimum(root, np.where(near, root, np.iinfo(np.int64).max).min(axis=1))
                    if (low == root).all():
                        break
                    root = low
                made = {
                    "label": row["label"], "size": row["size"], "block": row["block"],
                    "lo": np.min([p["lo"] for p in pieces], axis=0).tolist(),
                    "hi": np.max([p["hi"] for p in pieces], axis=0).tolist(),
                    "centre": centre.tolist(), "radius": float(np.linalg.norm(x - centre, axis=1).max()),
                    "total": int(copies.sum()), "nodes": nodes, "copies": copies.tolist(), "roots": root.tolist(),
                    "links": (near @ copies).tolist(), "vectors": vectors,
                }
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], f.type) for v, f in zip(made.values(), _block_schema())], names=list(made)
                )

    return finish


def _block_schema() -> pa.Schema:
    reals, numbers = pa.list_(pa.float64()), pa.list_(pa.int64())
    return pa.schema(
        [
            ("label", pa.string()), ("size", pa.int32()), ("block", pa.int64()), ("lo", reals), ("hi", reals),
            ("centre", reals), ("radius", pa.float64()), ("total", pa.int64()), ("nodes", numbers),
            ("copies", numbers), ("roots", numbers), ("links", numbers), ("vectors", pa.binary()),
        ]
    )


def _apart(a: str, b: str):
    """Squared distance of two boxes."""
    gaps = F.transform(
        F.arrays_zip(F.col(f"{a}.lo").alias("al"), F.col(f"{a}.hi").alias("ah"), F.col(f"{b}.lo").alias("bl"), F.col(f"{b}.hi").alias("bh")),
        lambda z: F.greatest(z["al"] - z["bh"], z["bl"] - z["ah"], F.lit(0.0)),
    )
    return F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)


def _block_pairs(boxes: DataFrame, dims: int, eps: float) -> DataFrame:
    """``label, size, first, second`` with first before or equal to second: blocks whose boxes are within eps.

    An interval of level k holds the blocks of one number without its last k digits to the base ``PARTS``. The join
    starts with the whole sequence and goes on with the parts of what is left.
    """
    reach = eps * (1 + 1e-9)
    most = boxes.agg(F.max("block")).first()[0] or 0
    level = 0
    while PARTS ** (level + 1) <= most:
        level += 1
    digits = lambda k: F.floor(F.col("block") / PARTS**k).cast("long")
    pairs = boxes.select("label", "size", F.lit(0).cast("long").alias("first"), F.lit(0).cast("long").alias("second")).distinct()
    edge = lambda f, c: F.array(*[f(F.col(c)[k]) for k in range(dims)])
    while level >= 0:
        parts = boxes.groupBy("label", "size", digits(level).alias("key")).agg(edge(F.min, "lo").alias("lo"), edge(F.max, "hi").alias("hi"))
        whole = F.floor(F.col("key") / PARTS).cast("long")
        box = F.struct("key", "lo", "hi")
        a = parts.select("label", "size", whole.alias("first"), box.alias("a"))
        b = parts.select("label", "size", whole.alias("second"), box.alias("b"))
        pairs = settle(
            pairs.join(a, ["label", "size", "first"])
            .join(b, ["label", "size", "second"])
            .where((F.col("first") != F.col("second")) | (F.col("a.key") <= F.col("b.key")))
            .where(_apart("a", "b") <= reach * reach)
            .select("label", "size", F.col("a.key").alias("first"), F.col("b.key").alias("second")),
            "vector-intervals",
        )
        level -= 1
    return pairs


_LOAD = ["nodes", "copies", "roots", "vectors"]


def _comparer(least: float):
    """Each block's vectors against those of its partners, which follow it; sums and joining links once per block."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, key = None, None
        counts, parts, edges = None, None, []

        def record():
            some = np.flatnonzero(counts)
            nodes = [own["nodes"][k] for k in some.tolist()]
            rows = [(n, c, None) for n, c in zip(nodes, counts[some].tolist())] + [(a, 0, b) for a, b in edges]
            columns = list(zip(*rows)) if rows else [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "links", "root"])

        for batch in batches:
            for row in batch.to_pylist():
                if (row["first"], row["salt"], row["label"], row["size"]) != key:
                    if own is not None:
                        yield record()
                    key, own = (row["first"], row["salt"], row["label"], row["size"]), row
                    x = _rows(row["vectors"], len(row["nodes"]))
                    counts, parts, edges = np.zeros(len(row["nodes"]), np.int64), _Components(), []
                    roots, number = np.unique(row["roots"], return_inverse=True)
                    continue
                near = _near(x, _rows(row["vectors"], len(row["nodes"])), least)
                counts += near @ np.array(row["copies"], np.int64)
                if row["second"] > row["first"]:
                    others, other = np.unique(row["roots"], return_inverse=True)
                    i, j = np.nonzero(near)
                    met = np.unique(number[i] * len(others) + other[j])
                    for a, b in zip(roots[met // len(others)].tolist(), others[met % len(others)].tolist()):
                        if parts.join(a, b):
                            edges.append((a, b))
        if own is not None:
            yield record()

    return compare


def _links(blocks: DataFrame, pairs: DataFrame, least: float, eps: float) -> DataFrame:
    """``node, links, root``: links of vectors to other blocks, and edges that join the blocks' components."""
    on = ["label", "size"]
    light = blocks.select(*on, "block", "centre", "radius", "total", F.array_distinct("roots").alias("roots"))
    ball = lambda n: light.select(*on, F.col("block").alias(n), *[F.col(c).alias(f"{n}_{c}") for c in light.columns[3:]])
    other = pairs.where("first < second").join(ball("first"), [*on, "first"]).join(ball("second"), [*on, "second"])
    gap = F.sqrt(
        F.aggregate(F.zip_with("first_centre", "second_centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d)
    )
    known = settle(
        other.select(
            *on, "first", "second", "first_total", "second_total", "first_roots", "second_roots",
            (gap + F.col("first_radius") + F.col("second_radius") <= eps * (1 - 1e-9)).alias("whole"),
        ),
        "vector-pairs",
    )
    whole = known.where("whole")
    more = whole.select(*on, F.col("first").alias("block"), F.col("second_total").alias("links")).unionByName(
        whole.select(*on, F.col("second").alias("block"), F.col("first_total").alias("links"))
    )
    more = more.groupBy(*on, "block").agg(F.sum("links").alias("links"))
    counted = blocks.select(*on, "block", F.explode("nodes").alias("node")).join(more, [*on, "block"])
    counted = counted.select("node", "links", F.lit(None).cast("long").alias("root"))
    # All of either block are linked with all of the other: one node joins the components of both.
    joined = whole.select(F.get("second_roots", F.lit(0)).alias("root"), F.explode(F.concat("first_roots", "second_roots")).alias("node"))
    joined = joined.distinct().select("node", F.lit(0).cast("long").alias("links"), "root")

    part = known.where("not whole").select(*on, "first", "second")
    both = part.unionByName(part.select(*on, F.col("second").alias("first"), F.col("first").alias("second")))
    both = both.withColumn("salt", F.floor(F.col("second") / PARTNERS).cast("long"))
    load = blocks.select(*on, F.col("block").alias("at"), *_LOAD)
    heads = both.select(*on, "first", "salt").distinct().withColumn("second", F.lit(-1).cast("long")).withColumn("at", F.col("first"))
    rows = heads.unionByName(both.withColumn("at", F.col("second"))).join(load, [*on, "at"])
    rows = rows.repartition(*on, "first", "salt").sortWithinPartitions(*on, "first", "salt", "second")
    compared = rows.drop("at").mapInArrow(_comparer(least), "node long, links long, root long")
    return counted.unionByName(joined).unionByName(compared)


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    least: float = 0.93,
    dims: int = 8,
) -> DataFrame:
    """``id_col, n_links, component_id, kept`` for each row.

    Vectors of one label and length are linked from cosine ``least`` on, ``least`` above 0. Rows with equal
    vectors are one class that is compared once; they count as links of each other. A null label or vector, a
    vector that is empty, zero or has a null or non-finite component links with nothing and is its own
    component. A null id links with nothing, has no component and is kept; an empty table gives no rows; other
    columns are not read.
    """
    eps = math.sqrt(2 - 2 * least)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("embedding"),
    )
    sound = F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0)
    sound &= F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    sound &= F.exists("embedding", lambda v: v != 0)
    text = F.concat_ws(",", F.transform("embedding", lambda v: v.cast("string")))
    rows = settle(
        rows.withColumn("digest", F.when(F.coalesce(sound, F.lit(False)), F.sha2(F.concat_ws("|", "label", text), 256))),
        "vectors",
    )
    classes = settle(
        rows.where("digest is not null")
        .groupBy("digest")
        .agg(
            F.min("id").alias("node"),
            F.count(F.lit(1)).alias("copies"),
            F.first("label").alias("label"),
            F.first("embedding").alias("embedding"),
        )
        .withColumn("size", F.size("embedding")),
        "vector-classes",
    )
    directions = _directions(classes, dims)
    columns = ["node", "copies", "label", "size", "embedding"]
    kinds = "node long, copies long, label string, size int, embedding array<double>"
    placed = classes.select(*columns).mapInArrow(
        _projector(directions, dims, eps), f"{kinds}, place array<double>, cells array<long>"
    )
    order = ["label", "size", "cells", "node"]
    sequence = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = settle(sequence.mapInArrow(_pieces, _PIECE), "vector-pieces")
    # Pieces are short where many tasks sorted few vectors; a block takes those that start in its share of the sequence.
    before = Window.partitionBy("label", "size").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    numbers = pieces.select("label", "size", "piece", "n").withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    numbers = numbers.select("piece", F.floor(F.col("start") / BLOCK).cast("long").alias("block"))
    packed = F.collect_list(F.struct("piece", "lo", "hi", "nodes", "copies", "vectors")).alias("pieces")
    blocks = settle(
        pieces.join(numbers, "piece").groupBy("label", "size", "block").agg(packed).mapInArrow(_finisher(least), _BLOCK),
        "vector-blocks",
    )
    pairs = _block_pairs(blocks.select("label", "size", "block", "lo", "hi"), dims, eps)
    inner = blocks.select(F.inline(F.arrays_zip(F.col("nodes").alias("node"), "links", F.col("roots").alias("root"))))
    found = settle(inner.unionByName(_links(blocks, pairs, least, eps)), "vector-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("root is not null").select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = (
        classes.select("digest", "node", "copies")
        .join(counts, "node", "left")
        .join(parts, "node", "left")
        .select(
            "digest",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    return (
        rows.select("id", "digest")
        .join(named, "digest", "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
        .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
    )
