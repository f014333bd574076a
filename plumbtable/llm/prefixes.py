"""Prefix trie of conversations that share a base conversation's head, by fingerprints that compose.

A sequence of turns has the fingerprint sum t_i r^(d-i) modulo the prime 2^126 - 137, where t_i is a digest of turn i.
Fingerprints of neighbouring sequences compose: F(xy) = F(x) r^|y| + F(y). So the first d turns of a rebuilt
conversation, head of the base and own rest, have the fingerprint P(j) + (B - H) r^(j-h) from the running
fingerprint P(j) of its own turns, that of its own head H and that of the base's head B: no rebuilt text is made.

Nodes are groups of equal depth and fingerprint. Each member carries a reference to its last turn, digest bits that
the fingerprint does not use, and its parent's fingerprint; a group in which they differ ends the job. Sums over
subtrees come without a walk over depths: a node counts with its smallest member, so running sums along each
conversation, from its last turn back, added up by node give every subtree's total.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbtable.llm.text import SPACED_WORDS, flat, word_spans
from plumbtable.session import settle

PRIME = (1 << 126) - 137
BASE = int.from_bytes(hashlib.sha256(b"prefix fingerprints").digest()[:15], "big")
_LOW = (1 << 63) - 1
#: Turns of a conversation summed by one task, and member ids joined in one text.
BLOCK = 4096


def _halves(value: int) -> tuple[int, int]:
    return value >> 63, value & _LOW


def _whole(high: int, low: int) -> int:
    return (high << 63) | low


def _turn(role: str, text: str) -> tuple[int, int, int]:
    """The turn's value in fingerprints, and two numbers of further digest bits that tell turns apart."""
    name = role.encode()
    digest = hashlib.sha256(b"%d:%s%s" % (len(name), name, text.encode())).digest()
    first, second = (int.from_bytes(digest[k : k + 8], "big", signed=True) for k in (16, 24))
    return int.from_bytes(digest[:16], "big") % PRIME, first, second


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Position and running fingerprint of each turn within its conversation and partition, in order."""
    conv = position = value = None
    for batch in batches:
        buffer, offsets = flat(batch.column("text"))
        words = np.diff(word_spans(buffer, offsets, SPACED_WORDS)[2])
        made = []
        convs, roles, texts = (batch.column(c).to_pylist() for c in ("conv", "role", "text"))
        for own, role, text in zip(convs, roles, texts):
            if own != conv:
                conv, position, value = own, 0, 0
            turn, first, second = _turn(role, text)
            position, value = position + 1, (value * BASE + turn) % PRIME
            made.append((position, *_halves(value), first, second))
        columns = [pa.array(c, pa.int64()) for c in (zip(*made) if made else [[]] * 5)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("part"), *columns, pa.array(words)],
            ["conv", "part", "i", "f1", "f2", "r1", "r2", "words"],
        )


def _shifts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What comes before each part of a conversation: its turns and their fingerprint."""
    for batch in batches:
        out = []
        for conv, parts in zip(*(batch.column(c).to_pylist() for c in ("conv", "parts"))):
            before, value = 0, 0
            for part in sorted(parts, key=lambda p: p["part"]):
                out.append((conv, part["part"], before, *_halves(value)))
                before += part["i"]
                value = (value * pow(BASE, part["i"], PRIME) + _whole(part["f1"], part["f2"])) % PRIME
        columns = list(zip(*out)) if out else [[]] * 5
        kinds = (batch.schema.field("conv").type, pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["conv", "part", "before", "b1", "b2"]
        )


def _composed(power: str):
    """Adds ``(b1, b2) r^power`` to the fingerprint ``(f1, f2)`` of each row, and drops those columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {c: batch.column(c).to_pylist() for c in ("f1", "f2", "b1", "b2", power)}
            made = [
                _halves((_whole(f1, f2) + _whole(b1, b2) * pow(BASE, n, PRIME)) % PRIME) if b1 or b2 else (f1, f2)
                for f1, f2, b1, b2, n in zip(*rows.values())
            ]
            columns = {c: batch.column(c) for c in batch.schema.names if c not in ("b1", "b2")}
            columns["f1"], columns["f2"] = (pa.array([m[k] for m in made], pa.int64()) for k in (0, 1))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _without(df: DataFrame, *gone: str) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema if f.name not in gone)


def _turns(conversations: DataFrame, names: tuple[str, str, str, str]) -> DataFrame:
    """``conv, i, f1, f2, r1, r2, words``: every turn with the fingerprint of its conversation up to there.

    Turns are sorted by ranges, so that one long conversation spreads over tasks; the parts' fingerprints compose.
    """
    conv, turn, role, text = names
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    kind = rows.schema["conv"].dataType.simpleString()
    fields = "i long, f1 long, f2 long, r1 long, r2 long, words long"
    rows = rows.select("conv", "part", "role", "text")
    scanned = settle(rows.mapInArrow(_scan, f"conv {kind}, part int, {fields}"), "turns")
    last = F.max(F.struct("i", "f1", "f2")).alias("last")
    parts = scanned.groupBy("conv", "part").agg(last).groupBy("conv")
    # A conversation has at most as many parts as the table has partitions.
    listed = parts.agg(F.collect_list(F.struct("part", "last.i", "last.f1", "last.f2")).alias("parts"))
    shifts = listed.mapInArrow(_shifts, f"conv {kind}, part int, before long, b1 long, b2 long")
    moved = scanned.join(shifts, ["conv", "part"]).select(
        "conv", (F.col("before") + F.col("i")).alias("n"), "i", "f1", "f2", "r1", "r2", "words", "b1", "b2"
    )
    return moved.mapInArrow(_composed("i"), _without(moved, "b1", "b2")).drop("i").withColumnRenamed("n", "i")


def rebuilt_prefixes(
    conversations: DataFrame,
    base,
    head,
    longest_head: int,
    names: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text"),
) -> DataFrame:
    """``conv, d, f1, f2, p1, p2, r1, r2, words, ends``: a row per rebuilt conversation and depth from 1, and
    one of depth 0 for each.

    A conversation is rebuilt from the first ``head`` turns of the conversation ``base`` and its own turns after
    its first ``head``; both are expressions on ``conv``, and ``head`` is at most ``longest_head``. ``f`` is the
    fingerprint of the first ``d`` turns, ``p`` that of one turn less, ``r`` refers to the last turn. Turns are in
    order of their number (null first), then role and text; a null role or text is empty. Rows without a
    conversation belong to none and are left out; repeated rows are turns of their own; other columns are not read.
    """
    turns = settle(_turns(conversations, names), "turns")
    heads = turns.groupBy("conv").agg(
        F.max("i").alias("n"),
        F.array_sort(
            F.filter(
                F.collect_list(F.when(F.col("i") <= longest_head, F.struct("i", "f1", "f2", "r1", "r2", "words"))),
                lambda t: t.isNotNull(),
            )
        ).alias("head"),
    )
    heads = settle(heads, "heads")
    zero = F.struct(F.lit(0).cast("long").alias("f1"), F.lit(0).cast("long").alias("f2"))

    def at(turns, n):
        """Fingerprint after the first ``n`` of ``turns``."""
        found = F.get(turns, (n - 1).cast("int"))
        return F.when(n > 0, F.struct(found["f1"].alias("f1"), found["f2"].alias("f2"))).otherwise(zero)

    given = heads.select(F.col("conv").alias("of"), F.col("n").alias("base_n"), F.col("head").alias("base_head"))
    plans = heads.withColumn("h", head.cast("long")).withColumn("of", base).join(given, "of", "left")
    plans = plans.withColumn("k", F.least("h", F.coalesce("base_n", F.lit(0)))).withColumn("own", F.least("h", "n"))
    plans = plans.select(
        "conv", "n", "h", "k", "base_head", at(F.col("base_head"), F.col("k")).alias("b"), at(F.col("head"), F.col("own")).alias("o")
    )
    plans = plans.withColumn("length", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    plans = settle(plans, "plans")

    own = turns.join(plans.drop("n", "base_head"), "conv").where("i > h")
    own = own.select(
        "conv", (F.col("k") + F.col("i") - F.col("h")).alias("d"), (F.col("i") - F.col("h")).alias("later"),
        "f1", "f2", "r1", "r2", "words", "length", "b", "o",
    )
    own = own.mapInArrow(_exchange_heads, _without(own, "b", "o", "later"))
    taken = plans.select(
        "conv", "length", F.explode(F.slice("base_head", 1, F.greatest("k", F.lit(0)).cast("int"))).alias("t")
    ).select("conv", F.col("t.i").alias("d"), "t.f1", "t.f2", "t.r1", "t.r2", "t.words", "length")
    nothing = F.lit(0).cast("long")
    root = plans.select("conv", nothing.alias("d"), *[nothing.alias(c) for c in ("f1", "f2", "r1", "r2", "words")], "length")
    rows = settle(own.unionByName(taken).unionByName(root), "prefixes")
    before = rows.select("conv", (F.col("d") + 1).alias("d"), F.col("f1").alias("p1"), F.col("f2").alias("p2"))
    rows = rows.join(before, ["conv", "d"], "left")
    return rows.withColumn("ends", F.col("d") == F.col("length")).drop("length")


def _exchange_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows' fingerprints with the base's head in place of their own: P + (B - H) r^later."""
    for batch in batches:
        rows = [batch.column(c).to_pylist() for c in ("f1", "f2", "b", "o", "later")]
        made = []
        for f1, f2, b, o, later in zip(*rows):
            more = _whole(b["f1"], b["f2"]) - _whole(o["f1"], o["f2"])
            made.append(_halves((_whole(f1, f2) + more * pow(BASE, later, PRIME)) % PRIME) if more else (f1, f2))
        columns = {c: batch.column(c) for c in batch.schema.names if c not in ("b", "o", "later")}
        columns["f1"], columns["f2"] = (pa.array([m[k] for m in made], pa.int64()) for k in (0, 1))
        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


NODE = ["d", "f1", "f2"]


def _later_sums(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Sums of ``columns`` over a conversation's rows of this depth and deeper, in blocks of ``BLOCK`` depths."""
    rows = rows.withColumn("block", F.floor(F.col("d") / BLOCK))
    deeper = Window.partitionBy("conv", "block").orderBy(F.col("d").desc())
    rows = rows.select("*", *[F.sum(c).over(deeper).alias(f"{c}_here") for c in columns])
    blocks = rows.groupBy("conv", "block").agg(*[F.sum(c).alias(c) for c in columns])
    after = Window.partitionBy("conv").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.select("conv", "block", *[F.coalesce(F.sum(c).over(after), F.lit(0)).alias(f"{c}_after") for c in columns])
    joined = rows.drop(*columns).join(totals.where(" or ".join(f"{c}_after <> 0" for c in columns)), ["conv", "block"], "left")
    later = [(F.col(f"{c}_here") + F.coalesce(f"{c}_after", F.lit(0))).alias(c) for c in columns]
    return joined.select(*[c for c in rows.columns if c in NODE], *later)


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive ids of one node as one comma-joined text of at most ``BLOCK`` of them, with the first."""
    node, held = None, []

    def text():
        return (*node, held[0], ",".join(map(str, held)))

    for batch in batches:
        out = []
        for *key, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv"))):
            if held and (key != node or len(held) == BLOCK):
                out.append(text())
                held = []
            node = key
            held.append(conv)
        yield _records(out, batch.schema.field("conv").type)
    if held:
        yield _records([text()], pa.array(held).type)


def _records(rows: list, conv: pa.DataType) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), conv, pa.string())
    columns = list(zip(*rows)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*NODE, "conv", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's texts in order, joined by commas; a text is held no longer than its turn."""
    node, digest = None, None

    def record(rows):
        columns = list(zip(*rows)) if rows else [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*NODE, "ends_sha256"])

    for batch in batches:
        out = []
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
            if key != node:
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield record(out)
    if node is not None:
        yield record([(*node, digest.hexdigest())])


def _ends(rows: DataFrame) -> DataFrame:
    """Digest of the ids that end at each node, in order; ids are joined block by block, then hashed in order."""
    ended = rows.where("ends").select(*NODE, "conv")
    kind = ended.schema["conv"].dataType.simpleString()
    keys = "d long, f1 long, f2 long"
    ordered = ended.repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv")
    texts = ordered.mapInArrow(_joined_ids, f"{keys}, conv {kind}, ids string")
    texts = texts.repartition(*NODE).sortWithinPartitions(*NODE, "conv")
    return texts.mapInArrow(_digests, f"{keys}, ends_sha256 string")


def prefix_trie(prefixes: DataFrame) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` per trie node.

    Takes the rows of ``rebuilt_prefixes``. ``conv_id`` is the node's smallest member, ``saved_tokens`` the words
    that its subtree would hold again if no prefix were shared, ``ends_sha256`` the SHA-256 of the ids of its
    members without further turns. No conversations give no nodes, not even the root. Members of a node whose
    last turns or parents differ, equal fingerprints of different prefixes, end the job with an error.
    """
    rows = settle(prefixes, "prefixes")
    same = [F.min(c) == F.max(c) for c in ("r1", "r2", "p1", "p2")]
    verified = F.coalesce(same[0] & same[1] & same[2] & same[3], F.lit(True))
    wrong = F.raise_error(F.lit("equal fingerprints of different conversation prefixes")).cast("long")
    nodes = rows.groupBy(*NODE).agg(
        F.min("conv").alias("first"),
        F.when(verified, F.count(F.lit(1))).otherwise(wrong).alias("n_convs"),
        F.min("p1").alias("p1"),
        F.min("p2").alias("p2"),
        F.min("words").alias("words"),
    )
    nodes = settle(nodes, "nodes")
    children = nodes.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("p1").alias("f1"), F.col("p2").alias("f2"))
    nodes = nodes.join(children.agg(F.count(F.lit(1)).alias("n_children")), NODE, "left")
    nodes = settle(nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    value = ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")
    counted = nodes.select(
        F.col("first").alias("conv"), "d", value, F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves")
    )
    sums = ["saved_tokens", "n_leaves"]
    paths = rows.select("conv", *NODE).join(counted, ["conv", "d"], "left").fillna(0, sums)
    totals = _later_sums(paths, sums).groupBy(*NODE).agg(*[F.sum(c).alias(c) for c in sums])
    parents = nodes.select((F.col("d") + 1).alias("d"), F.col("f1").alias("p1"), F.col("f2").alias("p2"), F.col("first").alias("parent"))
    whole = nodes.join(totals, NODE).join(_ends(rows), NODE, "left").join(parents, ["d", "p1", "p2"], "left")
    return whole.select(
        F.col("first").alias("conv_id"),
        F.col("d").alias("depth"),
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
