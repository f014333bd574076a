"""Rows of one large JSON document from several tasks: ``[row, ...]`` or ``{"rows": [row, ...], ...}``.

The text is read in pieces that end with a closing brace. What a piece does to the two facts needed at its end, inside
a string or not and how deep the brackets are nested, is told for either state at its start, so it needs no knowledge
of what came before. Summed up per split, and over the splits of a file, that gives state and depth at the start of
every split, and where the list under ``rows`` begins. With that index each task cuts its rows out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbtable.session import fresh_path, settle
from plumbtable.sources.records import CHANGE, END, INSIDE, KEEP, MIDDLE, OUTSIDE, START, WHOLE, _splits_of, split_states, states

_REST = r'(?:[^"\\]++|\\.)*+'
_STRING = rf'"{_REST}"'
FROM_OUTSIDE = rf'(?s)\A(?:[^"]++|{_STRING})*+"{_REST}\z'
FROM_INSIDE = rf'(?s)\A{_REST}(?:\z|"(?:[^"]++|{_STRING})*+"{_REST}\z)'
#: Where the list under ``rows`` may begin.
ROWS = re.compile(rb'"rows"\s*:\s*\[')
_TOKEN = re.compile(rb'"(?:[^"\\]|\\.)*+"?|[\[\]{}]', re.DOTALL)
_UNTIL_QUOTE = re.compile(rb'(?:[^"\\]|\\.)*+"', re.DOTALL)
_PIECE = "file string, block long, place int, record string"


def piece_step(piece):
    """``KEEP``, ``OUTSIDE``, ``INSIDE`` or ``CHANGE``: what a piece does to being inside a string."""
    outside, inside = piece.rlike(FROM_OUTSIDE), piece.rlike(FROM_INSIDE)
    quoted = (
        F.when(outside & inside, F.lit(INSIDE)).when(outside, F.lit(CHANGE)).when(inside, F.lit(KEEP)).otherwise(F.lit(OUTSIDE))
    )
    return F.when(piece.contains('"'), quoted).otherwise(F.lit(KEEP)).cast("int")


def depths(piece: bytes, inside: bool) -> tuple[int, int, int | None, int]:
    """Change of depth by a piece and its closing brace, the least depth on the way, the depth before the last
    ``"rows": [`` outside strings (None if there is none), and the least depth after it."""
    at = 0
    if inside:
        found = _UNTIL_QUOTE.match(piece)
        if not found:
            return 0, 0, None, 0
        at = found.end()
    starts = {m.end() - 1: m.start() for m in ROWS.finditer(piece, at)} if b'"rows"' in piece else {}
    depth = least = 0
    rows, after, closed = None, 0, True
    for m in _TOKEN.finditer(piece, at):
        token = m.group()
        if token in (b"{", b"["):
            if m.start() in starts:
                rows, after = depth, depth + 1
            depth += 1
        elif token in (b"}", b"]"):
            depth -= 1
            least, after = min(least, depth), min(after, depth)
        elif len(token) == 1 or not token.endswith(b'"') or _open(token):
            closed = False
    if closed:
        depth -= 1
        least, after = min(least, depth), min(after, depth)
    return depth, least, rows, after


def _open(token: bytes) -> bool:
    """Whether the string's last quote is escaped."""
    body = token[1:-1]
    return (len(body) - len(body.rstrip(b"\\"))) % 2 == 1


def _split_depths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: change of depth, least depth, the depths before ``"rows": [`` with the least depths after, first byte."""
    split, made, inside = None, None, False

    def record():
        shape = pa.list_(pa.struct([("depth", pa.int64()), ("least", pa.int64())]))
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), shape, pa.string())
        values = (*split, made["change"], made["least"], made["rows"], made["first"])
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], ["file", "block", "change", "least", "rows", "first"])

    for batch in batches:
        steps = batch.column("step").to_numpy()
        begins = batch.column("inside").to_numpy(zero_copy_only=False)
        for file, block, a, b in _splits_of(batch):
            if (file, block) != split:
                if split is not None:
                    yield record()
                split, inside = (file, block), bool(begins[a])
                made = {"change": 0, "least": 0, "rows": [], "first": None}
            after = states(steps[a:b], inside)
            for piece, quoted in zip(batch.column("value").slice(a, b - a).to_pylist(), [inside, *after[:-1].tolist()]):
                made["first"] = made["first"] or piece.lstrip()[:1]
                change, least, rows, low = depths(piece.encode(), quoted)
                for r in made["rows"]:
                    r["least"] = min(r["least"], made["change"] + least)
                if rows is not None:
                    made["rows"].append({"depth": made["change"] + rows, "least": made["change"] + low})
                    # Only a list below the document itself counts, so the deepest of many are of no use.
                    low_depth = min(r["depth"] for r in made["rows"])
                    made["rows"] = [r for r in made["rows"] if r["depth"] == low_depth]
                made["least"] = min(made["least"], made["change"] + least)
                made["change"] += change
            inside = bool(after[-1])
    if split is not None:
        yield record()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each split, and the pieces of those that cross its borders."""
    split, inside, depth, level, listed, held, place = None, False, 0, 1, False, [], WHOLE
    out: list[tuple] = []

    def left():
        if held:
            out.append((*split, MIDDLE if place == END else START, "".join(held)))

    def record(rows):
        columns = list(zip(*rows)) if rows else [[]] * 4
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "block", "place", "record"])

    for batch in batches:
        steps = batch.column("step").to_numpy()
        about = {c: batch.column(c) for c in ("inside", "depth", "level", "listed")}
        out = []
        for file, block, a, b in _splits_of(batch):
            if (file, block) != split:
                if split is not None:
                    left()
                split, held = (file, block), []
                inside, depth, level, listed = (about[c][a].as_py() for c in ("inside", "depth", "level", "listed"))
                place = END if listed and depth > level else WHOLE
            after = states(steps[a:b], inside).tolist()
            for piece, quoted, ends in zip(batch.column("value").slice(a, b - a).to_pylist(), [inside, *after[:-1]], after):
                data = piece.encode()
                change, least, rows, low = depths(data, quoted)
                if listed:
                    if depth + least < level:
                        listed, held = False, []
                elif level == 1 and depth == 0 and b"[" in data:
                    listed, piece = True, piece[piece.index("[") + 1 :]
                elif level == 2 and rows is not None and depth + rows == 1:
                    listed, piece = depth + low >= level, data[[m for m in ROWS.finditer(data)][-1].end() :].decode()
                depth += change
                if listed:
                    if not held and place != END:
                        begin = piece.find("{")
                        piece = piece[max(begin, 0) :] if depth >= level else ""
                    held.append(piece + "}")
                    if depth == level and not ends:
                        out.append((file, block, place, "".join(held)))
                        held, place = [], WHOLE
            inside = bool(after[-1])
        yield record(out)
        out = []
    if split is not None:
        left()
        yield record(out)


def cut_rows(spark: SparkSession, path: str) -> str:
    """Folder with one row of the documents at ``path`` per line, cut by as many tasks as the files have splits."""
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    stepped = pieces.withColumn("step", piece_step(F.col("value")))
    index = settle(split_states(stepped.select("file", "block", "step")), "splits")
    known = stepped.join(F.broadcast(index), ["file", "block"])  # one row per split
    sums = settle(
        known.select("file", "block", "value", "step", "inside").mapInArrow(
            _split_depths, "file string, block long, change long, least long, rows array<struct<depth:long,least:long>>, first string"
        ),
        "splits",
    )
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0)))
    first = F.first(F.when(F.col("first") != "", F.col("first")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    placed = placed.withColumn("level", F.when(first == "[", 1).otherwise(2))
    # A split leaves the list open if it opens it for good, or if it never comes back to the document itself.
    opens = F.exists("rows", lambda r: (r["depth"] + F.col("depth") == 1) & (r["least"] + F.col("depth") >= 2))
    opens = F.when(F.col("level") == 1, F.col("block") == 0).otherwise(opens)
    closes = (F.col("depth") + F.col("least") < F.col("level")) & (F.col("block") > 0)
    step = F.when(opens, F.lit(True)).when(closes, F.lit(False))
    placed = placed.withColumn("listed", F.coalesce(F.last(step, ignorenulls=True).over(before), F.lit(False)))
    starts = settle(placed.select("file", "block", "depth", F.col("level").cast("long").alias("level"), "listed"), "splits")
    whole = known.join(F.broadcast(starts), ["file", "block"]).select("file", "block", "value", "step", "inside", "depth", "level", "listed")
    cut = settle(whole.mapInArrow(_cut, _PIECE), "pieces")
    along = Window.partitionBy("file").orderBy("block", "place")
    parts = cut.where(F.col("place") != WHOLE).withColumn("number", F.sum((F.col("place") == START).cast("int")).over(along))
    crossed = parts.groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("block", "place", "record"))).alias("pieces"))
    rows = cut.where(F.col("place") == WHOLE).select("record").unionByName(crossed.select(F.array_join("pieces.record", "").alias("record")))
    out = fresh_path(spark, "json-rows")
    # Line breaks can only lie between tokens.
    rows.select(F.translate("record", "\n\r", "  ").alias("value")).where(F.trim("value").startswith("{")).write.text(out)
    return out
