"""Records of quoted CSV files from several tasks per file, whatever lies inside the quotes.

A physical line moves the reader between two states, outside and inside a quoted cell; what it does to either is told
by two patterns, so it needs no knowledge of what came before. Composed over the lines of a split, and the splits of
a file, that gives the state at the start of every split: a structural index with one row per split. With it each
task cuts its lines into records, and the records that cross a split's border are put together from their pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbtable.session import settle

# A quoted cell with what follows up to its comma, or a cell that does not begin with a quote. Nothing backtracks.
_QUOTED = r'"(?:[^"]++|"")*+"'
_CELL = rf'(?:{_QUOTED}[^,]*+|(?!")[^,]*+)'
_OPEN = r'"(?:[^"]++|"")*+\z'
#: The line ends inside a quoted cell if it begins outside, or if it begins inside.
FROM_OUTSIDE = rf"\A(?:{_CELL},)*+{_OPEN}"
FROM_INSIDE = rf'\A(?:[^"]++|"")*+(?:\z|"[^,]*+(?:,{_CELL})*+,{_OPEN})'

#: What a line does to the state: keep it, go outside, go inside, change it.
KEEP, OUTSIDE, INSIDE, CHANGE = range(4)
_PIECE = "file string, block long, place int, heading boolean, record string"
#: Kinds of pieces, by their order in a split: whole records, the end of one, the start of one, neither end nor start.
WHOLE, END, START, MIDDLE = range(4)


def line_step(line: Column) -> Column:
    """``KEEP``, ``OUTSIDE``, ``INSIDE`` or ``CHANGE`` for a physical line."""
    outside, inside = line.rlike(FROM_OUTSIDE), line.rlike(FROM_INSIDE)
    quoted = (
        F.when(outside & inside, F.lit(INSIDE)).when(outside, F.lit(CHANGE)).when(inside, F.lit(KEEP)).otherwise(F.lit(OUTSIDE))
    )
    return F.when(line.contains('"'), quoted).otherwise(F.lit(KEEP)).cast("int")


def _lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def states(steps: np.ndarray, first: bool) -> np.ndarray:
    """Whether each line ends inside a quoted cell, given whether the first begins inside."""
    at = np.arange(len(steps))
    fixed = np.maximum.accumulate(np.where((steps == OUTSIDE) | (steps == INSIDE), at, -1))
    changes = np.cumsum(steps == CHANGE)
    base = np.where(fixed >= 0, steps[fixed] == INSIDE, first)
    since = changes - np.where(fixed >= 0, changes[fixed], 0)
    return base ^ (since % 2 == 1)


def _splits_of(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """``file, block, from, to`` of each run of rows of one split; a split's rows come in order, in one task."""
    if not batch.num_rows:
        return
    files = batch.column("file").dictionary_encode()
    numbers, blocks = files.indices.to_numpy(), batch.column("block").to_numpy()
    new = np.flatnonzero((np.diff(numbers, prepend=-1) != 0) | (np.diff(blocks, prepend=-1) != 0))
    for a, b in zip(new.tolist(), [*new[1:].tolist(), batch.num_rows]):
        yield files.dictionary[numbers[a]].as_py(), int(blocks[a]), a, b


def _split_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The step of each split as a whole."""
    split, ends = None, None

    def record():
        step = KEEP if ends == (False, True) else CHANGE if ends == (True, False) else INSIDE if ends[0] else OUTSIDE
        columns = ([split[0]], [split[1]], [step])
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int32()))], ["file", "block", "step"]
        )

    for batch in batches:
        steps = batch.column("step").to_numpy()
        for file, block, a, b in _splits_of(batch):
            if (file, block) != split:
                if split is not None:
                    yield record()
                split, ends = (file, block), (False, True)
            ends = tuple(bool(states(steps[a:b], e)[-1]) for e in ends)
    if split is not None:
        yield record()


def split_states(lines: DataFrame) -> DataFrame:
    """``file, block, inside``: whether the split begins inside quotes, from the ``step`` of each line; a row per split."""
    steps = lines.select("file", "block", "step")
    steps = settle(steps.mapInArrow(_split_steps, "file string, block long, step int"), "splits")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    counted = steps.withColumn("changes", F.sum((F.col("step") == CHANGE).cast("int")).over(upto))
    fixed = F.when(F.col("step").isin(OUTSIDE, INSIDE), F.struct((F.col("step") == INSIDE).alias("inside"), "changes"))
    seen = counted.select(
        "file", "block", F.last(fixed, ignorenulls=True).over(before).alias("fixed"), F.last("changes").over(before).alias("now")
    )
    odd = (F.coalesce("now", F.lit(0)) - F.coalesce("fixed.changes", F.lit(0))) % 2 == 1
    return seen.select("file", "block", (F.coalesce("fixed.inside", F.lit(False)) != odd).alias("inside"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each split, and the pieces of those that cross its borders. Lines of one record are held at once."""
    split, inside, held, place, heading = None, False, [], WHOLE, False

    def pieces(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[]] * 5
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], ["file", "block", "place", "heading", "record"]
        )

    def left() -> pa.RecordBatch:
        kind = MIDDLE if place == END else START
        return pieces([(*split, kind, heading, "\n".join(held))] if held else [])

    for batch in batches:
        steps = batch.column("step").to_numpy()
        first = batch.column("inside").to_numpy(zero_copy_only=False)
        for file, block, a, b in _splits_of(batch):
            if (file, block) != split:
                if split is not None:
                    yield left()
                split, inside, held = (file, block), bool(first[a]), []
                # The first record of a file is its header.
                place, heading = (END if inside else WHOLE), block == 0
            lines = batch.column("value").slice(a, b - a)
            after = states(steps[a:b], inside)
            before = np.concatenate([[inside], after[:-1]])
            single = ~before & ~after
            if heading and single[0] and not held:
                single[0], heading = False, False
            longer, at = [], []
            for k in np.flatnonzero(before | after).tolist():
                held.append(lines[k].as_py())
                if not after[k]:
                    longer.append((file, block, place, heading, "\n".join(held)))
                    at.append(k)
                    held, place, heading = [], WHOLE, False
            inside = bool(after[-1])
            whole = lines.filter(pa.array(single)).cast(pa.string())
            n = len(whole)
            alone = pa.RecordBatch.from_arrays(
                [
                    pa.array([file] * n, pa.string()),
                    pa.array([block] * n, pa.int64()),
                    pa.array([WHOLE] * n, pa.int32()),
                    pa.array([False] * n, pa.bool_()),
                    whole,
                ],
                ["file", "block", "place", "heading", "record"],
            )
            # Records leave in the order of the file.
            order = np.argsort(np.concatenate([np.flatnonzero(single), at]).astype(np.int64), kind="stable")
            both = pa.Table.from_batches([alone, pieces(longer)]).take(pa.array(order))
            yield from both.combine_chunks().to_batches()
    if split is not None:
        yield left()


def csv_records(spark: SparkSession, path) -> DataFrame | None:
    """``record``: each record's text without the headers of the files, cut by as many tasks as the files have splits.

    None if no line of the files ends inside a quoted cell: then every line is a record by itself.
    """
    lines = _lines(spark, path)
    if lines.where(F.col("value").contains('"') & F.col("value").rlike(FROM_OUTSIDE)).isEmpty():
        return None
    stepped = lines.withColumn("step", line_step(F.col("value")))
    index = settle(split_states(stepped), "splits")
    # One row per split, and of these only those that begin inside a quoted cell.
    crossing = index.where("inside")
    known = stepped.join(F.broadcast(crossing), ["file", "block"], "left")
    known = known.select("file", "block", "value", "step", F.coalesce("inside", F.lit(False)).alias("inside"))
    cut = known.mapInArrow(_cut, _PIECE)
    whole = cut.where((F.col("place") == WHOLE) & ~F.col("heading")).select("record")
    # Two pieces at most per split. A file's last record may lack its closing quote.
    parts = settle(cut.where(F.col("place") != WHOLE), "pieces")
    along = Window.partitionBy("file").orderBy("block", "place")
    numbered = parts.withColumn("number", F.sum((F.col("place") == START).cast("int")).over(along))
    joined = numbered.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("block", "place", "record"))).alias("pieces"), F.max("heading").alias("heading")
    )
    crossed = joined.where("not heading").select(F.array_join("pieces.record", "\n").alias("record"))
    records = whole.unionByName(crossed).select(F.regexp_replace("record", r"\r\z", "").alias("record"))
    return records.where(F.trim("record") != "")
