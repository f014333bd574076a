"""Packing documents into fixed token windows: bounded-space online best fit, then a merge of the leftovers.

Each task keeps ``open_windows`` windows open. A document gets its ids plus an end id; whole windows of it are
emitted as they are, the rest goes to the open window it fits best. Where it fits none, the fullest window is
filled up with the head of the rest and emitted. At the end of a task its open windows are merged into full
ones and one leftover; the tasks' leftovers are merged in rounds of ``FAN_IN``, so no task ever holds more than
``FAN_IN`` windows of them. Only the last window of all is padded.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbtable.llm.text import flat, slices
from plumbtable.llm.tokens import encoder
from plumbtable.session import fresh_path

#: Leftover windows merged by one task.
FAN_IN = 64
_COLUMNS = ["doc", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


class Packer:
    """Places pieces ``(doc, start, ids, doc_tokens)`` and returns finished windows as lists of pieces."""

    def __init__(self, window: int, open_windows: int):
        self.window, self.most = window, open_windows
        self.pieces: list[list[tuple]] = []
        self.room: list[int] = []

    def _take(self, k: int) -> list[tuple]:
        done = self.pieces[k]
        self.pieces[k], self.room[k] = self.pieces[-1], self.room[-1]
        self.pieces.pop()
        self.room.pop()
        return done

    def add(self, doc, start: int, ids: np.ndarray, doc_tokens: int) -> Iterator[list[tuple]]:
        while len(ids) >= self.window:
            yield [(doc, start, ids[: self.window], doc_tokens)]
            start, ids = start + self.window, ids[self.window :]
        while len(ids):
            best, least = -1, self.window + 1
            for k, room in enumerate(self.room):
                if len(ids) <= room < least:
                    best, least = k, room
            if best < 0 and len(self.room) < self.most:
                best = len(self.room)
                self.pieces.append([])
                self.room.append(self.window)
            if best >= 0:
                self.pieces[best].append((doc, start, ids, doc_tokens))
                self.room[best] -= len(ids)
                if not self.room[best]:
                    yield self._take(best)
                return
            fullest = int(np.argmin(self.room))
            head = self.room[fullest]
            self.pieces[fullest].append((doc, start, ids[:head], doc_tokens))
            yield self._take(fullest)
            start, ids = start + head, ids[head:]

    def leftovers(self) -> tuple[list[list[tuple]], list[tuple]]:
        """Open windows, fullest first, run together: the full windows they make and what remains."""
        order = np.argsort(self.room, kind="stable")
        made = merged((piece for k in order for piece in self.pieces[k]), self.window)
        self.pieces, self.room = [], []
        return made


def merged(pieces: Iterable[tuple], window: int) -> tuple[list[list[tuple]], list[tuple]]:
    """Pieces run together and cut at window borders."""
    full: list[list[tuple]] = []
    now: list[tuple] = []
    room = window
    for doc, start, ids, doc_tokens in pieces:
        while len(ids):
            now.append((doc, start, ids[:room], doc_tokens))
            taken = len(now[-1][2])
            start, ids, room = start + taken, ids[taken:], room - taken
            if not room:
                full.append(now)
                now, room = [], window
    return full, now


def _rows(sequence_id: int, pieces: list[tuple]) -> Iterator[tuple]:
    offset = 0
    for doc, start, ids, doc_tokens in pieces:
        yield doc, start, len(ids), ids.astype("<u4").tobytes(), doc_tokens, sequence_id, offset
        offset += len(ids)


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = "byte_bpe_50k.json",
    window: int = 2048,
    open_windows: int = 32,
    end_id: int = 1,
) -> DataFrame:
    """Pieces ``id_col, start, length, ids (little-endian uint32), doc_tokens, sequence_id, offset``.

    Every id of every row lies in exactly one piece; a null or empty text is the end id alone; null ids and
    repeated rows are packed like any other; an empty table gives no rows; other columns are not read.
    Sequence ids are unique, not dense. The tokenised pieces are written once to the shared folder, so
    the leftovers' rounds read only the leftovers.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, packer = encoder(tokenizer), Packer(window, open_windows)
        task = TaskContext.get().partitionId()
        kind, made = pa.int64(), 0

        def out(windows: list[list[tuple]], leftover: bool) -> pa.RecordBatch:
            nonlocal made
            rows = []
            for pieces in windows:
                rows.extend(_rows(task << 32 | made, pieces))
                made += 1
            columns = list(zip(*rows)) if rows else [[] for _ in _COLUMNS]
            kinds = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            arrays += [pa.array([task] * len(rows), pa.int64()), pa.array([leftover] * len(rows), pa.bool_())]
            return pa.RecordBatch.from_arrays(arrays, [*_COLUMNS, "task", "leftover"])

        for batch in batches:
            kind = batch.column("doc").type
            for part in slices(batch, "text"):
                ids, bounds = coder.encode(*flat(part.column("text")))
                done = []
                for k, doc in enumerate(part.column("doc").to_pylist()):
                    own = np.append(ids[bounds[k] : bounds[k + 1]], np.uint32(end_id))
                    done.extend(packer.add(doc, 0, own, len(own)))
                yield out(done, False)
        full, rest = packer.leftovers()
        if full:
            yield out(full, False)
        if rest:
            yield out([rest], True)

    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    doc_type = rows.schema["doc"].dataType.simpleString()
    piece = f"doc {doc_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    level = f"{piece}, task long, leftover boolean"
    spark = docs.sparkSession
    path = fresh_path(spark, "packing")
    rows.mapInArrow(place, level).write.partitionBy("leftover").option("compression", "zstd").parquet(path)
    placed = spark.read.schema(level).parquet(path)
    out = [placed.where("not leftover")]
    rest, tasks, step = placed.where("leftover"), None, 0
    while True:
        tasks = rest.agg(F.countDistinct("task")).first()[0]
        if tasks <= 1:
            break
        step += 1
        path = fresh_path(spark, "packing-leftovers")
        merge = _merger(window, step)
        grouped = rest.withColumn("task", F.expr(f"task div {FAN_IN}")).groupBy("task")
        grouped.applyInPandas(merge, level).write.partitionBy("leftover").parquet(path)
        again = spark.read.schema(level).parquet(path)
        out.append(again.where("not leftover"))
        rest = again.where("leftover")
    out.append(rest)
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result.select(F.col("doc").alias(id_col), *_COLUMNS[1:])


def _merger(window: int, step: int):
    """Merges the leftovers of up to ``FAN_IN`` tasks of one round."""

    def merge(key, frame: pd.DataFrame) -> pd.DataFrame:
        task = int(key[0])
        # Groups of one round and rounds have sequence ids of their own, above those of the tasks.
        first = step << 58 | task << 16
        frame = frame.sort_values(["sequence_id", "offset"])
        pieces = (
            (r.doc, r.start, np.frombuffer(r.ids, "<u4"), r.doc_tokens) for r in frame.itertuples(index=False)
        )
        full, rest = merged(pieces, window)
        rows = [(*row, task, False) for k, w in enumerate(full) for row in _rows(first + k, w)]
        rows += [(*row, task, True) for row in _rows(first + len(full), rest)]
        made = pd.DataFrame(rows, columns=[*_COLUMNS, "task", "leftover"], dtype=object)
        return made.convert_dtypes() if len(made) and made["doc"].isna().any() else made.infer_objects()

    return merge
