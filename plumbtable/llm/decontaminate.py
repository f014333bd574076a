"""Benchmark decontamination: windows of benchmark words looked up in every document, verified, and removed.

The windows are broadcast in blocks of items with ``BLOCK_BYTES`` of text on average, as arrays of some 30 bytes a
window; a larger benchmark takes one job over the documents per block, and a task holds one block at a time. An item
is one block's, however long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from plumbtable.llm.text import byte_class, flat, gathered, lower_ascii, slices, span_hashes, window_hashes, word_spans
from plumbtable.session import settle

WORD_BYTES = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
WIDTH = 10
#: Benchmark text held by one broadcast, in bytes: some 1.2 million windows, about 40 MB a worker with the sieves.
BLOCK_BYTES = 8 << 20
_BITS = 22


def words_of(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, rows' first words and hashes of the words, given lower-cased bytes."""
    starts, ends, first = word_spans(buffer, offsets, WORD_BYTES)
    return starts, ends, first, span_hashes(buffer, starts, ends)


class WindowSet:
    """Benchmark windows as arrays: sorted hashes, each with the first word of one place where the window lies.

    The items' words lie in one byte buffer, joined by one space, so a window's words are a slice of it. A window
    takes 12 bytes and a word 8 beside its text.
    """

    def __init__(self, items: list, texts: list[str | None], width: int):
        self.width, self.items = width, items
        buffer, offsets = flat(pa.array(texts, pa.large_string()))
        starts, ends, first, hashes = words_of(buffer := lower_ascii(buffer), offsets)
        data, at = gathered(buffer, starts, ends)
        number = np.arange(len(starts))
        joined = np.full(len(data) + len(starts), 0x20, np.uint8)
        joined[np.arange(len(data)) + np.repeat(number, ends - starts)] = data
        self.text = joined.tobytes()
        # Word k is text[starts[k] : starts[k + 1] - 1].
        self.starts = at + np.arange(len(at))
        self.first = first
        sizes = np.diff(first)
        self.windows: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in sorted({min(width, n) for n in sizes.tolist()} - {0}):
            own = np.flatnonzero(sizes >= width if size == width else sizes == size)
            counts = sizes[own] - size + 1
            places = np.repeat(first[own] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            found = window_hashes(hashes, size)[places]
            order = np.argsort(found, kind="stable")
            self.windows[size] = found[order], places[order].astype(np.int32)
        self._sift()

    def _sift(self) -> None:
        """A bit per leading hash bits, to pass by most windows of a document at once."""
        self.sieves = {}
        for size, (found, _) in self.windows.items():
            sieve = np.zeros(1 << _BITS, bool)
            sieve[found >> np.uint64(64 - _BITS)] = True
            self.sieves[size] = sieve

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "sieves"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._sift()

    def hits(self, buffer, starts, ends, first, hashes) -> Iterator[tuple[int, int, int, list]]:
        """``row, first word, words, items`` of each verified occurrence in lower-cased documents."""
        for size, (found, places) in self.windows.items():
            windows = window_hashes(hashes, size)
            near = np.flatnonzero(self.sieves[size][windows >> np.uint64(64 - _BITS)])
            lo = np.searchsorted(found, windows[near], side="left")
            hi = np.searchsorted(found, windows[near], side="right")
            rows = np.searchsorted(first, near, side="right") - 1
            whole = (near + size <= first[rows + 1]) & (hi > lo)
            for i, row, a, b in zip(*(x[whole].tolist() for x in (near, rows, lo, hi))):
                words = b" ".join(buffer[s:e].tobytes() for s, e in zip(starts[i : i + size], ends[i : i + size]))
                same = [p for p in places[a:b].tolist() if self.text[self.starts[p] : self.starts[p + size] - 1] == words]
                if same:
                    held = np.unique(np.searchsorted(self.first, same, side="right") - 1)
                    yield row, i, size, [self.items[k] for k in held.tolist()]


def _window_blocks(benchmark: DataFrame, item_col: str, text_col: str, width: int, block_bytes: int):
    """How many blocks of items there are, and a function that broadcasts the windows of one."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text")).where(
        "text is not null"
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    key = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))

    def block(k: int):
        own = items.where(key == k).collect()  # bounded by block_bytes on average
        windows = WindowSet([r["item"] for r in own], [r["text"] for r in own], width)
        return benchmark.sparkSession.sparkContext.broadcast(windows)

    return blocks, block


def _scanned(rows: DataFrame, blocks: int, block, item_type: pa.DataType, schema: str, every: bool) -> DataFrame:
    """Hits of all blocks, one job per block; its broadcast goes before the next one comes.

    With ``every`` the first block's rows hold the documents without a hit too.
    """
    parts = None
    for k in range(blocks):
        windows = block(k)
        part = rows.mapInArrow(_scanner(windows, item_type), schema)
        part = settle(part if every and not k else part.where(F.size("items") > 0), "benchmark-hits")
        windows.destroy()
        parts = part if parts is None else parts.unionByName(part)
    return parts


def find_benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``id_col, n_words, spans array<struct<first, last>>, items array`` for each row.

    ``spans`` are the hit words as merged intervals of word positions, end exclusive; ``items`` the distinct
    benchmark items with an occurring window, sorted as strings. Null and empty texts have no words and no
    hits; null ids and repeated rows are kept; an empty benchmark hits nothing; other columns are not read.
    A benchmark beyond one block is scanned block by block, the blocks' spans merged by a row key.
    """
    item_type = benchmark.schema[item_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, n_words long, spans array<struct<first:long,last:long>>, items array<{item_type}>"
    kind = to_arrow_type(benchmark.schema[item_col].dataType)
    blocks, block = _window_blocks(benchmark, item_col, item_text_col, width, block_bytes)
    if blocks == 1:
        found = rows.mapInArrow(_scanner(block(0), kind), schema)
    else:
        # Hits only: a row's id and text name it, equal rows have equal hits.
        keyed = rows.select(F.struct("id", F.sha2("text", 256).alias("digest")).alias("id"), "text")
        wide = schema.replace(f"id {id_type}", f"id struct<id:{id_type},digest:string>", 1)
        parts = _scanned(keyed, blocks, block, kind, wide, True)
        counts = keyed.groupBy(F.col("id").alias("row")).agg(F.count(F.lit(1)).alias("copies"))
        merged = parts.groupBy("id").agg(
            F.max("n_words").alias("n_words"),
            F.flatten(F.collect_set("spans")).alias("spans"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        )
        found = (
            merged.join(counts, F.col("id").eqNullSafe(F.col("row")))
            .select(
                F.col("id.id").alias("id"),
                "n_words",
                _merged_spans(F.col("spans")).alias("spans"),
                F.transform(
                    F.array_sort(F.transform("items", lambda i: F.struct(i.cast("string").alias("t"), i.alias("i")))),
                    lambda p: p["i"],
                ).alias("items"),
                F.explode(F.sequence(F.lit(1), "copies")).alias("copy"),
            )
            .drop("copy")
        )
    return found.withColumnRenamed("id", id_col)


def _merged_spans(spans):
    """Sorted intervals, those that touch or overlap as one."""
    ordered = F.array_sort(spans)
    kind = "array<struct<first:bigint,last:bigint>>"
    return F.aggregate(
        ordered,
        F.array().cast(kind),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["last"] >= s["first"]),
            F.concat(
                F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(
                    F.named_struct(
                        F.lit("first"),
                        F.element_at(done, -1)["first"],
                        F.lit("last"),
                        F.greatest(F.element_at(done, -1)["last"], s["last"]),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )


def _intervals(marks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(marks):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _hit_rows(windows: WindowSet, buffer, starts, ends, first, hashes) -> dict[int, tuple[list, set]]:
    """Merged word intervals (from the buffer's first word) and items of each row with a hit."""
    marks: dict[int, list[tuple[int, int]]] = {}
    items: dict[int, set] = {}
    for row, i, size, holders in windows.hits(buffer, starts, ends, first, hashes):
        marks.setdefault(row, []).append((i, i + size))
        items.setdefault(row, set()).update(holders)
    return {row: (_intervals(m), items[row]) for row, m in marks.items()}


def _scanner(block, item_type: pa.DataType):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = block.value
        for batch in batches:
            for part in slices(batch, "text"):
                buffer, offsets = flat(part.column("text"))
                buffer = lower_ascii(buffer)
                words = words_of(buffer, offsets)
                first = words[2]
                hit = _hit_rows(windows, buffer, *words)
                n = part.num_rows
                spans = [
                    [{"first": a - int(first[k]), "last": b - int(first[k])} for a, b in hit[k][0]] if k in hit else []
                    for k in range(n)
                ]
                items = [sorted(hit[k][1], key=str) if k in hit else [] for k in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(np.diff(first)),
                        pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                        pa.array(items, pa.list_(item_type)),
                    ],
                    ["id", "n_words", "spans", "items"],
                )

    return scan


def remove_benchmark_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
    drop_share: float = 0.5,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with each run of hit words cut out of the text; all columns and other rows as they are.

    A row goes entirely if more than ``drop_share`` of its words are hit. A cut runs from the first byte of
    the run's first word to the last of its last. Null texts stay null. A benchmark beyond one block is scanned
    block by block on the untouched texts; the blocks' runs are merged by the text's digest and cut at once, so
    the result does not depend on ``block_bytes``.
    """
    place = docs.columns.index(text_col)
    blocks, block = _window_blocks(benchmark, item_col, item_text_col, width, block_bytes)
    if blocks == 1:
        return docs.mapInArrow(_cutter(docs.columns, place, drop_share, block(0)), docs.schema)
    rows = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    text = F.col(f"c{place}").cast("string")
    keyed = rows.where(text.isNotNull()).withColumn("digest", F.sha2(text, 256))
    texts = keyed.select(F.col("digest").alias("id"), text.alias("text"))
    item = benchmark.schema[item_col].dataType
    schema = f"id string, n_words long, spans array<struct<first:long,last:long>>, items array<{item.simpleString()}>"
    parts = _scanned(texts, blocks, block, to_arrow_type(item), schema, False)
    merged = parts.groupBy("id").agg(_merged_spans(F.flatten(F.collect_set("spans"))).alias("spans"))
    hit = keyed.join(merged, F.col("digest") == F.col("id"), "left").select(*rows.columns, "spans")
    cut = hit.mapInArrow(_cutter(docs.columns, place, drop_share), docs.schema)
    return cut.unionAll(docs.where(F.col(text_col).cast("string").isNull()))


def _cutter(columns: list[str], place: int, drop_share: float, block=None):
    """Cuts the hits of ``block``, or without one the word intervals in the column after the documents' own."""

    def given(spans: pa.Array, first: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        found = enumerate(spans.to_pylist())
        return {k: [(int(first[k]) + s["first"], int(first[k]) + s["last"]) for s in own] for k, own in found if own}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = None if block is None else block.value
        for batch in batches:
            kind = batch.schema.field(place).type
            names = [f"c{k}" for k in range(batch.num_columns)]
            own = names if block is not None else names[:-1]
            renamed = pa.RecordBatch.from_arrays(batch.columns, names)
            for part in slices(renamed, names[place]):
                raw, offsets = flat(part.column(place))
                buffer = lower_ascii(raw)
                words = words_of(buffer, offsets)
                starts, ends, first, _ = words
                if windows is None:
                    hit = given(part.column(len(own)), first)
                else:
                    hit = {row: runs for row, (runs, _) in _hit_rows(windows, buffer, *words).items()}
                keep = np.ones(part.num_rows, bool)
                texts = None
                for row, runs in hit.items():
                    n = int(first[row + 1] - first[row])
                    if sum(b - a for a, b in runs) > drop_share * n:
                        keep[row] = False
                        continue
                    texts = part.column(place).to_pylist() if texts is None else texts
                    at, pieces = int(offsets[row]), []
                    for a, b in runs:
                        pieces.append(raw[at : starts[a]].tobytes())
                        at = int(ends[b - 1])
                    pieces.append(raw[at : offsets[row + 1]].tobytes())
                    texts[row] = b"".join(pieces).decode()
                if texts is not None:
                    part = part.set_column(place, names[place], pa.array(texts, kind))
                kept = part if keep.all() else part.filter(pa.array(keep))
                yield pa.RecordBatch.from_arrays(kept.columns[: len(own)], names=columns)

    return cut
