"""Token counts of whole texts for a byte-pair vocabulary, by heap and linked list; and chunked encoding.

A text is cut before single spaces between two other characters. Such a cut is a word boundary of the
pre-tokeniser whatever stands around it, so each chunk can be handled alone, and a worker handles each
distinct chunk once: the others are looked up by their 64-bit hash.
"""

from __future__ import annotations

import heapq
import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbtable.llm.text import byte_class, flat, slices, span_hashes

#: Chunks and words a worker remembers; beyond that it starts anew. Bounds memory, not the result.
CHUNKS_KEPT = 1_000_000
WORDS_KEPT = 300_000
#: The pre-tokeniser's pattern of byte-level vocabularies (fixed by the vocabulary).
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Bytes that may begin, or with the byte before may end, a white space character.
_SPACE_FIRST = byte_class((0x09, 0x0D), (0x1C, 0x20), (0xC2, 0xC2), (0xE1, 0xE3))
_SPACE_LAST = byte_class((0x09, 0x0D), (0x1C, 0x20))
_BEFORE_LAST = byte_class((0x80, 0x81), (0x9A, 0x9A), (0xC2, 0xC2))


def tokenizer_path(name_or_path: str) -> str:
    """A path as it is; a bare file name among the public tokenizers, wherever the task's machine has them."""
    if os.path.sep in name_or_path:
        return name_or_path
    import public_tokenizers

    return str(public_tokenizers.path(name_or_path))


def chunk_starts(buffer: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks begin: at the rows' first bytes and at single spaces between two non-space characters."""
    n = len(buffer)
    cut = np.zeros(n, bool)
    if n > 2:
        inner = buffer[1:-1] == 0x20
        inner &= ~_SPACE_FIRST[buffer[2:]]
        inner &= ~_SPACE_LAST[buffer[:-2]]
        at = np.flatnonzero(inner) + 1
        high = buffer[at - 1] >= 0x80
        high &= _BEFORE_LAST[buffer[np.maximum(at - 2, 0)]]
        cut[at[~high]] = True
    firsts = offsets[:-1][np.diff(offsets) > 0]
    cut[firsts] = True
    return np.flatnonzero(cut)


class ChunkTable:
    """Values by chunk hash, sorted. ``fetch`` makes the values of chunks not seen yet."""

    def __init__(self, limit: int = CHUNKS_KEPT):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.values = np.empty(0, np.int64)

    def full(self) -> bool:
        return len(self.keys) > self.limit

    def values_of(
        self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, fetch: Callable[[list[bytes]], np.ndarray]
    ) -> np.ndarray:
        hashes = span_hashes(buffer, starts, ends)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inner = place < len(self.keys)
        known[inner] = self.keys[place[inner]] == distinct[inner]
        values = np.empty(len(distinct), np.int64)
        values[known] = self.values[place[known]]
        new = np.flatnonzero(~known)
        if len(new):
            at = first[new]
            values[new] = fetch([buffer[s:e].tobytes() for s, e in zip(starts[at], ends[at])])
            self.keys = np.insert(self.keys, place[new], distinct[new])
            self.values = np.insert(self.values, place[new], values[new])
        return values[back]


class MergeCounter:
    """Counts a vocabulary's tokens by byte-pair merging, without making identifiers."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True)
        if not plain or before.get("add_prefix_space") or spec["normalizer"] or model.get("dropout"):
            raise ValueError("only byte-level pair vocabularies without a normaliser are counted here")
        symbols = {text: i for i, text in enumerate(model["vocab"])}
        self.shift = len(symbols).bit_length()
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for pair in model["merges"]:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[symbols[left] << self.shift | symbols[right]] = len(self.made)
            self.made.append(symbols[left + right])
        self.byte_symbol = [symbols[c] for c in _byte_characters()]
        added = [regex.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(sorted(added, key=len, reverse=True))) if added else None
        self.word = regex.compile(WORD)
        self.counts: dict[str, int] = {}

    def of_word(self, word: bytes) -> int:
        """Initial symbols minus merges: the adjacent pair of lowest rank merges first, leftmost of equals."""
        symbols = [self.byte_symbol[b] for b in word]
        n, rank, shift = len(symbols), self.rank, self.shift
        heap = []
        for i in range(n - 1):
            r = rank.get(symbols[i] << shift | symbols[i + 1])
            if r is not None:
                heap.append(r << 40 | i)
        heapq.heapify(heap)
        following = list(range(1, n + 1))
        previous = list(range(-1, n - 1))
        merges = 0
        while heap:
            top = heapq.heappop(heap)
            r, i = top >> 40, top & 0xFFFFFFFFFF
            j = following[i]
            if symbols[i] < 0 or j >= n or rank.get(symbols[i] << shift | symbols[j]) != r:
                continue  # an entry from before one of its symbols merged
            symbols[i], symbols[j] = self.made[r], -1
            merges += 1
            after, before = following[j], previous[i]
            following[i] = after
            if after < n:
                previous[after] = i
                s = rank.get(symbols[i] << shift | symbols[after])
                if s is not None:
                    heapq.heappush(heap, s << 40 | i)
            if before >= 0:
                s = rank.get(symbols[before] << shift | symbols[i])
                if s is not None:
                    heapq.heappush(heap, s << 40 | before)
        return n - merges

    def of_text(self, text: str) -> int:
        total, at = 0, 0
        if self.special is not None:
            for found in self.special.finditer(text):
                total += 1 + self._of_plain(text[at : found.start()])
                at = found.end()
        return total + self._of_plain(text[at:])

    def _of_plain(self, text: str) -> int:
        total, counts = 0, self.counts
        for word in self.word.findall(text):
            n = counts.get(word)
            if n is None:
                n = self.of_word(word.encode())
                if len(counts) >= WORDS_KEPT:
                    counts.clear()
                if len(word) <= 100:
                    counts[word] = n
            total += n
        return total


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or the next free one."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


_COUNTERS: dict[str, tuple[MergeCounter, ChunkTable]] = {}


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = "byte_bpe_50k.json",
    limit: int = 512,
) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` for each row, in one pass without a shuffle.

    Null and empty texts have 0 tokens; null ids and repeated rows are kept as they are; an empty table gives
    no rows; other columns are not read. A text is never cut or sampled. Special strings inside texts count
    as one token each, as the vocabulary's library has it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_path(tokenizer)
        if path not in _COUNTERS:
            _COUNTERS[path] = MergeCounter(path), ChunkTable()
        counter, table = _COUNTERS[path]
        for batch in batches:
            for part in slices(batch, "text"):
                buffer, offsets = flat(part.column("text"))
                if table.full():
                    table.clear()
                starts = chunk_starts(buffer, offsets)
                ends = np.append(starts[1:], len(buffer))
                counts = table.values_of(
                    buffer,
                    starts,
                    ends,
                    lambda chunks: np.array([counter.of_text(c.decode()) for c in chunks], np.int64),
                )
                sums = np.concatenate([[0], np.cumsum(counts)])
                at = np.searchsorted(starts, offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(np.diff(offsets)),
                        pa.array((sums[at[1:]] - sums[at[:-1]]).astype(np.int64)),
                    ],
                    ["id", "n_bytes", "n_tokens"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


class ChunkEncoder:
    """Token ids of whole texts through the vocabulary's own library, each distinct chunk encoded once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.table = ChunkTable()
        self.forget()

    def forget(self) -> None:
        self.table.clear()
        self.ids = np.empty(1 << 16, np.uint32)
        self.used = 0
        self.bounds = np.zeros(1 << 16, np.int64)  # of row k: bounds[k] to bounds[k + 1]
        self.rows = 0

    def _fetch(self, chunks: list[bytes]) -> np.ndarray:
        made = self.tokenizer.encode_batch_fast([c.decode() for c in chunks], add_special_tokens=False)
        found = [e.ids for e in made]
        new = np.fromiter((i for ids in found for i in ids), np.uint32)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        while self.used + len(new) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while self.rows + len(found) + 1 > len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
        self.ids[self.used : self.used + len(new)] = new
        self.bounds[self.rows + 1 : self.rows + 1 + len(found)] = self.used + np.cumsum(lengths)
        rows = np.arange(self.rows, self.rows + len(found))
        self.used += len(new)
        self.rows += len(found)
        return rows

    def encode(self, buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows end to end, and the rows' offsets among them."""
        if self.table.full():
            self.forget()
        starts = chunk_starts(buffer, offsets)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        rows = self.table.values_of(buffer, starts, np.append(starts[1:], len(buffer)), self._fetch)
        lengths = self.bounds[rows + 1] - self.bounds[rows]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.bounds[rows] - (ends - lengths), lengths)
        ids = self.ids[shift + np.arange(len(shift))]
        at = np.searchsorted(starts, offsets)
        return ids, np.concatenate([[0], ends])[at]


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(tokenizer: str) -> ChunkEncoder:
    """The worker's encoder for a vocabulary."""
    path = tokenizer_path(tokenizer)
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]
