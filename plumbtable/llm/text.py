"""Vectorised helpers on Arrow text columns: byte buffers, word spans and 64-bit span hashes.

Everything works on the UTF-8 bytes of a slice of rows at once, so no Python object is made per word.
Slices are cut by bytes, never inside a text; scratch arrays are bounded by ``STEP`` whatever a text's length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once, and bytes per hashing step.
SLICE_BYTES = 4 << 20
STEP = 1 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of ``batch`` whose texts hold about ``limit`` bytes; a longer text is a slice of its own."""
    n = batch.num_rows
    if not n:
        return
    _, offsets = flat(batch.column(column))
    start = 0
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), n)
        yield batch.slice(start, stop - start)
        start = stop


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end and the int64 offsets of the rows; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    bounds, data = column.buffers()[1:3]
    offsets = np.frombuffer(bounds, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    if data is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(buffer: np.ndarray, offsets: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that ``in_word`` marks, and each row's first run.

    Runs never cross a row. The third array has one entry more than there are rows.
    """
    if not len(buffer):
        nothing = np.empty(0, np.int64)
        return nothing, nothing, np.zeros(len(offsets), np.int64)
    inside = in_word[buffer]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    firsts = offsets[:-1]
    before[firsts[firsts < len(buffer)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    lasts = offsets[1:] - 1
    after[lasts[lasts >= 0]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS["up"]) < length:
        size = max(length, STEP + 1)
        for name, base in (("up", _MULTIPLIER), ("down", _inverse(_MULTIPLIER))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def mix(values: np.ndarray) -> np.ndarray:
    """Bit mixer of 64-bit values; a permutation."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span, the same wherever the span lies. Spans are in order and disjoint."""
    n = len(starts)
    out = np.empty(n, np.uint64)
    i = 0
    while i < n:
        base = int(starts[i])
        j = int(np.searchsorted(ends, base + STEP, side="right"))
        if j <= i:  # a span longer than a step
            digest = hashlib.blake2b(buffer[base : ends[i]].tobytes(), digest_size=8).digest()
            out[i] = int.from_bytes(digest, "little")
            i += 1
            continue
        piece = buffer[base : ends[j - 1]]
        up, down = _powers(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_BYTE_CODES[piece] * up[: len(piece)], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        i = j
    return mix(out)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive word hashes: one per run, ``len(words) - width + 1`` of them."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out *= np.uint64(_MULTIPLIER)
        out += words[k : k + n]
    return mix(out)


def lower_ascii(buffer: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lower-cased and all others as they are."""
    return LOWER[buffer]


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Lookup table that is true for the bytes in the inclusive ranges."""
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


#: Bytes of words between ASCII white space.
SPACED_WORDS = byte_class((0x00, 0x08), (0x0E, 0x1F), (0x21, 0xFF))


def gathered(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans' bytes end to end and their offsets. Spans are in order and disjoint."""
    sizes = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    inside = np.zeros(len(buffer) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    return buffer[np.cumsum(inside[:-1], dtype=np.int8).view(bool)], offsets


def word_ids(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Numbers of the spans' texts, from 0: equal numbers if and only if the bytes are equal."""
    data, offsets = gathered(buffer, starts, ends)
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    )
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def joined_words(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, keep) -> str:
    """The spans numbered by ``keep`` joined by one space."""
    data = memoryview(np.ascontiguousarray(buffer))
    return b" ".join([data[s:e] for s, e in zip(starts[keep].tolist(), ends[keep].tolist())]).decode()
