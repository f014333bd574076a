"""Periodic runs of words inside documents: seeds on diagonals, extended, one extension per stretch and lag.

A run of period q and at least ``min_words`` words and ``min_periods`` periods agrees with itself q words further on
for at least max(min_words - q, (min_periods - 1) q) words. The least of that over all q is the overlap every run is
guaranteed; k-grams of at most that length are indexed, and two consecutive occurrences of one k-gram in a document
are a seed on the diagonal of their lag. Lags up to k are found with k-grams, longer ones with k-grams of twice, four
times, ... the length, whose overlap is guaranteed too. A run's period is then always the lag of two consecutive
occurrences, so the seeds are at most one per word and level, whatever repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbtable.llm.text import SPACED_WORDS, flat, joined_words, slices, word_ids, word_spans

MIN_WORDS = 24
MIN_PERIODS = 3


def guaranteed_overlap(min_words: int, min_periods: int) -> int:
    """Words for which every run agrees with itself one period further on, at least."""
    return min(max(min_words - q, (min_periods - 1) * q) for q in range(1, max(min_words, 2) + 1))


def repeated_grams(grams: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose gram occurs again, and dense gram numbers for them."""
    if not len(at):
        return at, grams
    _, number, count = np.unique(grams, return_inverse=True, return_counts=True)
    again = count[number] > 1
    return at[again], number[again]


def _seeds(words: np.ndarray, first: np.ndarray, shortest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``k, starts, lags`` of the consecutive occurrences of each repeated k-gram, for k = shortest, twice that, ...

    ``words`` are exact word numbers, ``first`` the documents' first words. Grams never leave their document; a
    gram can only be repeated where its halves are, so most positions fall away early.
    """
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.arange(len(words))
    at, grams = repeated_grams(doc * (int(words.max(initial=0)) + 1) + words, at)
    width, number = 1, np.full(len(words), -1, np.int64)
    while len(at):
        number[:] = -1
        number[at] = grams
        if width >= shortest:
            order = np.argsort(grams, kind="stable")
            left, right = at[order][:-1], at[order][1:]
            same = grams[order][:-1] == grams[order][1:]
            yield width, left[same], (right - left)[same]
        inside = at + width < len(words)
        at, other = at[inside], number[at[inside] + width]
        paired = other >= 0
        at, other = at[paired], other[paired]
        at, grams = repeated_grams(number[at] * (int(number.max(initial=0)) + 1) + other, at)
        width *= 2


def _agreeing(words: np.ndarray, i: int, lag: int, low: int, high: int) -> tuple[int, int]:
    """The longest stretch about word ``i`` inside ``low..high`` where words ``lag`` apart are the same."""
    end, step = i, 64
    while end + lag < high:
        size = min(step, high - lag - end)
        differ = words[end : end + size] != words[end + lag : end + lag + size]
        if differ.any():
            end += int(differ.argmax())
            break
        end, step = end + size, 2 * step
    start, step = i, 64
    while start > low:
        size = min(step, start - low)
        differ = (words[start - size : start] != words[start - size + lag : start + lag])[::-1]
        if differ.any():
            start -= int(differ.argmax())
            break
        start, step = start - size, 2 * step
    return start, end


def periodic_runs(
    words: np.ndarray, first: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS
) -> dict[int, list[tuple[int, int, int]]]:
    """``start, length, period`` of each document's runs, by start and period; documents without runs are left out."""
    shortest = 1 << (guaranteed_overlap(min_words, min_periods).bit_length() - 1)
    found: dict[int, list[tuple[int, int, int]]] = {}
    for k, starts, lags in _seeds(words, first, shortest):
        own = (lags <= k) & ((lags > k // 2) | (k == shortest))
        starts, lags = starts[own], lags[own]
        docs = np.searchsorted(first, starts, side="right") - 1
        covered: dict[tuple[int, int], int] = {}  # how far the extensions of a document and lag went
        order = np.lexsort((starts, lags, docs))
        starts, lags, docs = starts[order], lags[order], docs[order]
        group = np.flatnonzero(np.diff(docs, prepend=-1).astype(bool) | np.diff(lags, prepend=-1).astype(bool))
        for lo, hi in zip(group.tolist(), [*group[1:].tolist(), len(starts)]):
            doc, lag, n = int(docs[lo]), int(lags[lo]), lo
            low, high = int(first[doc]), int(first[doc + 1])
            while n < hi:
                start, end = _agreeing(words, int(starts[n]), lag, low, high)
                covered[doc, lag] = end
                length = end + lag - start
                if length >= max(min_words, min_periods * lag):
                    found.setdefault(doc, []).append((start - low, length, lag))
                n += int(np.searchsorted(starts[n:hi], covered[doc, lag]))
    return {doc: sorted(runs) for doc, runs in found.items()}


def _collapsed(runs: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """Which of ``n`` words no run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def find_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    min_periods: int = MIN_PERIODS,
) -> DataFrame:
    """``id_col, n_words, runs array<struct<start, length, period>>, collapsed`` for each row, in one pass without a shuffle.

    Words are what lies between white space (ASCII), unchanged. A run is a stretch with its smallest period, of at
    least ``min_words`` words and ``min_periods`` (three or more) periods, that no neighbouring word prolongs; runs
    come by start, then period, and may overlap. ``collapsed`` joins the words that no run contains after its
    first period by one space. Null and empty texts have no words, no runs and an empty ``collapsed``; null ids
    and repeated rows are kept; an empty table gives no rows; other columns are not read. A text of any length is
    searched whole; memory and time grow with the text, not with the repeats in it.
    """
    if min_periods < 3 or min_words < 2:
        raise ValueError("runs need at least three periods and two words")
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                buffer, offsets = flat(part.column("text"))
                starts, ends, first = word_spans(buffer, offsets, SPACED_WORDS)
                runs = periodic_runs(word_ids(buffer, starts, ends), first, min_words, min_periods)
                texts = []
                for k in range(part.num_rows):
                    lo, hi = int(first[k]), int(first[k + 1])
                    keep = slice(lo, hi)
                    if k in runs:
                        keep = lo + np.flatnonzero(_collapsed(runs[k], hi - lo))
                    texts.append(joined_words(buffer, starts, ends, keep))
                listed = [[dict(zip(("start", "length", "period"), r)) for r in runs.get(k, ())] for k in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(np.diff(first)), pa.array(listed, pa.list_(run)), pa.array(texts, pa.string())],
                    ["id", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(scan, schema).withColumnRenamed("id", id_col)
