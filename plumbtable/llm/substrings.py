"""Exact substring duplicates: matching statistics of documents against suffix automata of reference shards.

A window of ``width`` consecutive words is a repeat if its words also start earlier, in a document with a smaller id
or further up in the same one. Every window has an anchor, the k-gram with the smallest hash inside it, so equal
windows have equal anchors. In one round

1. the anchors' smallest document ids are counted with a map-side combine; the document that holds an anchor first is
   the reference of all others that hold it;
2. documents with such an anchor send the stretches of windows about it to their references; a task builds the suffix
   automaton of a reference, in shards of at most ``SHARD`` words, and streams the stretches through it: a window is a
   repeat where at least ``width`` words up to its end match;
3. windows that the reference lacks although it holds their anchor are open. They go on to a second round in which
   the whole window is the anchor, so that its first document is its reference; rounds go on, with other digests,
   until none is left open.

Every shard broadcast to every document would be work with the square of the corpus, so a shard goes where the
documents that share an anchor with it go. A reference of very many stretches is built in several tasks that share
them. Repeats inside one document are found where it is read for the result, by numbering its windows exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from plumbtable.llm.runs import repeated_grams
from plumbtable.llm.text import (
    SPACED_WORDS,
    flat,
    joined_words,
    slices,
    span_hashes,
    window_hashes,
    word_ids,
    word_spans,
)
from plumbtable.session import settle

WIDTH = 20
#: Words of an anchor: longer ones are less often shared without their window, shorter ones are fewer.
ANCHOR = 12
#: Words of one automaton at most, some 30 MB; words of stretches matched against it at once.
SHARD = 50_000
#: Windows of one stretch at most.
STRETCH = 4096
#: References of more than one in this many stretches are built in several tasks; so they are at most so many.
HEAVY = 1024
#: Rows at most of the broadcast table that keeps texts without a part in a round out of its shuffles.
HASHES = 1 << 20


class SuffixAutomaton:
    """All substrings of a sequence; ``matched`` gives the longest match up to each item of another one."""

    def __init__(self, items):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        self._last = 0
        for item in items:
            self._add(item)

    def _state(self, length: int, link: int, moves: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(moves)
        return len(self.next) - 1

    def _add(self, item) -> None:
        moves, link, length = self.next, self.link, self.length
        state = self._state(length[self._last] + 1, 0, {})
        p = self._last
        while p >= 0 and item not in moves[p]:
            moves[p][item] = state
            p = link[p]
        if p >= 0:
            q = moves[p][item]
            if length[q] > length[p] + 1:
                split = self._state(length[p] + 1, link[q], dict(moves[q]))
                link[q] = split
                while p >= 0 and moves[p].get(item) == q:
                    moves[p][item] = split
                    p = link[p]
                q = split
            link[state] = q
        self._last = state

    def matched(self, items) -> list[int]:
        """The matching statistic: how many items up to each one lie in the automaton's sequence in a row."""
        moves, link, length = self.next, self.link, self.length
        state, size, out = 0, 0, []
        for item in items:
            after = moves[state].get(item)
            while after is None and state:
                state = link[state]
                size = length[state]
                after = moves[state].get(item)
            if after is None:
                size = 0
            else:
                state, size = after, size + 1
            out.append(size)
        return out


def anchors(hashes: np.ndarray, first: np.ndarray, width: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that lie in one document, the position of each one's anchor, and the hashes of all k-grams."""
    grams = window_hashes(hashes, k)
    n = max(len(hashes) - width + 1, 0)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole = np.flatnonzero(doc[:n] == doc[width - 1 :]) if n else np.empty(0, np.int64)
    best, at = grams[:n].copy(), np.zeros(n, np.int64)
    for shift in range(1, width - k + 1):
        less = grams[shift : shift + n] < best
        best[less] = grams[shift : shift + n][less]
        at[less] = shift
    return whole, whole + at[whole], grams


def _window_digest(words: list[bytes], seed: int) -> int:
    digest = hashlib.blake2b(b" ".join(words), digest_size=8, salt=seed.to_bytes(8, "big")).digest()
    return int.from_bytes(digest, "big", signed=True)


def _anchor_rows(width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                buffer, offsets = flat(part.column("text"))
                starts, ends, first = word_spans(buffer, offsets, SPACED_WORDS)
                _, at, grams = anchors(span_hashes(buffer, starts, ends), first, width, k)
                at = at[np.flatnonzero(np.diff(at, prepend=-1))]
                row = np.searchsorted(first, at, side="right") - 1
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams[at].view(np.int64)),
                        part.column("id").take(rows),
                        part.column("twin").take(rows),
                        pa.array((at - first[row]).astype(np.int32)),
                    ],
                    ["key", "id", "twin", "at"],
                )

    return run


def _stretches(width: int, k: int, ref_type: pa.DataType):
    """The runs of windows whose anchors are marked with one reference, as words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                buffer, offsets = flat(part.column("text"))
                starts, ends, first = word_spans(buffer, offsets, SPACED_WORDS)
                whole, at, _ = anchors(span_hashes(buffer, starts, ends), first, width, k)
                out: list[tuple] = []
                bounds = np.searchsorted(whole, first)
                for row, marks in enumerate(part.column("marks").to_pylist()):
                    lo, hi = int(bounds[row]), int(bounds[row + 1])
                    refs = sorted({m["ref"] for m in marks})
                    number = {ref: n for n, ref in enumerate(refs)}
                    pairs = np.array(sorted((m["at"], number[m["ref"]]) for m in marks), np.int64).reshape(-1, 2)
                    own = at[lo:hi] - first[row]
                    left = np.searchsorted(pairs[:, 0], own, side="left")
                    times = np.searchsorted(pairs[:, 0], own, side="right") - left
                    window = np.repeat(np.arange(lo, hi), times)
                    nth = np.arange(len(window)) - np.repeat(np.cumsum(times) - times, times)
                    ref = pairs[np.repeat(left, times) + nth, 1]
                    order = np.lexsort((window, ref))
                    window, ref = whole[window[order]], ref[order]
                    new = np.flatnonzero((np.diff(window, prepend=-2) != 1) | (np.diff(ref, prepend=-1) != 0))
                    for a, b in zip(new.tolist(), [*new[1:].tolist(), len(window)]):
                        for c in range(a, b, STRETCH):
                            w0, w1 = int(window[c]), int(window[min(b, c + STRETCH) - 1]) + width
                            words = joined_words(buffer, starts, ends, slice(w0, w1))
                            out.append((row, refs[ref[a]], w0 - int(first[row]), words))
                rows, refs, begin, words = zip(*out) if out else ([], [], [], [])
                rows = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(refs, ref_type),
                        part.column("id").take(rows),
                        part.column("h").take(rows),
                        pa.array(begin, pa.int64()),
                        pa.array(words, pa.string()),
                    ],
                    ["ref", "id", "h", "begin", "text"],
                )

    return run


def _pieces(text: bytes, width: int) -> Iterator[list[bytes]]:
    """Words of a reference in shards; neighbouring shards share all but one word of a window."""
    buffer = np.frombuffer(text, np.uint8)
    starts, ends, _ = word_spans(buffer, np.array([0, len(buffer)]), SPACED_WORDS)
    for a in range(0, max(len(starts) - width + 1, 0), SHARD):
        b = min(a + SHARD + width - 1, len(starts))
        yield text[starts[a] : ends[b - 1]].split()


class _Matcher:
    """One reference after the other, each followed by its stretches; holds one shard and some stretches at once."""

    def __init__(self, width: int, seed: int):
        self.width, self.seed = width, seed
        self.key, self.texts, self.held, self.size = None, [], [], 0
        self.automaton = None

    def reference(self, key, text: bytes) -> Iterator[tuple]:
        if key != self.key:
            yield from self.matches()
            self.key, self.texts, self.automaton = key, [], None
        self.texts.append(text)

    def stretch(self, key, row: tuple, text: bytes) -> Iterator[tuple]:
        if key != self.key:
            yield from self.matches()
            self.key, self.texts, self.automaton = key, [], None
        words = text.split()
        self.held.append((row, words))
        self.size += len(words)
        if self.size >= SHARD:
            yield from self.matches()

    def _automata(self) -> Iterator[SuffixAutomaton]:
        """The reference's shards one after the other; the only one of a reference is kept for later stretches."""
        if self.automaton is not None:
            yield self.automaton
            return
        shards = (piece for text in self.texts for piece in _pieces(text, self.width))
        ahead = next(shards, None)
        single = True
        while ahead is not None:
            piece, ahead = ahead, next(shards, None)
            automaton = SuffixAutomaton(piece)
            single = single and ahead is None
            if single:
                self.automaton = automaton
            yield automaton

    def matches(self) -> Iterator[tuple]:
        """``row, repeated runs of windows, open windows`` for the stretches held."""
        found = [np.zeros(len(words) - self.width + 1, bool) for _, words in self.held]
        if self.held:
            for automaton in self._automata():
                for seen, (_, words) in zip(found, self.held):
                    seen |= np.array(automaton.matched(words))[self.width - 1 :] >= self.width
        for seen, ((id_, h, begin), words) in zip(found, self.held):
            edges = np.flatnonzero(np.diff(np.concatenate([[False], seen, [False]]).astype(np.int8)))
            runs = [{"begin": begin + a, "end": begin + b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]
            left = [
                {"at": begin + w, "key": _window_digest(words[w : w + self.width], self.seed)}
                for w in np.flatnonzero(~seen).tolist()
            ]
            yield id_, h, runs, left
        self.held, self.size = [], 0


_RUNS = "array<struct<begin:long,end:long>>"
_OPEN = "array<struct<at:int,key:long>>"


def _match(width: int, seed: int, id_type: pa.DataType):
    runs = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    left = pa.list_(pa.struct([("at", pa.int32()), ("key", pa.int64())]))

    def record(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (id_type, pa.int64(), runs, left))], ["id", "h", "runs", "open"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _Matcher(width, seed)
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("ref", "salt", "kind", "id", "h", "begin", "text")]
            for ref, salt, kind, id_, h, begin, text in zip(*columns):
                if kind == 0:
                    out += matcher.reference((ref, salt), text.encode())
                else:
                    out += matcher.stretch((ref, salt), (id_, h, begin), text.encode())
            yield record(out)
        yield record(list(matcher.matches()))

    return run


def _holding(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rows`` whose id may be among ``wanted.id``; what is broadcast has at most ``HASHES`` rows."""
    number = lambda: F.pmod(F.xxhash64("id"), F.lit(HASHES))
    hashes = wanted.select(number().alias("hash")).distinct()
    return rows.join(F.broadcast(hashes), number() == F.col("hash"), "left_semi")


def _round(rows: DataFrame, keys: DataFrame, width: int, k: int, seed: int) -> DataFrame | None:
    """``id, h, runs, open`` for the stretches of all windows whose anchor some earlier document holds.

    ``keys (key, id, twin, at)`` are the anchors still in question. None if no document shares one with an earlier one.
    """
    kind = rows.schema["id"].dataType
    arrow = to_arrow_type(kind)
    shared = keys.groupBy("key").agg(
        F.min("id").alias("ref"), F.max("id").alias("last"), F.max(F.col("id").isNull().cast("int")).alias("nameless")
    )
    # Written, so that the join reads shuffled rows on both sides and a frequent anchor can be divided.
    shared = settle(shared.where("last > ref or (nameless = 1 and ref is not null)").select("key", "ref"), "anchors")
    later = keys.join(shared, "key").where("id is null or id > ref")
    marks = later.groupBy("id", "twin").agg(F.collect_set(F.struct("ref", "at")).alias("marks"))
    marks = settle(marks, "marks")
    if marks.isEmpty():
        return None
    some = marks.select(F.col("id").alias("of"), F.col("twin").alias("of_twin"), "marks")
    held = _holding(rows, marks).join(some, F.col("id").eqNullSafe(F.col("of")) & F.col("twin").eqNullSafe(F.col("of_twin")))
    name = kind.simpleString()
    cut = held.select("id", "h", "text", "marks").mapInArrow(
        _stretches(width, k, arrow), f"ref {name}, id {name}, h long, begin long, text string"
    )
    cut = settle(cut, "stretches")
    loads = cut.groupBy("ref").agg(F.count(F.lit(1)).alias("n"))
    total = cut.count()
    heavy = loads.where(F.col("n") * HEAVY > total).select("ref", F.ceil(F.col("n") * HEAVY / total).cast("int").alias("salts"))
    salts = F.coalesce("salts", F.lit(1))
    streams = cut.join(F.broadcast(heavy), "ref", "left").select(
        "ref", F.pmod(F.xxhash64("id", "h", "begin"), salts).cast("int").alias("salt"), F.lit(1).alias("kind"), "id", "h", "begin", "text"
    )
    refs = loads.select(F.col("ref").alias("id"))
    texts = _holding(rows, refs).join(refs, "id").join(F.broadcast(heavy), F.col("id") == F.col("ref"), "left").select(
        F.col("id").alias("ref"),
        F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"),
        F.lit(0).alias("kind"),
        F.lit(None).cast(kind).alias("id"),
        F.lit(None).cast("long").alias("h"),
        F.lit(None).cast("long").alias("begin"),
        "text",
    )
    routed = texts.unionByName(streams).repartition("ref", "salt").sortWithinPartitions("ref", "salt", "kind")
    return settle(routed.mapInArrow(_match(width, seed, arrow), f"id {name}, h long, runs {_RUNS}, open {_OPEN}"), "matches")


def _own_repeats(words: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    """Windows whose words start earlier in the same document, by exact numbers of grams of growing size."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at, grams = repeated_grams(doc * (int(words.max(initial=0)) + 1) + words, np.arange(len(words)))
    number = np.full(len(words), -1, np.int64)
    size = 1
    while size < width and len(at):
        number[:] = -1
        number[at] = grams
        step = min(size, width - size)
        at = at[at + step < len(words)]
        at = at[number[at + step] >= 0]
        at, grams = repeated_grams(number[at] * (int(number.max()) + 1) + number[at + step], at)
        size += step
    order = np.argsort(grams, kind="stable")
    return np.sort(at[order][np.flatnonzero(np.diff(grams[order], prepend=-1) == 0)])


def _remover(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                buffer, offsets = flat(part.column("text"))
                starts, ends, first = word_spans(buffer, offsets, SPACED_WORDS)
                change = np.zeros(len(starts) + 1, np.int64)
                own = _own_repeats(word_ids(buffer, starts, ends), first, width)
                np.add.at(change, own, 1)
                np.add.at(change, own + width, -1)
                for k, runs in enumerate(part.column("runs").to_pylist()):
                    for run in runs or ():
                        change[first[k] + run["begin"]] += 1
                        change[first[k] + run["end"] + width - 1] -= 1
                kept = np.cumsum(change[:-1]) == 0
                counts = np.diff(np.concatenate([[0], np.cumsum(kept)])[first])
                texts = [
                    joined_words(buffer, starts, ends, lo + np.flatnonzero(kept[lo:hi]))
                    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(np.diff(first)), pa.array(np.diff(first) - counts), pa.array(texts, pa.string())],
                    ["id", "n_words", "n_removed", "kept"],
                )

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, k: int = ANCHOR) -> DataFrame:
    """``id_col, n_words, n_removed, kept`` for each row; ``kept`` joins the words left by one space.

    Words are what lies between white space (ASCII), unchanged. A word goes if a window of ``width`` words about it
    also starts earlier: in a row with a smaller id, or further up in the same text; windows are judged on the texts as
    they are. Rows with one id are not earlier than each other, so repeated rows get equal results; a row without an
    id is later than all with one, and not than others without. Null and empty texts have no words; an empty table
    gives no rows; other columns are not read. Anchors have ``k`` words, at most ``width``.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("h"))
    rows = rows.withColumn("twin", F.when(F.col("id").isNull(), F.col("h")))
    name = rows.schema["id"].dataType.simpleString()
    keys = rows.select("id", "twin", "text").mapInArrow(_anchor_rows(width, k), f"key long, id {name}, twin long, at int")
    found, seed, size = [], 1, k
    while (matched := _round(rows, keys, width, size, seed)) is not None:
        found.append(matched.where(F.size("runs") > 0).select("id", "h", "runs"))
        left = matched.select("id", "h", F.explode("open").alias("w"))
        twin = F.when(F.col("id").isNull(), F.col("h")).alias("twin")
        keys = left.select(F.col("w.key").alias("key"), "id", twin, F.col("w.at").alias("at"))
        seed, size = seed + 1, width
    result = f"id {name}, n_words long, n_removed long, kept string"
    whole = rows.withColumn("runs", F.lit(None).cast(_RUNS))
    if found:
        runs = found[0]
        for more in found[1:]:
            runs = runs.unionByName(more)
        runs = runs.groupBy(F.col("id").alias("of"), F.col("h").alias("of_h")).agg(F.flatten(F.collect_set("runs")).alias("runs"))
        whole = rows.join(runs, F.col("id").eqNullSafe(F.col("of")) & F.col("h").eqNullSafe(F.col("of_h")), "left")
    return whole.select("id", "text", "runs").mapInArrow(_remover(width), result).withColumnRenamed("id", id_col)
