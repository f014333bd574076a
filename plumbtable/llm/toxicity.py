"""Toxicity by compression distance: windows compressed with a dictionary of toxic and one of ordinary text.

Fitting reads a bounded hash sample of labelled rows. Toxic text is what toxic documents hold and ordinary ones
do not: words whose documents, counted once per group of near copies, differ in their label far beyond chance.
A zstandard dictionary is trained on them and one on windows of ordinary documents. The ordinary compressor
uses the ordinary dictionary, the toxic one both, so that a window's two lengths differ by what the toxic
dictionary alone explains. A document's score is a calibrated function of how many of its windows show which
difference.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbtable.llm.text import byte_class, flat, lower_ascii, slices, word_spans
from plumbtable.session import settle

#: Labelled rows to fit on, at most twice as many; words of the toxic dictionary at most.
LABELLED = 12_000
WORDS = 2_000
#: Words of a window and words from one window to the next.
WIDTH, STEP = 4, 2
LEVEL = 5
#: Short matches count: a word of five letters between spaces must be worth a match.
PARAMETERS = zstandard.ZstdCompressionParameters.from_level(
    LEVEL,
    source_size=64,
    dict_size=4096,
    min_match=3,
    strategy=zstandard.STRATEGY_BTLAZY2,
    search_log=6,
    write_content_size=0,
    write_dict_id=0,
)
LOWEST, HIGHEST = -4, 12
_IN_WORD = ~byte_class((0x09, 0x0D), (0x20, 0x20))


@dataclass
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    ratios: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray


def sampled_labels(labels: DataFrame, id_col: str, label_col: str, learn: Column, most: int) -> DataFrame:
    """``id, label`` of about ``most`` learnable rows by a hash of the id, never more than twice as many."""
    rows = labels.where(learn).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    rows = rows.where("id is not null and label is not null")
    share = min(1.0, most / max(1, rows.count()))
    return rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20))).limit(2 * most)


def _segments(part: pa.RecordBatch) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Lower-cased bytes, window bounds with one byte more on either side inside the row, and the rows' first windows."""
    buffer, offsets = flat(part.column("text"))
    buffer = lower_ascii(buffer)
    starts, ends, first = word_spans(buffer, offsets, _IN_WORD)
    words = np.diff(first)
    windows = np.where(words > 0, np.maximum(-(-(words - WIDTH) // STEP), 0) + 1, 0)
    firsts = np.concatenate([[0], np.cumsum(windows)])
    row = np.repeat(np.arange(len(words)), windows)
    at = first[row] + STEP * (np.arange(len(row)) - firsts[row])
    to = np.minimum(at + WIDTH, first[row + 1]) - 1
    lo = np.maximum(starts[at] - 1, offsets[row]) if len(row) else at
    hi = np.minimum(ends[to] + 1, offsets[row + 1]) if len(row) else at
    return buffer.tobytes(), np.stack([lo, hi - lo], axis=1).astype(np.uint64), firsts


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    shared.precompute_compress(compression_params=PARAMETERS)
    return zstandard.ZstdCompressor(dict_data=shared, compression_params=PARAMETERS)


def _lengths(compressor: zstandard.ZstdCompressor, data: bytes, segments: np.ndarray) -> np.ndarray:
    out = []
    for at in range(0, len(segments), 50_000):
        some = segments[at : at + 50_000]
        made = compressor.multi_compress_to_buffer(zstandard.BufferWithSegments(data, some.tobytes()))
        out.append(np.fromiter((len(made[k]) for k in range(len(made))), np.int64, len(made)))
    return np.concatenate(out) if out else np.empty(0, np.int64)


_COMPRESSORS: dict[int, tuple] = {}


def _histograms(model: ToxicityModel, part: pa.RecordBatch) -> np.ndarray:
    """Windows of each row by how many bytes the toxic dictionary saves."""
    key = zlib.crc32(model.toxic + model.ordinary)
    if key not in _COMPRESSORS:
        _COMPRESSORS.clear()
        _COMPRESSORS[key] = _compressor(model.ordinary), _compressor(model.ordinary + model.toxic)
    ordinary, toxic = _COMPRESSORS[key]
    data, segments, firsts = _segments(part)
    saved = _lengths(ordinary, data, segments) - _lengths(toxic, data, segments)
    bins = HIGHEST - LOWEST + 1
    row = np.repeat(np.arange(part.num_rows), np.diff(firsts))
    cell = row * bins + np.clip(saved, LOWEST, HIGHEST) - LOWEST
    return np.bincount(cell, minlength=part.num_rows * bins).reshape(-1, bins)


def _inputs(histograms: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    counts = histograms.astype(np.float64)
    total = np.maximum(counts.sum(axis=1, keepdims=True), 1.0)
    high = counts[:, 2 - LOWEST :]
    evidence = counts @ ratios
    return np.column_stack(
        [np.log1p(high), np.log(total), high / total, evidence, evidence / np.sqrt(total[:, 0]), evidence / total[:, 0]]
    )


def _group(words: list[str]) -> int:
    """The same for most near copies: the least hash of three words in a row."""
    return min((zlib.crc32(" ".join(words[i : i + 3]).encode()) for i in range(max(1, len(words) - 2))), default=0)


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            out: tuple[list, list, list] = ([], [], [])
            for text, label in zip(part.column("text").to_pylist(), part.column("label").to_pylist()):
                words = lower_ascii(np.frombuffer((text or "").encode(), np.uint8)).tobytes().decode().split()
                group, own = _group(words), {w for w in words if len(w) <= 64}
                out[0].extend(own)
                out[1].extend([label] * len(own))
                out[2].extend([group] * len(own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64())],
                ["word", "label", "grp"],
            )


def _toxic_words(learn: DataFrame, least_gain: float = 30.0, least_ratio: float = 10.0) -> list[str]:
    """Words with a log-likelihood gain of ``least_gain`` and ``least_ratio`` times as frequent in toxic documents."""
    seen = learn.mapInArrow(_distinct_words, "word string, label int, grp long").distinct()
    totals = {r["label"]: r["n"] for r in seen.groupBy("label").agg(F.countDistinct("grp").alias("n")).collect()}
    a, b = totals.get(1, 0), totals.get(0, 0)
    if not a or not b:
        return []
    counts = seen.groupBy("word").agg(
        F.sum((F.col("label") == 1).cast("double")).alias("k"), F.sum((F.col("label") == 0).cast("double")).alias("q")
    )
    share = F.lit(a / (a + b))
    mean = (F.col("k") + F.col("q")) * share
    rest = F.col("k") + F.col("q") - mean
    gain = 2 * F.col("k") * F.log(F.col("k") / mean) + F.when(F.col("q") > 0, 2 * F.col("q") * F.log(F.col("q") / rest)).otherwise(0.0)
    found = (
        counts.where("k > 0")
        .withColumn("gain", gain)
        .where((F.col("gain") >= least_gain) & (F.col("k") / a > least_ratio * (F.col("q") + 0.5) / b))
        .orderBy(F.desc("gain"), "word")
        .limit(WORDS)
    )
    return [r["word"] for r in found.collect()]


def _ordinary_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few windows of each row, spread over it: text to train a dictionary on."""
    for batch in batches:
        for part in slices(batch, "text"):
            data, segments, firsts = _segments(part)
            out = []
            for lo, hi in zip(firsts[:-1], firsts[1:]):
                for k in np.unique(np.linspace(lo, hi - 1, 10).astype(int)) if hi > lo else ():
                    at, size = segments[k].tolist()
                    out.append(data[at : at + size])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["window"])


def _mixed(words: list[str], passes: int = 30) -> list[bytes]:
    """All words again and again, each time in another order, so that every stretch of the samples has most words."""
    shuffled = np.random.default_rng(7)
    return [f" {words[k]} ".encode() for _ in range(passes) for k in shuffled.permutation(len(words))]


def _trained(samples: list[bytes], size: int, segment: int) -> bytes:
    """A trained dictionary, or the samples themselves where there are too few to train one."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[:size]


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    labelled: int = LABELLED,
) -> ToxicityModel:
    """Dictionaries and calibration from the labelled rows for which ``learn`` holds.

    Rows with a null id, label or text are not learnt from. Without rows of either label every text scores
    the share of toxic labels there are, or 0.
    """
    some = F.broadcast(sampled_labels(labels, id_col, label_col, learn, labelled))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    rows = settle(texts.join(some, "id").select("id", "text", "label"), "toxicity-sample")
    words = _toxic_words(rows)
    windows = [r["window"] for r in rows.where("label = 0").mapInArrow(_ordinary_windows, "window binary").collect()]
    model = ToxicityModel(
        _trained(_mixed(words), 16_384, 400) if words else b"",
        _trained(windows, 1_024, 64) if windows else b" ",
        np.zeros(HIGHEST - LOWEST + 1),
        np.zeros(1),
        np.ones(1),
        np.zeros(1),
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                counts = _histograms(model, part)
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), pa.array(list(counts.astype(np.int64)), pa.list_(pa.int64()))],
                    ["label", "counts"],
                )

    found = rows.mapInArrow(measure, "label int, counts array<long>").collect()
    counts = np.array([r["counts"] for r in found], np.float64).reshape(-1, HIGHEST - LOWEST + 1)
    target = np.array([r["label"] for r in found], np.float64)
    toxic, ordinary = counts[target == 1].sum(axis=0) + 1.0, counts[target == 0].sum(axis=0) + 1.0
    model.ratios = np.log(toxic / toxic.sum()) - np.log(ordinary / ordinary.sum())
    inputs = _inputs(counts, model.ratios)
    if not len(inputs):
        inputs, target = _inputs(np.zeros((1, HIGHEST - LOWEST + 1)), model.ratios), np.zeros(1)
    model.centre, model.spread = inputs.mean(axis=0), inputs.std(axis=0) + 1e-9
    model.weights = logistic((inputs - model.centre) / model.spread, target)
    return model


def logistic(inputs: np.ndarray, target: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression, the constant last, by Newton steps."""
    x = np.column_stack([inputs, np.ones(len(inputs))])
    weights = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - target) + ridge * weights)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` for each row: whole texts, null and empty ones as texts without a window.

    Null ids and repeated rows are kept; an empty table gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                inputs = (_inputs(_histograms(own, part), own.ratios) - own.centre) / own.spread
                raw = np.column_stack([inputs, np.ones(len(inputs))]) @ own.weights
                score = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(score)], ["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
