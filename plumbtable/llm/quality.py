"""Quality by positive-unlabelled learning: trusted good documents against unlabelled web text.

The classifier is linear in binned statistics of a text's bytes and words. It minimises the non-negative
unbiased risk: with prior p, positives P and unlabelled texts U,

    p * R_P(good) + max(0, R_U(bad) - p * R_P(bad)),

each R a mean logistic loss. Where the second term falls below zero, a step goes against it, which keeps the
model from fitting unlabelled good texts as bad.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbtable.llm.text import byte_class, flat, lower_ascii, slices, span_hashes, window_hashes, word_spans
from plumbtable.llm.toxicity import logistic, sampled_labels

#: Labelled rows read for trusted positives and the prior, and unlabelled rows; at most twice as many.
LABELLED = 20_000
UNLABELLED = 20_000

_IN_WORD = ~byte_class((0x09, 0x0D), (0x20, 0x20))
_UPPER = byte_class((0x41, 0x5A))
_LETTER = byte_class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_DIGIT = byte_class((0x30, 0x39))
_MARK = byte_class((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
_COMMON_MARK = byte_class((0x22, 0x22), (0x27, 0x29), (0x2C, 0x2E), (0x3A, 0x3B), (0x3F, 0x3F))
#: Statistic and the borders of its bins.
STATISTICS = {
    "upper case among letters": (0.02, 0.05, 0.1, 0.2, 0.35, 0.6),
    "odd marks among bytes": (0.002, 0.005, 0.01, 0.02, 0.04, 0.08, 0.15),
    "digits among bytes": (0.01, 0.03, 0.06, 0.12, 0.25),
    "common marks per word": (0.02, 0.06, 0.15, 0.3, 0.6),
    "words like the one before": (0.01, 0.03, 0.08, 0.2, 0.4),
    "three words in a row seen before": (0.02, 0.05, 0.1, 0.2, 0.35, 0.6),
    "words without a letter": (0.02, 0.05, 0.1, 0.2, 0.4),
    "bytes per word": (3.0, 4.0, 5.0, 6.5, 8.0, 10.0, 14.0),
    "words, logarithm": (0.5, 2.0, 3.5, 5.0, 6.5, 8.0),
}
_SIZE = sum(len(borders) + 1 for borders in STATISTICS.values())


@dataclass
class QualityModel:
    weights: np.ndarray
    constant: float
    prior: float
    slope: float = 1.0
    shift: float = 0.0


def statistics(column: pa.Array) -> np.ndarray:
    """A row of ``STATISTICS`` per text, of whole texts; an empty or null text is all zero."""
    buffer, offsets = flat(column)
    lower = lower_ascii(buffer)
    starts, ends, first = word_spans(buffer, offsets, _IN_WORD)
    words = span_hashes(lower, starts, ends)
    threes = window_hashes(words, 3)

    def per_row(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return (sums[bounds[1:]] - sums[bounds[:-1]]).astype(np.float64)

    letters = _LETTER[buffer]
    size = np.maximum(np.diff(offsets), 1).astype(np.float64)
    count = np.diff(first).astype(np.float64)
    n = np.maximum(count, 1)
    same = np.zeros(len(words), bool)
    same[1:] = words[1:] == words[:-1]
    heads = first[:-1]
    same[heads[heads < len(words)]] = False
    in_words = np.concatenate([[0], np.cumsum(letters, dtype=np.int64)])
    bare = in_words[ends] == in_words[starts]
    repeated = np.zeros(len(count))
    for k, (lo, hi) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if hi - lo > 3:
            repeated[k] = 1 - len(np.unique(threes[lo : hi - 2])) / (hi - lo - 2)
    odd = per_row(_MARK[buffer] & ~_COMMON_MARK[buffer], offsets)
    return np.column_stack(
        [
            per_row(_UPPER[buffer], offsets) / np.maximum(per_row(letters, offsets), 1),
            odd / size,
            per_row(_DIGIT[buffer], offsets) / size,
            per_row(_COMMON_MARK[buffer], offsets) / n,
            per_row(same, first) / n,
            repeated,
            per_row(bare, first) / n,
            np.where(count > 0, per_row(np.ones(len(buffer), bool), offsets) / n, 0),
            np.log1p(count),
        ]
    )


def binned(values: np.ndarray) -> np.ndarray:
    """One column per bin, 1 for the bin that holds the statistic."""
    out = np.zeros((len(values), _SIZE))
    at = 0
    for k, borders in enumerate(STATISTICS.values()):
        out[np.arange(len(values)), at + np.searchsorted(borders, values[:, k], side="right")] = 1
        at += len(borders) + 1
    return out


def non_negative_fit(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int = 800, rate: float = 0.05, ridge: float = 1e-4
) -> tuple[np.ndarray, float]:
    """Weights and constant that minimise the non-negative unbiased risk, by Adam on all rows."""
    p = np.column_stack([positive, np.ones(len(positive))])
    u = np.column_stack([unlabelled, np.ones(len(unlabelled))])
    weights = np.zeros(p.shape[1])
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    squash = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    for t in range(1, rounds + 1):
        at_p, at_u = squash(p @ weights), squash(u @ weights)
        good = prior * (p.T @ (at_p - 1)) / len(p)  # of p * R_P(good)
        bad = (u.T @ at_u) / len(u) - prior * (p.T @ at_p) / len(p)
        risk = -np.log(np.maximum(1 - at_u, 1e-12)).mean() + prior * np.log(np.maximum(1 - at_p, 1e-12)).mean()
        step = good + bad if risk >= 0 else -bad
        step = step + ridge * np.append(weights[:-1], 0)
        mean = 0.9 * mean + 0.1 * step
        square = 0.999 * square + 0.001 * step**2
        weights -= rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-9)
    return weights[:-1], float(weights[-1])


def _statistics_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            values = statistics(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), pa.array(list(values), pa.list_(pa.float64()))], ["label", "statistics"]
            )


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    labelled: int = LABELLED,
    unlabelled: int = UNLABELLED,
) -> QualityModel:
    """Positives are the rows labelled 1 for which ``learn`` holds; unlabelled rows a hash sample of all.

    The sampled rows of both labels fix the slope and shift that turn the linear value into a probability. The prior is the share of label 1 among the learnable rows. Rows with a null id, label or text are not
    learnt from. Without positives or unlabelled texts every text scores the prior, or 1 without any label.
    """
    picked = sampled_labels(labels, id_col, label_col, learn, labelled)
    totals = labels.where(learn).where(F.col(label_col).isNotNull()).agg(
        F.avg(F.col(label_col).cast("double")).alias("prior")
    )
    prior = totals.first()["prior"]
    prior = 1.0 if prior is None else float(prior)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    share = max(1, -(-texts.select("id").count() // unlabelled))
    # One pass: the labelled rows, and the rows of the unlabelled sample (-1) whatever their label.
    marked = texts.join(F.broadcast(picked.distinct()), "id", "left").withColumn(
        "sampled", F.coalesce(F.pmod(F.xxhash64("id", F.lit("unlabelled")), F.lit(share)) == 0, F.lit(False))
    )
    kinds = F.array_compact(F.array(F.col("label"), F.when(F.col("sampled"), -1)))
    rows = marked.where("label is not null or sampled").select("text", F.explode(kinds).alias("label"))
    found = rows.mapInArrow(_statistics_rows, "label int, statistics array<double>").collect()
    sides = {
        k: np.array([r["statistics"] for r in found if r["label"] == k], np.float64).reshape(-1, len(STATISTICS))
        for k in (1, 0, -1)
    }
    if not len(sides[1]) or not len(sides[-1]):
        return QualityModel(np.zeros(_SIZE), float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))), prior)
    weights, constant = non_negative_fit(binned(sides[1]), binned(sides[-1]), min(prior, 0.999))
    model = QualityModel(weights, constant, prior)
    if len(sides[0]):
        values = np.concatenate([binned(sides[k]) @ weights + constant for k in (1, 0)])
        target = np.repeat([1.0, 0.0], [len(sides[1]), len(sides[0])])
        model.slope, model.shift = logistic(values[:, None], target).tolist()
    return model


def _scores(model: QualityModel, column: pa.Array) -> np.ndarray:
    values = binned(statistics(column)) @ model.weights + model.constant
    return 1 / (1 + np.exp(-np.clip(model.slope * values + model.shift, -30, 30)))


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` for each row: whole texts, null and empty ones as a text without words.

    Null ids and repeated rows are kept; an empty table gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                score = _scores(shared.value, part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(score)], ["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, model: QualityModel, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [f"c{k}" for k in range(batch.num_columns)]
            for part in slices(pa.RecordBatch.from_arrays(batch.columns, names), names[place]):
                kept = part.filter(pa.array(_scores(shared.value, part.column(place)) >= least))
                yield pa.RecordBatch.from_arrays(kept.columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
