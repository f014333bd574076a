"""Secrets in texts: fixed patterns, and a guess-cost estimate for the values of credential assignments.

A value's guess cost is the least number of bits over all ways to cut it into words of a list, dates, repeats,
keyboard walks and brute-force spans. Only texts that hold a byte or string which every pattern needs are
looked at with regular expressions; that test runs on bytes, for a whole slice at once.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbtable.llm.text import byte_class, flat, slices, word_spans

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Names before a separator that make the value after it a credential.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|api[_-]?key|access[_-]?key|private[_-]?key|auth)"""
    r"""["']?[\x20\t]*(?:=>|:=|[:=])[\x20\t]*(?:"([^"\n]{6,})"|'([^'\n]{6,})'|([^\s"'<>,;]{6,}))""",
    re.I | re.A,
)
KINDS = ("assign", "access", "hex", "guess")
#: Frequent words of passwords and of places where one will be filled in, most frequent first.
COMMON_WORDS = (
    "password passwd secret token admin login user root test example sample dummy change changeme default "
    "your here none null true false required optional enter value string welcome master dragon monkey "
    "shadow sunshine princess football baseball iloveyou letmein summer winter spring autumn january "
    "february march april june july august september october november december monday tuesday wednesday "
    "thursday friday saturday sunday london paris berlin madrid server database system office company "
    "money hello love secure access private public account email phone guest temp temporary placeholder "
    "reset forgot please invalid missing expired empty unknown redacted hidden key pass word"
).split()
_RANKS = {w: i + 1 for i, w in enumerate(dict.fromkeys(COMMON_WORDS))}
_LONGEST = max(map(len, _RANKS))
_PLAIN = str.maketrans("013457@$!", "oleastasi")
_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz")
_DATES = (
    re.compile(r"(?:19|20)\d\d(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])"),
    re.compile(r"(?:19|20)\d\d([-/._])(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])"),
    re.compile(r"(?:0?[1-9]|[12]\d|3[01])([-/._])(?:0?[1-9]|1[0-2])\1(?:19|20)\d\d"),
    re.compile(r"(?:0[1-9]|[12]\d|3[01])(?:0[1-9]|1[0-2])(?:19|20)\d\d"),
    re.compile(r"(?:19|20)\d\d"),
)
_PIECE_BITS = 1.0  # for each cut: where it lies
_LONGEST_PERIOD = 8


def _neighbours() -> set[tuple[str, str]]:
    """Keys beside each other in a row, in either direction, and keys below each other."""
    pairs = set()
    for row in _ROWS:
        pairs.update(zip(row, row[1:]))
    for upper, lower in zip(_ROWS[:3], _ROWS[1:4]):
        pairs.update(zip(upper[1:] if upper[0] == "`" else upper, lower))
    return pairs | {(b, a) for a, b in pairs}


_NEXT_TO = _neighbours()


def _char_bits(c: str) -> float:
    if c.isdigit():
        return math.log2(10)
    return math.log2(26) if c.isalpha() and c.isascii() else math.log2(33) if c.isascii() else 8.0


@lru_cache(maxsize=20_000)
def _unit_bits(unit: str) -> float:
    """Bits of one period of a repeat, which holds no repeats itself. Units are short, so the cache is small."""
    return guess_bits(unit, False)


def guess_bits(value: str, repeats: bool = True) -> float:
    """Bits of the cheapest segmentation of ``value``; 0 for the empty value. Time grows with its length."""
    n = len(value)
    lower = value.lower()
    if len(lower) != n:
        lower = value
    plain = lower.translate(_PLAIN)
    best = [0.0] + [math.inf] * n
    brute = [0.0]
    for c in value:
        brute.append(brute[-1] + _char_bits(c))
    # Brute force from i to j costs brute[j] - brute[i]; its cheapest start is kept while j moves on.
    open_brute = math.inf
    walk = 0  # first key of the walk that ends here
    same = [0] * (_LONGEST_PERIOD + 1)  # characters up to here that equal the one a period before, by period
    dates: dict[int, list[int]] = {}
    for pattern in _DATES:
        for i in range(n):
            if value[i].isdigit() and (found := pattern.match(value, i)):
                dates.setdefault(found.end(), []).append(i)
    for j in range(1, n + 1):
        i = j - 1
        open_brute = min(open_brute, best[i] - brute[i] + (_PIECE_BITS if i else 0.0))
        cost = open_brute + brute[j]
        for k in range(max(0, j - _LONGEST), j - 2):
            rank = _RANKS.get(lower[k:j])
            leet = 0.0
            if rank is None:
                rank, leet = _RANKS.get(plain[k:j]), 2.0
            if rank is not None:
                capitals = sum(c.isupper() for c in value[k:j])
                shape = 0.0 if not capitals else 1.0 if capitals in (1, j - k) else float(j - k)
                cost = min(cost, best[k] + math.log2(rank + 1) + leet + shape + _PIECE_BITS)
        for k in dates.get(j, ()):
            cost = min(cost, best[k] + (math.log2(150) if j - k == 4 else math.log2(365 * 150) + 1) + _PIECE_BITS)
        if i and (lower[i - 1], lower[i]) not in _NEXT_TO:
            walk = i
        if j - walk >= 3:
            cost = min(cost, best[walk] + math.log2(47) + 2 + math.log2(j - walk) + _PIECE_BITS)
        if repeats:
            for period in range(1, min(_LONGEST_PERIOD, i) + 1):
                same[period] = same[period] + 1 if value[i] == value[i - period] else 0
                times = 1 + same[period] // period
                k = j - times * period
                if times >= 2 and j - k >= 3:
                    unit = _unit_bits(value[j - period : j])
                    cost = min(cost, best[k] + unit + math.log2(times) + _PIECE_BITS)
        best[j] = cost
    return best[n]


def _classes(value: str) -> int:
    return sum(
        map(bool, (re.search("[a-z]", value), re.search("[A-Z]", value), re.search("[0-9]", value), re.search("[^a-zA-Z0-9]", value)))
    )


def secret_spans(text: str, least_bits: float = 40.0, least_classes: int = 2) -> list[tuple[int, int, int]]:
    """``start, kind, end`` in code points, by start and kind; the kind indexes ``KINDS``."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    for m in CONTEXT.finditer(text):
        value = m[m.lastindex]
        if _classes(value) >= least_classes and guess_bits(value) >= least_bits:
            spans.append((m.start(m.lastindex), 3, m.end(m.lastindex)))
    return sorted(spans)


_HEX_BYTES = byte_class((0x30, 0x39), (0x61, 0x66))


def _worth_reading(buffer: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows with a separator, a key's prefix or a long run of hex digits; no pattern matches elsewhere."""
    at = [np.flatnonzero((buffer == ord(":")) | (buffer == ord("=")))]
    data = buffer.tobytes()
    at.append(np.array([m.start() for m in re.finditer(b"AKIA", data)], np.int64))
    starts, ends, _ = word_spans(buffer, offsets, _HEX_BYTES)
    at.append(starts[ends - starts >= 16])
    return np.unique(np.searchsorted(offsets, np.concatenate(at), side="right") - 1)


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_bits: float = 40.0,
    least_classes: int = 2,
) -> DataFrame:
    """``id_col, spans array<struct<kind, start, end>>`` for each row, in one pass without a shuffle.

    ``kind`` is assign, access, hex (fixed patterns) or guess (a credential's value of at least ``least_bits``
    and ``least_classes`` kinds of characters). Null and empty texts have no spans; null ids and repeated rows
    are kept; an empty table gives no rows; other columns are not read.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                spans: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for k in _worth_reading(*flat(part.column("text"))).tolist():
                    found = secret_spans(part.column("text")[k].as_py(), least_bits, least_classes)
                    spans[k] = [{"kind": KINDS[kind], "start": start, "end": end} for start, kind, end in found]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(spans, pa.list_(span))], ["id", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"id {kind}, spans array<struct<kind:string,start:long,end:long>>")
    return found.withColumnRenamed("id", id_col)
