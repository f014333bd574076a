"""Exact order statistics and interpolated quantiles without gathering a column anywhere.

The built-in exact ``percentile`` keeps every distinct value of a column in one aggregation
buffer. Here a sketch first brackets each wanted rank; only values inside a bracket (a few
thousandths of the column) are counted by value, and the rank is read off their running count.
The count below each bracket is exact and checked, so the sketch only decides how much work is
left, never the answer. Each step is one column-pruned scan, and only a few numbers per wanted
quantile reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbtable.functions.columns import nan_to_null
from plumbtable.operators.sketches import even_shares, merged_sketches, shares, sketch_values

# A bracket reaches this share of the column beyond its ranks, over twice the sketch error.
BRACKET_MARGIN = 0.001
# Distinct values one bracket may hand to the running-count window.
RESOLVE_LIMIT = 1_000_000
# Columns up to this size are counted by value as a whole.
SHORT_COLUMN = 20_000
REFINE_POINTS = 200


@dataclass(frozen=True)
class _Bracket:
    """Closed value range for the order statistics ``first..last`` (0-based) of ``column``.

    ``size`` is the expected number of values strictly inside; infinite ends make the whole column.
    ``slack`` is how many sketch points a cut stays away from the rank; it grows with every miss.
    """

    column: str
    first: int
    last: int
    low: float
    high: float
    size: int
    slack: int = 1


@dataclass(frozen=True)
class ColumnRanks:
    """Values of a column: how many, the value at each wanted rank, and how many are not above it."""

    count: int
    values: dict[int, float]
    not_above: dict[int, int]


def quantiles(df: DataFrame, columns: list[str], probs: list[float], exact: bool = True) -> dict[str, list]:
    """Linearly interpolated quantiles per column, nulls skipped; ``None`` for an all-null column.

    ``exact=False`` answers from the sketch alone, in one pass.
    """
    if not columns:
        return {}
    if not exact:
        base = _base(df, columns)
        merged = merged_sketches(base, {c: F.col(c) for c in columns}, {})
        row = merged.select(*[sketch_values(F.col(c), shares(list(probs))).alias(c) for c in columns]).first()
        return {c: list(row[c]) if row[c] is not None else [None] * len(probs) for c in columns}

    def wanted(n: int) -> list[tuple[int, int]]:
        return [(math.floor((n - 1) * p), math.ceil((n - 1) * p)) for p in probs]

    ranked = order_statistics(df, columns, list(probs), wanted)
    out: dict[str, list] = {}
    for c in columns:
        n, values = ranked[c].count, ranked[c].values
        if n == 0:
            out[c] = [None] * len(probs)
            continue
        out[c] = []
        for p, (lo, hi) in zip(probs, wanted(n)):
            a, b = values[lo], values[hi]
            out[c].append(a + (b - a) * ((n - 1) * p - lo) if a != b else a)
    return out


def order_statistics(
    df: DataFrame, columns: list[str], probs: list[float], wanted, spread: float | None = None
) -> dict[str, ColumnRanks]:
    """Exact values at 0-based ranks.

    ``wanted(n)`` gives one ``(first, last)`` rank pair per entry of ``probs``, the share of the
    column at which that pair lies. ``spread`` says the values lie evenly over ``[0, spread)``, as
    hashes do: brackets then need no sketch.
    """
    base = _base(df, columns)
    counts, edges = (_sketched if spread is None else _even)(base, columns, probs, spread)
    brackets = []
    for c in columns:
        for (first, last), p, (low, high) in zip(wanted(counts[c]) if counts[c] else [], probs, edges[c]):
            if counts[c] <= SHORT_COLUMN:
                brackets.append(_whole(c, first, last, counts))
                continue
            # Nothing is presumed about the ends of a column.
            low = -math.inf if p <= BRACKET_MARGIN else low
            high = math.inf if p >= 1 - BRACKET_MARGIN else high
            brackets.append(_Bracket(c, first, last, low, high, math.ceil(counts[c] * 4 * BRACKET_MARGIN)))
    found: dict[str, dict[int, tuple[float, int]]] = {c: {} for c in columns}
    # A bracket the sketch put in the wrong place is started over from the whole column, which holds any rank.
    while brackets:
        missed = _resolve(base, _shrink(base, brackets, counts), found)
        brackets = [_whole(b.column, b.first, b.last, counts) for b in missed]
    return {
        c: ColumnRanks(
            counts[c], {r: v for r, (v, _) in found[c].items()}, {r: n for r, (_, n) in found[c].items()}
        )
        for c in columns
    }


def _sketched(base: DataFrame, columns: list[str], probs: list[float], _) -> tuple[dict, dict]:
    """Value counts, and per column the sketched edges a margin below and above each share."""
    points = shares([e for p in probs for e in (max(0.0, p - BRACKET_MARGIN), min(1.0, p + BRACKET_MARGIN))])
    names = [f"s{i}" for i in range(len(columns))]
    row = (
        merged_sketches(
            base,
            {s: F.col(c) for s, c in zip(names, columns)},
            {f"n{s}": F.count(c) for s, c in zip(names, columns)},
        )
        .select(*[f"n{s}" for s in names], *[sketch_values(F.col(s), points).alias(s) for s in names])
        .first()
    )
    counts = {c: row[f"n{s}"] for s, c in zip(names, columns)}
    return counts, {c: list(zip(row[s][::2], row[s][1::2])) if counts[c] else [] for s, c in zip(names, columns)}


def _even(base: DataFrame, columns: list[str], probs: list[float], spread: float) -> tuple[dict, dict]:
    """Value counts, and the edges that evenly spread values would have."""
    counts = base.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()
    edges = {}
    for c, n in counts.items():
        # Four standard deviations of a share among n even draws.
        margin = max(BRACKET_MARGIN, 2.0 / math.sqrt(n)) if n else 0.0
        edges[c] = [((p - margin) * spread, (p + margin) * spread) for p in probs]
    return counts, edges


def _whole(column: str, first: int, last: int, counts: dict, slack: int = 1) -> _Bracket:
    return _Bracket(column, first, last, -math.inf, math.inf, counts[column], slack)


def _base(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[_clean(df, c).cast("double").alias(c) for c in columns])


def _clean(df: DataFrame, name: str) -> Column:
    return nan_to_null(F.col(name), df.schema[name].dataType)


def _shrink(base: DataFrame, brackets: list[_Bracket], counts: dict) -> list[_Bracket]:
    """Narrow brackets that could hold too many distinct values.

    Counts say what is below, at the lower edge and strictly inside each; a sketch of the strict inside
    then cuts it about a hundredfold per round. Ties at an edge are neither sketched nor counted by
    value, so values that fill a third of the column do not keep a bracket large.
    """
    ready = [b for b in brackets if b.size <= RESOLVE_LIMIT]
    large = [b for b in brackets if b.size > RESOLVE_LIMIT]
    points = even_shares(REFINE_POINTS)
    while large:
        sketched, counted = {}, {}
        for i, b in enumerate(large):
            c = F.col(b.column)
            strict = (c > b.low) & (c < b.high)
            sketched[f"cuts{i}"] = F.when(strict, c)
            counted[f"below{i}"] = F.count_if(c < b.low)
            counted[f"inside{i}"] = F.count_if(c.between(b.low, b.high))
            counted[f"edge{i}"] = F.count_if(c == b.low)
            counted[f"strict{i}"] = F.count_if(strict)
        row = (
            merged_sketches(base, sketched, counted)
            .select(*counted, *[sketch_values(F.col(n), points).alias(n) for n in sketched])
            .first()
        )
        again = []
        for i, b in enumerate(large):
            below, inside, cuts = row[f"below{i}"], row[f"inside{i}"], row[f"cuts{i}"]
            if not (below <= b.first and b.last < below + inside):
                again.append(_whole(b.column, b.first, b.last, counts, b.slack * 4))
                continue
            if row[f"strict{i}"] <= RESOLVE_LIMIT:
                ready.append(b)
                continue
            before, top = below + row[f"edge{i}"], max(row[f"strict{i}"] - 1, 1)
            lo = math.floor((b.first - before) / top * REFINE_POINTS) - b.slack
            hi = max(math.ceil((b.last - before) / top * REFINE_POINTS) + b.slack, 0)
            tight = replace(
                b,
                low=b.low if lo < 0 else cuts[min(lo, REFINE_POINTS)],
                high=b.high if hi > REFINE_POINTS else cuts[hi],
                size=row[f"strict{i}"],
            )
            # Without progress the bracket is counted as it is: slower, still exact and distributed.
            (again if (tight.low, tight.high) != (b.low, b.high) else ready).append(tight)
        large = again
    return ready


def _resolve(base: DataFrame, brackets: list[_Bracket], found: dict) -> list[_Bracket]:
    """Read the wanted ranks off running counts; returns brackets that did not hold theirs.

    Each column's brackets cut it into regions, odd ones inside a bracket. Values inside keep their
    own count, all others count by region, so one pass gives exact ranks and the grouped rows are
    few before the shuffle.
    """
    if not brackets:
        return []
    columns = sorted({b.column for b in brackets})
    ranges = {c: _merged([(b.low, b.high) for b in brackets if b.column == c]) for c in columns}
    wanted = {c: sorted({r for b in brackets if b.column == c for r in (b.first, b.last)}) for c in columns}
    cells = F.array(*[F.struct(F.lit(i).alias("id"), F.col(c).alias("v")) for i, c in enumerate(columns)])
    # Cells are exploded before they are compared, so a costly column expression runs once per row.
    long = base.select(F.inline(cells)).filter("v IS NOT NULL")
    region = F.lit(None).cast("int")
    for i, c in enumerate(columns):
        passed = F.lit(0)
        for low, high in ranges[c]:
            passed = passed + (F.col("v") >= low).cast("int") + (F.col("v") > high).cast("int")
        region = F.when(F.col("id") == i, passed).otherwise(region)
    counts = (
        long.withColumn("region", region)
        .groupBy("id", "region", F.when(F.col("region") % 2 == 1, F.col("v")).alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    running = Window.partitionBy("id").orderBy("region", "v").rowsBetween(Window.unboundedPreceding, 0)
    ranks = F.create_map(
        *[e for i, c in enumerate(columns) for e in (F.lit(i), F.array(*[F.lit(r) for r in wanted[c]]))]
    )
    rows = (
        counts.withColumn("upto", F.sum("n").over(running))
        .filter("v IS NOT NULL")
        .withColumn("rank", F.explode(ranks[F.col("id")]))
        .filter((F.col("rank") >= F.col("upto") - F.col("n")) & (F.col("rank") < F.col("upto")))
        .select("id", "rank", "v", "upto")
        .collect()
    )
    for r in rows:
        found[columns[r["id"]]][r["rank"]] = (r["v"], r["upto"])
    return [b for b in brackets if b.first not in found[b.column] or b.last not in found[b.column]]


def _merged(ranges: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Closed ranges in order, overlapping ones joined."""
    out: list[tuple[float, float]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out
