"""Exact-size random splits that do not depend on partitioning.

Rows are ranked by a hash of their key, and the cut is an exact order statistic of that hash, so
both sides are plain filters: no global sort, no row number, no collected sample. Rows that share
a key land on the same side.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbtable.functions.columns import digest_number, key_digest, key_text
from plumbtable.operators.quantiles import order_statistics

_HASH = "__split_hash"
HASH_SPREAD = 2.0**52


def _cuts(df: DataFrame, keys: list[str], shares: list[float], seed: int) -> list[tuple]:
    """For each share, the hash of the last row among the first ``ceil(share * n)``.

    Where that cut would fall between rows of one hash value, the key text that splits them comes
    with it, else ``None``.
    """
    hashed = df.select(digest_number(key_digest(keys, seed)).alias(_HASH), key_text(keys).alias("__key"))

    def wanted(n: int) -> list[tuple[int, int]]:
        return [(max(math.ceil(s * n) - 1, 0),) * 2 for s in shares]

    got = order_statistics(hashed, [_HASH], shares, wanted, spread=HASH_SPREAD)[_HASH]
    if got.count == 0:
        return []
    ranks = [first for first, _ in wanted(got.count)]
    cuts = [(int(got.values[r]), None) for r in ranks]
    inside = [i for i, r in enumerate(ranks) if got.not_above[r] != r + 1]
    if inside:
        # Copies of a key, or the few keys that share 52 hash bits: one row per key.
        tied = (
            hashed.filter(F.col(_HASH).isin([cuts[i][0] for i in inside]))
            .groupBy(_HASH, "__key")
            .agg(F.count(F.lit(1)).alias("n"))
            .collect()
        )
        for i in inside:
            value = cuts[i][0]
            here = sorted((t["__key"], t["n"]) for t in tied if t[_HASH] == value)
            left = ranks[i] - (got.not_above[ranks[i]] - sum(n for _, n in here))
            for key, n in here:
                if left < n:
                    cuts[i] = (value, key)
                    break
                left -= n
    return cuts


def _upto(keys: list[str], seed: int, cut: tuple) -> Column:
    """Rows up to a cut. Digests compare as text, so the filter does not convert them."""
    digest, edge = key_digest(keys, seed), F.lit(f"{cut[0]:013x}")
    if cut[1] is None:
        return digest <= edge
    return (digest < edge) | ((digest == edge) & (key_text(keys) <= F.lit(cut[1])))


def train_test_split(
    df: DataFrame, keys: list[str], test_size: float = 0.2, seed: int = 42, exact: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Random (train, test) with exactly ``ceil(test_size * n)`` test rows when the key is unique.

    ``exact=False`` cuts at a fixed hash value instead: no pass over the data, sizes within
    sampling error.
    """
    if not 0 < test_size < 1:
        raise ValueError(f"test_size must lie between 0 and 1, got {test_size}")
    if exact:
        cuts = _cuts(df, keys, [test_size], seed)
        is_test = _upto(keys, seed, cuts[0]) if cuts else F.lit(False)
    else:
        is_test = key_digest(keys, seed) < F.lit(f"{int(test_size * HASH_SPREAD):013x}")
    return df.filter(~is_test), df.filter(is_test)


def with_folds(df: DataFrame, keys: list[str], k: int, seed: int = 42, name: str = "fold") -> DataFrame:
    """Add fold numbers 0..k-1 of equal size (within one row), fixed by key and seed."""
    if k < 2:
        raise ValueError(f"k must be at least 2, got {k}")
    cuts = _cuts(df, keys, [i / k for i in range(1, k)], seed)
    fold = F.lit(k - 1)
    for i, cut in reversed(list(enumerate(cuts))):
        fold = F.when(_upto(keys, seed, cut), F.lit(i)).otherwise(fold)
    return df.withColumn(name, fold)
