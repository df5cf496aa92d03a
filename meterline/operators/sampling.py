"""Samples that do not depend on how the table is partitioned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import MD5_SPAN, md5_int, md5_uniform

# A refinement step of exact_sample looks at 12 of the hash's 60 bits.
_STEP_BITS = 12
_HASH_BITS = 60
# Rows of one prefix that are put in order; more are narrowed down further.
_FEW = 10_000


def bernoulli(df: DataFrame, fraction: float, key: list[Column | str], seed: int = 42) -> DataFrame:
    """Keeps each row with probability ``fraction``; a filter, no shuffle."""
    return df.filter(md5_uniform(*key, seed=seed) < F.lit(float(fraction)))


def cap(
    df: DataFrame, max_rows: int | None, key: list[Column | str], seed: int = 42, total: int | None = None
) -> DataFrame:
    """About ``max_rows`` rows when there are more; None or 0 means no cap.

    ``key`` must tell rows apart: copies of one key are kept or dropped together.
    """
    if not max_rows:
        return df
    total = df.count() if total is None else total
    return df if total <= max_rows else bernoulli(df, max_rows / total, key, seed)


def exact_sample(df: DataFrame, n: int, key: list[Column | str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows without replacement (all rows if there are fewer).

    These are the first n rows in the order of key hash, then hash of the whole row, so the same
    rows whatever the partitions. A global sort-and-limit would send n rows through one task;
    instead counts per hash prefix narrow down where the n-th row lies, all rows before it are
    kept by a plain filter, and only the few rows inside the last prefix are ordered. Where
    more rows share a key hash, their row hashes are narrowed down in the same way; rows that share
    that too are copies, and any of them are counted off.
    """
    if n <= 0:
        return df.limit(0)
    names = df.columns
    part = df.withColumn("_h", md5_int(*key, seed=seed)).withColumn("_r", md5_int(*names, seed=seed))
    kept, need = None, n
    for column in ("_h", "_r"):
        found = _edge(part, column, need)
        if found is None:
            return df
        low, span, need, size = found
        below = part.filter(F.col(column) < low)
        kept = below if kept is None else kept.unionByName(below)
        part = part.filter((F.col(column) >= low) & (F.col(column) < low + span))
        if size <= _FEW:
            return kept.unionByName(part.orderBy("_h", "_r", *names).limit(need)).drop("_h", "_r")
    copies = part.groupBy(*part.columns).agg(F.count("*").alias("_n"))
    before = Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)  # rows of one 60-bit hash
    take = F.least("_n", F.lit(need) - F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_take")
    counted = copies.select(*part.columns, take).filter("_take > 0")
    some = counted.withColumn("_take", F.explode(F.sequence(F.lit(1), F.col("_take")))).drop("_take")
    return kept.unionByName(some).drop("_h", "_r")


def _edge(df: DataFrame, column: str, need: int) -> tuple[int, int, int, int] | None:
    """Range of hashes with the ``need``-th smallest: low, span, rows needed of it, rows in it."""
    low, bits, size = 0, 0, 0
    while bits + _STEP_BITS <= _HASH_BITS:
        shift = _HASH_BITS - bits - _STEP_BITS
        inside = df.select(column).filter((F.col(column) >= low) & (F.col(column) < low + (MD5_SPAN >> bits)))
        counts = inside.groupBy(F.shiftright(column, shift).alias("prefix")).agg(F.count("*").alias("n"))
        so_far = F.sum("n").over(Window.orderBy("prefix"))  # at most 2**12 prefixes
        edge = (
            counts.withColumn("cum", so_far)
            .filter((F.col("cum") >= need) & (F.col("cum") - F.col("n") < need))
            .first()
        )
        if edge is None:
            return None
        need -= edge["cum"] - edge["n"]
        low, bits, size = edge["prefix"] << shift, bits + _STEP_BITS, edge["n"]
        if size <= _FEW:
            break
    return low, MD5_SPAN >> bits, need, size
