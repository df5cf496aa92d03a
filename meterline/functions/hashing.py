"""Uniform draws that depend on the row's key alone, so that re-runs and re-partitioning agree."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MD5_SPAN = 1 << 60


def md5_int(*key: Column | str, seed: int = 0) -> Column:
    """60-bit integer from the md5 of the key columns joined by '|'."""
    cols = [F.col(k) if isinstance(k, str) else k for k in key]
    text = F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def md5_uniform(*key: Column | str, seed: int = 0) -> Column:
    """[0, 1) draw, reproducible in any engine that has md5."""
    return md5_int(*key, seed=seed) / F.lit(float(MD5_SPAN))


def fast_uniform(*key: Column) -> Column:
    """[0, 1) draw from xxhash64 for inner loops."""
    return F.xxhash64(*key).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))


def fast_uniform_sql(key: str) -> str:
    """The same draw as SQL text over a list of columns."""
    return f"((xxhash64({key}) & {(1 << 53) - 1}) / {float(1 << 53)!r}e0)"


def exponential(u: Column, mean: float) -> Column:
    return F.lit(-mean) * F.log1p(-u)


def choice(u: Column, values: list, weights: list[float] | None = None) -> Column:
    """One of ``values`` by the draw ``u``."""
    weights = weights or [1.0] * len(values)
    total, acc, out = sum(weights), 0.0, None
    for v, w in zip(values[:-1], weights[:-1]):
        acc += w / total
        out = F.when(u < acc, F.lit(v)) if out is None else out.when(u < acc, F.lit(v))
    return F.lit(values[-1]) if out is None else out.otherwise(F.lit(values[-1]))
