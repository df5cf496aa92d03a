"""Splits: by pickup year for tables that are no month files, and at random for comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import md5_uniform


def split_by_year(df: DataFrame, years: dict[str, list[int]]) -> DataFrame:
    """Adds ``split`` from the pickup year; rows of other years are dropped."""
    year = F.year("tpep_pickup_datetime")
    split = None
    for name, ys in years.items():
        split = F.when(year.isin(ys), name) if split is None else split.when(year.isin(ys), name)
    return df.withColumn("split", split).filter(F.col("split").isNotNull())


def split_at_random(
    df: DataFrame, shares: dict[str, float], key: list[Column | str], seed: int = 0
) -> DataFrame:
    """Adds ``split`` by hashed draw in the given shares (they sum to 1)."""
    u, acc, split = md5_uniform(*key, seed=seed), 0.0, None
    for name, share in shares.items():
        acc += share
        split = F.when(u < acc, name) if split is None else split.when(u < acc, name)
    last = list(shares)[-1]
    return df.withColumn("split", split.otherwise(F.lit(last)))


def split_summary(df: DataFrame) -> DataFrame:
    """Rows and mean target per split."""
    return df.groupBy("split").agg(
        F.count("*").alias("n_rows"), F.avg("tip_pct").alias("mean_tip_pct")
    )
