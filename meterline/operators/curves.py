"""Tables of per-round error: early stop and the report rows taken from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .boosting import EARLY_STOP

REPORT_EVERY = 25  # fixed value: rounds between two reports


def report_rows(rounds: DataFrame, every: int = REPORT_EVERY) -> DataFrame:
    """Reports of (trial, boost_round, valid_rmse): round 1, then every ``every`` rounds."""
    due = (F.col("boost_round") == 1) | (F.col("boost_round") % every == 0)
    order = Window.partitionBy("trial").orderBy("boost_round")
    return rounds.filter(due).withColumn("report_no", F.row_number().over(order))


def early_stop(rounds: DataFrame, patience: int = EARLY_STOP) -> DataFrame:
    """(trial, best_round, best_rmse, stop_round) of (trial, boost_round, valid_rmse).

    The best round is the first to reach the lowest error seen so far; training ends at the
    first round ``patience`` after it, and later rounds do not count.
    """
    order = Window.partitionBy("trial").orderBy("boost_round")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    best = F.min("valid_rmse").over(before)
    improved = rounds.withColumn(
        "improved", F.when(best.isNull() | (F.col("valid_rmse") < best), F.col("boost_round"))
    )
    tracked = improved.withColumn("best_at", F.max("improved").over(so_far))
    stalled = F.col("boost_round") - F.col("best_at") >= patience
    stop = F.min(F.when(stalled, F.col("boost_round"))).over(Window.partitionBy("trial"))
    counted = tracked.withColumn("stop_round", stop).filter(
        F.col("stop_round").isNull() | (F.col("boost_round") <= F.col("stop_round"))
    )
    return counted.groupBy("trial").agg(
        F.min_by("boost_round", F.struct("valid_rmse", "boost_round")).alias("best_round"),
        F.min("valid_rmse").alias("best_rmse"),
        F.max("stop_round").alias("stop_round"),
    )
