"""Rung-based early termination over a table of trial reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the scheduler: reports a trial may give, first rung, and the share
# (1 / REDUCTION) of earlier arrivals a trial must be among.
MAX_REPORTS = 80
GRACE_REPORTS = 2
REDUCTION = 3


def rung_levels(
    max_reports: int = MAX_REPORTS, grace: int = GRACE_REPORTS, reduction: int = REDUCTION
) -> list[int]:
    """Report numbers at which trials are judged: 2, 6, 18, 54 by default."""
    out, level = [], grace
    while level <= max_reports:
        out.append(level)
        level *= reduction
    return out


def rung_cutoffs(reports: DataFrame, levels: list[int], reduction: int = REDUCTION) -> DataFrame:
    """Reports at a rung with the error to beat and whether the trial stops there.

    ``reports`` has (study, trial_id, report_no, valid_rmse, seq). Each arrival is judged
    against those before it at the same rung; the first one passes.
    """
    earlier = (
        Window.partitionBy("study", "report_no")
        .orderBy("seq")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    at_rung = reports.filter(F.col("report_no").isin(levels))
    judged = at_rung.withColumn("cutoff", F.percentile("valid_rmse", 1.0 / reduction).over(earlier))
    return judged.withColumn("stops", F.coalesce(F.col("valid_rmse") > F.col("cutoff"), F.lit(False)))


def survivors(reports: DataFrame, levels: list[int], reduction: int = REDUCTION) -> DataFrame:
    """Judges a full report table rung by rung: (study, report_no, trial_id, cutoff, stops).

    A trial stopped at a rung is not counted at later ones.
    """
    judged, running = None, reports
    for level in levels:
        here = rung_cutoffs(running, [level], reduction)
        rows = here.select("study", "report_no", "trial_id", "valid_rmse", "cutoff", "stops")
        judged = rows if judged is None else judged.unionByName(rows)
        out = here.filter("stops").select("study", "trial_id")
        running = running.join(out, ["study", "trial_id"], "left_anti")
    return judged


def synchronous_keep(reports: DataFrame, level: int, reduction: int = REDUCTION) -> DataFrame:
    """Trials kept when a rung is judged all at once: the best 1/``reduction`` of it."""
    w = Window.partitionBy("study").orderBy("valid_rmse")
    at_rung = reports.filter(F.col("report_no") == level)
    return (
        at_rung.withColumn("share", F.percent_rank().over(w))
        .filter(F.col("share") <= 1.0 / reduction)
        .drop("share")
    )


def best_trial(reports: DataFrame, scope: str = "last") -> DataFrame:
    """(study, trial_id, best_rmse, n_trials): the lowest last report, or lowest report ever."""
    value = F.max_by("valid_rmse", "report_no") if scope == "last" else F.min("valid_rmse")
    per_trial = reports.groupBy("study", "trial_id").agg(value.alias("rmse"))
    return per_trial.groupBy("study").agg(
        F.min_by("trial_id", F.struct("rmse", "trial_id")).alias("trial_id"),
        F.min("rmse").alias("best_rmse"),
        F.count("*").alias("n_trials"),
    )
