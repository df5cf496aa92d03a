"""Proposals from the trial history: draw where good trials are dense and bad ones are not.

Each parameter is handled on its own unit interval, cut into cells. Trials are counted per
cell and each cell's count is spread over the interval by a kernel, so the work after the
count does not depend on how long the history is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import md5_uniform
from .space import SPACE, Param

# Fixed values of the sampler: random start-up trials, candidates per proposal, share and
# largest number of trials that count as good.
STARTUP_TRIALS = 10
CANDIDATES = 24
GOOD_SHARE = 0.1
GOOD_MAX = 25

CELLS = 32
KERNEL_WIDTH = 0.1


def unit_history(history: DataFrame) -> DataFrame:
    """One row per trial and parameter: its other columns, ``param`` and ``u``."""
    pairs = F.array(
        *[F.struct(F.lit(p.name).alias("param"), p.unit(F.col(p.name)).cast("double").alias("u")) for p in SPACE]
    )
    names = {p.name for p in SPACE}
    return history.select(*[c for c in history.columns if c not in names], F.inline(pairs))


def mark_good(history: DataFrame) -> DataFrame:
    """Adds ``good``: 1 for a study's best tenth of trials (25 at most), else 0."""
    rank = F.row_number().over(Window.partitionBy("study").orderBy("rmse", "trial_id"))
    n_good = F.least(
        F.ceil(F.count("*").over(Window.partitionBy("study")) * GOOD_SHARE), F.lit(GOOD_MAX)
    )
    return history.withColumn("good", (rank <= n_good).cast("int"))


def cell_scores(marked: DataFrame) -> DataFrame:
    """(study, param, cell, good_density, bad_density, score) of (study, param, u, good)."""
    cell = F.least(F.greatest(F.floor(F.col("u") * CELLS), F.lit(0)), F.lit(CELLS - 1)).cast("int")
    counts = marked.groupBy("study", "param", cell.alias("source")).agg(
        F.sum("good").alias("n_good"), F.sum(1 - F.col("good")).alias("n_bad")
    )
    spread = counts.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(CELLS - 1))))
    gap = (F.col("cell") - F.col("source")) / F.lit(float(CELLS)) / F.lit(KERNEL_WIDTH)
    weight = F.exp(F.lit(-0.5) * gap * gap)
    # One trial's worth of uniform prior keeps every cell reachable.
    density = spread.groupBy("study", "param", "cell").agg(
        (F.sum(F.col("n_good") * weight) + 1.0).alias("good_density"),
        (F.sum(F.col("n_bad") * weight) + 1.0).alias("bad_density"),
    )
    whole = Window.partitionBy("study", "param")
    return density.select(
        "study",
        "param",
        "cell",
        (F.col("good_density") / F.sum("good_density").over(whole)).alias("good_density"),
        (F.col("bad_density") / F.sum("bad_density").over(whole)).alias("bad_density"),
    ).withColumn("score", F.log("good_density") - F.log("bad_density"))


def propose(history: DataFrame, trials: DataFrame, seed: int = 0) -> DataFrame:
    """A config per row (study, trial_id) of ``trials``, from (study, trial_id, rmse, params)."""
    scores = cell_scores(unit_history(mark_good(history)))
    order = Window.partitionBy("study", "param").orderBy("cell")
    ladder = (
        scores.withColumn("cum", F.sum("good_density").over(order))
        .groupBy("study", "param")
        .agg(F.sort_array(F.collect_list(F.struct("cell", "cum", "score"))).alias("ladder"))
    )
    tries = trials.select(
        "study", "trial_id", F.explode(F.sequence(F.lit(1), F.lit(CANDIDATES))).alias("k")
    )
    draws = tries.join(ladder, "study").withColumn(
        "u", md5_uniform(F.col("trial_id"), F.col("param"), F.col("k"), seed=seed)
    )
    step = F.least(
        F.size(F.filter("ladder", lambda s: s["cum"] <= F.col("u"))), F.lit(CELLS - 1)
    )
    hit = F.get("ladder", step)
    best = (
        draws.select("study", "trial_id", "param", "k", hit.alias("hit"))
        .groupBy("study", "trial_id", "param")
        .agg(F.max_by("hit.cell", F.struct("hit.score", "k")).alias("cell"))
    )
    inside = md5_uniform(F.col("trial_id"), F.col("param"), F.lit("inside"), seed=seed)
    placed = best.withColumn("u", (F.col("cell") + inside) / F.lit(float(CELLS)))

    def column(p: Param):
        return p.value(F.max(F.when(F.col("param") == p.name, F.col("u")))).alias(p.name)

    return placed.groupBy("study", "trial_id").agg(*[column(p) for p in SPACE])

