"""The search: waves of trials that train together, judged at rungs, kept in a history."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.binning import MAX_BINS, Binner
from ..operators.boosting import EARLY_STOP, BoostConfig, boost, write_binned
from ..operators.curves import REPORT_EVERY
from ..session import drop_path
from .propose import STARTUP_TRIALS, propose
from .rungs import MAX_REPORTS, REDUCTION, best_trial, rung_cutoffs, rung_levels
from .space import SPACE, draw_configs
from .store import REPORTS, TRIALS, TrialStore

STUDY = "tip_search"


@dataclass
class SearchResult:
    best_config: dict
    best_rmse: float
    n_trials: int
    trials: DataFrame
    reports: DataFrame
    first_trial: int = 0

    def of_run(self) -> SearchResult:
        """Best trial and count among the trials of this run, without those the study held before."""
        own = F.col("trial_id") >= self.first_trial
        return _result(self.trials.filter(own), self.reports.filter(own), self.first_trial)


def _result(trials: DataFrame, reports: DataFrame, first_trial: int) -> SearchResult:
    best = best_trial(reports).first()
    config = trials.filter(F.col("trial_id") == best["trial_id"]).first()
    chosen = {p.name: config[p.name] for p in SPACE}
    return SearchResult(chosen, best["best_rmse"], best["n_trials"], trials, reports, first_trial)


class _Wave:
    """Collects a wave's reports and decides at each rung who goes on."""

    def __init__(self, spark, study, earlier: list[tuple], every, levels, max_reports, seq):
        self.spark, self.study, self.every = spark, study, every
        self.levels, self.max_reports, self.seq = levels, max_reports, seq
        self.earlier, self.rows, self.status = earlier, [], {}

    def __call__(self, round_no: int, live: dict) -> set[int]:
        boost_round = round_no + 1
        if round_no != 0 and boost_round % self.every:
            return set()
        report_no = 1 + (boost_round // self.every if round_no else 0)
        if round_no and self.every == 1:
            report_no = boost_round
        for t in sorted(live):
            rmse = live[t].valid_rmse[-1]
            self.rows.append((self.study, t, report_no, boost_round, rmse, self.seq))
            self.seq += 1
        stop: set[int] = set()
        if report_no in self.levels:
            known = self.spark.createDataFrame(self.earlier + self.rows, REPORTS)
            judged = rung_cutoffs(known, [report_no], REDUCTION).filter("stops")
            stop = {r["trial_id"] for r in judged.select("trial_id").collect()} & set(live)
            self.status.update({t: "pruned" for t in stop})
        if report_no >= self.max_reports:
            stop |= set(live)
        return stop


def _configs(spark: SparkSession, study: str, ids: list[int], history: DataFrame, n_known: int, seed: int):
    """Random draws for a study's first trials, proposals from its history after that."""
    trials = spark.createDataFrame([(study, i) for i in ids], "study string, trial_id int")
    if n_known < STARTUP_TRIALS:
        rows = draw_configs(trials, "trial_id", seed).collect()
    else:
        rows = propose(history, trials, seed).collect()
    return {r["trial_id"]: {p.name: r[p.name] for p in SPACE} for r in rows}


def run(
    train: DataFrame,
    valid: DataFrame,
    n_trials: int = 30,
    wave: int = 8,
    seed: int = 0,
    store: TrialStore | None = None,
    study: str = STUDY,
    report_every: int = REPORT_EVERY,
    max_reports: int = MAX_REPORTS,
    early_stop: int = EARLY_STOP,
    max_bins: int = MAX_BINS,
    overrides: dict | None = None,
) -> SearchResult:
    """Searches for the config of lowest validation error.

    The feature tables are binned and written once; all trials read that table. A study
    that exists in ``store`` goes on where it ended. ``overrides`` pins parameters. The result
    ranks the whole study; its ``of_run`` ranks this run's trials.
    """
    spark = train.sparkSession
    if valid.isEmpty():
        raise ValueError("no validation rows to rank trials by")
    binner = Binner.fit(train, max_bins=max_bins)
    binned, path = write_binned(spark, binner, train, valid)
    trial_rows: list[tuple] = []
    report_rows: list[tuple] = []
    if store is not None:  # a study's own rows: at most 80 reports per trial
        trial_rows = [tuple(r) for r in store.trials(spark, study).collect()]
        report_rows = [tuple(r) for r in store.reports(spark, study).collect()]
    last_round = max_reports * report_every  # the last report ends every trial before that
    first_new = 1 + max([r[1] for r in trial_rows], default=-1)
    todo = list(range(first_new, first_new + n_trials))
    try:
        while todo:
            # Waves of random draws end where proposals can begin.
            missing = STARTUP_TRIALS - len(trial_rows)
            size = min(wave, missing) if missing > 0 else wave
            ids, todo = todo[:size], todo[size:]
            history = spark.createDataFrame(trial_rows, TRIALS).filter(F.col("rmse").isNotNull())
            configs = _configs(spark, study, ids, history, len(trial_rows), seed)
            configs = {t: {**c, **(overrides or {})} for t, c in configs.items()}
            seq = 1 + max([r[5] for r in report_rows], default=-1)
            watch = _Wave(
                spark, study, report_rows, report_every, rung_levels(max_reports), max_reports, seq
            )
            done = boost(
                binned,
                binner,
                {t: BoostConfig.of(c) for t, c in configs.items()},
                max_rounds=last_round,
                early_stop=early_stop,
                seed=seed,
                on_round=watch,
            )
            new = []
            for t, e in sorted(done.items()):
                own = [r for r in watch.rows if r[1] == t]
                status = watch.status.get(t) or ("stalled" if e.stalled(early_stop) else "finished")
                config = asdict(e.config)
                rmse = own[-1][4] if own else None
                new.append((study, t, *[config[p.name] for p in SPACE], status, rmse))
            trial_rows += new
            report_rows += watch.rows
            if store is not None:
                store.append(
                    spark.createDataFrame(new, TRIALS), spark.createDataFrame(watch.rows, REPORTS)
                )
    finally:
        drop_path(spark, path)
    trials = spark.createDataFrame(trial_rows, TRIALS)
    reports = spark.createDataFrame(report_rows, REPORTS)
    return _result(trials, reports, first_new)
