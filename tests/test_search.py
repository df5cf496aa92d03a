import os

import pytest
from pyspark.sql import functions as F

from meterline.operators import curves
from meterline.operators.features import clean_and_featurize
from meterline.search import rungs, runner
from meterline.search.propose import propose
from meterline.search.space import SPACE, draw_configs
from meterline.search.store import REPORTS, TRIALS, TrialStore
from meterline.sources.synthetic import month_trips


def test_rung_levels():
    assert rungs.rung_levels() == [2, 6, 18, 54]


def test_hand_case_of_cutoffs(spark):
    rows = [("s", i, 2, 25, v, i) for i, v in enumerate([0.30, 0.20, 0.25, 0.10, 0.22])]
    got = rungs.rung_cutoffs(spark.createDataFrame(rows, REPORTS), [2]).orderBy("seq").collect()
    cutoffs = [r["cutoff"] for r in got]
    assert cutoffs[0] is None
    assert cutoffs[1:] == pytest.approx([0.30, 0.2333333, 0.2333333, 0.20], abs=1e-6)
    assert [r["stops"] for r in got] == [False, False, True, False, True]


def test_stopped_trials_do_not_count_at_later_rungs(spark):
    rows = [("s", t, r, 25 * r, v, 10 * r + t) for r in (2, 6) for t, v in enumerate([0.3, 0.1, 0.2])]
    got = rungs.survivors(spark.createDataFrame(rows, REPORTS), [2, 6]).collect()
    assert sorted((r["report_no"], r["trial_id"]) for r in got) == [(2, 0), (2, 1), (2, 2), (6, 0), (6, 1)]


def test_best_trial_scopes(spark):
    rows = [("s", 0, 1, 1, 0.1, 0), ("s", 0, 2, 25, 0.4, 1), ("s", 1, 1, 1, 0.3, 2)]
    df = spark.createDataFrame(rows, REPORTS)
    assert tuple(rungs.best_trial(df).first())[1:] == (1, 0.3, 2)
    assert tuple(rungs.best_trial(df, "min").first())[1:] == (0, 0.1, 2)


def test_early_stop_curve(spark):
    values = [5.0, 4.0, 4.5, 4.2, 4.1, 3.0]
    df = spark.createDataFrame([(1, i + 1, v) for i, v in enumerate(values)], "trial int, boost_round int, valid_rmse double")
    assert tuple(curves.early_stop(df, 3).first()) == (1, 2, 4.0, 5)
    assert tuple(curves.early_stop(df, 4).first()) == (1, 6, 3.0, None)


def test_space_ranges(spark):
    got = draw_configs(spark.range(2000).withColumnRenamed("id", "trial_id"), seed=3)
    for p in SPACE:
        lo, hi = got.agg(F.min(p.name), F.max(p.name)).first()
        assert p.low <= lo and (hi < p.high)
        assert got.filter(~p.unit(F.col(p.name)).between(0, 1)).count() == 0


def test_proposals_follow_good_trials(spark):
    """Trials are good when the learning rate is high; proposals should go there."""
    ids = spark.range(60).select(F.col("id").cast("int").alias("trial_id"))
    history = draw_configs(ids, seed=8).withColumn("study", F.lit("s")).withColumn("rmse", 1 - F.col("learning_rate"))
    todo = spark.range(100, 130).select(F.lit("s").alias("study"), F.col("id").cast("int").alias("trial_id"))
    got = propose(history, todo, seed=1)
    assert got.count() == 30
    assert got.filter("learning_rate > 0.1").count() >= 25


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    out = []
    for month, n in (((2023, 4), 2500), ((2024, 1), 1000)):
        path = str(tmp_path_factory.mktemp("s") / "t")
        clean_and_featurize(month_trips(spark, month, n, seed=4)).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_search_prunes_resumes_and_repeats(spark, tables, tmp_path):
    store = TrialStore(str(tmp_path / "history"))
    options = dict(
        wave=4, seed=2, report_every=1, max_reports=3, max_bins=16, overrides={"max_depth": 2}
    )
    first = runner.run(*tables, n_trials=4, store=store, study="a", **options)
    assert first.n_trials == 4
    reports = first.reports.collect()
    per_trial = {t: [r["report_no"] for r in reports if r["trial_id"] == t] for t in range(4)}
    assert all(v[:2] == [1, 2] for v in per_trial.values())
    judged = rungs.rung_cutoffs(first.reports, [2]).filter("stops").select("trial_id").collect()
    pruned = {r["trial_id"] for r in judged}
    assert pruned and all((len(v) == 2) == (t in pruned) for t, v in per_trial.items())
    status = {r["trial_id"]: r["status"] for r in first.trials.collect()}
    assert {t for t, s in status.items() if s == "pruned"} == pruned
    again = runner.run(*tables, n_trials=4, study="b", **options)
    key = ["trial_id", "report_no"]
    a = [r["valid_rmse"] for r in first.reports.orderBy(*key).collect()]
    b = [r["valid_rmse"] for r in again.reports.orderBy(*key).collect()]
    assert a == pytest.approx(b, abs=1e-12)
    more = runner.run(*tables, n_trials=1, store=store, study="a", **options)
    assert more.n_trials == 5
    own = more.of_run()
    assert own.n_trials == 1 and [r["trial_id"] for r in own.trials.collect()] == [4]
    assert own.best_rmse >= more.best_rmse
    with pytest.raises(ValueError, match="no validation rows"):
        runner.run(tables[0], tables[1].limit(0), n_trials=1, **options)
    assert store.trials(spark, "a").count() == 5 and store.trials(spark, "none").count() == 0
    assert set(more.best_config) == {p.name for p in SPACE}


def test_a_broken_append_leaves_nothing(spark, tmp_path):
    """Trials and reports come in one commit; one whose write broke off is not read."""
    store = TrialStore(str(tmp_path / "history"))
    p = [4, 0.1, 0.8, 0.8, 1.0, 1.0, 0.0, 4]
    trials = lambda i: spark.createDataFrame([("a/b c", i, *p, "finished", 0.5)], TRIALS)
    reports = lambda i: spark.createDataFrame([("a/b c", i, 1, 1, 0.6, 2 * i), ("a/b c", i, 2, 25, 0.5, 2 * i + 1)], REPORTS)
    for i in range(3):
        store.append(trials(i), reports(i))
    assert store.trials(spark, "a/b c").count() == 3 and store.reports(spark).count() == 6
    broken = next(c for c in store.commits(spark) if spark.read.parquet(c).first()["trial_id"] == 1)
    os.remove(f"{broken}/_SUCCESS")
    assert sorted(r["trial_id"] for r in store.trials(spark, "a/b c").collect()) == [0, 2]
    assert sorted({r["trial_id"] for r in store.reports(spark, "a/b c").collect()}) == [0, 2]
    assert store.trials(spark).columns == trials(0).columns and store.reports(spark).columns == reports(0).columns
    store.append(trials(7), spark.createDataFrame([], REPORTS))  # a trial without reports
    assert store.trials(spark).count() == 3 and store.reports(spark).count() == 4
