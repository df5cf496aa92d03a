"""The training loop against a plain numpy grower, and the properties of its models."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline import schema as S
from meterline.operators import boosting as B
from meterline.operators import model as model_module
from meterline.operators.binning import Binner, bin_edges, bucket_counts
from meterline.operators.features import clean_and_featurize
from meterline.operators.fit import fit, fit_final
from meterline.operators.histogram import LOGISTIC
from meterline.operators.model import Model
from meterline.operators.roundlog import RoundLog
from meterline.sources.synthetic import month_trips

BINNER = Binner(("a", "b"), ((1.0, 2.0, 3.0), (0.5,)), ("PULocationID", "VendorID"), (265, 4))


@pytest.fixture(scope="module")
def small(spark):
    """600 rows with two numeric columns (b has gaps) and two categorical ones."""
    rng = np.random.default_rng(3)
    n = 600
    a = rng.integers(0, 5, n).astype(float)
    b = np.where(rng.random(n) < 0.2, np.nan, rng.random(n))
    zone = rng.integers(-1, 12, n)
    vendor = rng.integers(0, 4, n)
    y = 0.1 * a - 0.3 * (np.nan_to_num(b, nan=0.9) > 0.5) + 0.2 * (zone % 3 == 0) + 0.1 * (vendor == 2)
    y = (y + 0.02 * rng.normal(size=n)).astype(np.float32)
    rows = [
        (float(p), None if np.isnan(q) else float(q), None if z < 0 else int(z), int(v), float(t), i)
        for i, (p, q, z, v, t) in enumerate(zip(a, b, zone, vendor, y))
    ]
    df = spark.createDataFrame(rows, "a double, b double, PULocationID int, VendorID int, y double, i int")
    return df.repartition(3)


def numpy_tree(codes, g, c, sizes, first_cat, stride):
    """Grows one tree level by level on whole arrays; returns each row's leaf weight."""
    leaf = np.zeros(len(g))

    def t(x):
        return np.sign(x) * max(abs(x) - c.reg_alpha, 0.0)

    def score(x, h):
        return t(x) ** 2 / (h + c.reg_lambda)

    def grow(rows, depth):
        G, H = g[rows].sum(), len(rows)
        leaf[rows] = -c.learning_rate * t(G) / (H + c.reg_lambda)
        if depth == c.max_depth:
            return
        best = (1e-6, None)
        for f in range(codes.shape[1]):
            x = codes[rows, f]
            present = [int(v) for v in np.unique(x) if v > 0]
            onehot = f >= first_cat and sizes[f - first_cat] < c.max_cat_to_onehot
            if f >= first_cat and not onehot:
                present.sort(key=lambda v: (g[rows][x == v].sum() / ((x == v).sum() + c.reg_lambda), v))
            for k, v in enumerate(present):
                right = {v} if onehot else set(present[k + 1 :])
                for missing_right in (True, False):
                    go = np.isin(x, list(right)) | ((x == 0) & missing_right)
                    hr, hl = go.sum(), (~go).sum()
                    if min(hl, hr) < max(1, c.min_child_weight):
                        continue
                    gr = g[rows][go].sum()
                    gain = score(G - gr, hl) + score(gr, hr) - score(G, H)
                    if gain > best[0] + 1e-9:
                        best = (gain, go)
        if best[1] is not None:
            grow(rows[~best[1]], depth + 1)
            grow(rows[best[1]], depth + 1)

    grow(np.arange(len(g)), 0)
    return leaf


@pytest.mark.parametrize(
    "config",
    [
        B.BoostConfig(max_depth=3, learning_rate=0.5),
        B.BoostConfig(max_depth=2, learning_rate=0.3, reg_alpha=0.4, reg_lambda=5.0, min_child_weight=20),
        B.BoostConfig(max_depth=6, learning_rate=0.3, max_cat_to_onehot=5),
    ],
)
def test_trees_equal_brute_force(spark, small, config, monkeypatch):
    binned, path = B.write_binned(spark, BINNER, small, small.limit(0), "y")
    rows = BINNER.transform(small, keep=["y", "i"]).orderBy("i").toPandas()
    y = rows["y"].to_numpy()
    codes = np.array(rows["codes"].tolist()) - np.arange(4) * BINNER.stride
    e = B.boost(binned, BINNER, {0: config}, max_rounds=3)[0]
    pred = np.full(len(y), e.base)
    assert e.base == pytest.approx(y.mean())
    for r in range(3):
        pred += numpy_tree(codes, pred - y, config, (265, 4), 2, BINNER.stride)
        assert e.train_rmse[r] == pytest.approx(np.sqrt(np.mean((pred - y) ** 2)), abs=1e-9)
    model = Model(BINNER, e)
    e.best_round = 2
    scored = model.score(small, keep=["i"]).orderBy("i").toPandas()["prediction"]
    assert np.allclose(scored, pred, atol=1e-9)
    monkeypatch.setattr(model_module, "_BLOCK_BYTES", 1)  # every tree is a block of its own
    assert len(model._blocks()) == 3
    blockwise = model.score(small, keep=["i"]).orderBy("i").toPandas()["prediction"]
    assert np.allclose(blockwise, pred, atol=1e-9)


def test_edges_are_quantiles(spark):
    df = spark.range(1, 4097).select(
        F.col("id").cast("double").alias("v"), (F.col("id") % 3).cast("double").alias("w")
    )
    got = {(r["pos"], r["edge"]) for r in bin_edges(df, ["v", "w"], max_bins=8).collect()}
    assert {e for p, e in got if p == 0} == {512.0 * j for j in range(1, 8)}
    assert {e for p, e in got if p == 1} == {1.0, 2.0}


def test_edges_are_exact_among_near_values(spark):
    """Values alike in their leading digits are still told apart, with infinities at the ends."""
    rng = np.random.default_rng(5)
    v = np.r_[100_000 + rng.integers(0, 900, 5000), rng.normal(size=3000), np.inf, -np.inf].astype(float)
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,), (float("nan"),)], "v double")
    got = {r["edge"] for r in bin_edges(df, ["v"], max_bins=16).collect()}
    order = np.sort(v)
    want = {order[-(-j * len(v) // 16) - 1] for j in range(1, 16)}
    assert got == want - {order[0]}


def test_wide_codes(spark):
    many = Binner(("a",), (tuple(float(i) for i in range(40_000)),), (), ())
    df = spark.createDataFrame([(39_999.5,)], "a double")
    assert many.code_type == "int" and many.transform(df).first()["codes"] == [40_001]  # 0 is missing


def test_bins_of_missing_and_extremes(spark):
    df = spark.createDataFrame(
        [(None, float("nan"), None, None), (-9.0, 0.5, 0, 3), (99.0, 0.49, 264, 0), (2.0, 0.6, 5, 1)],
        "a double, b double, PULocationID int, VendorID int",
    )
    s = BINNER.stride
    got = [[c - f * s for f, c in enumerate(r["codes"])] for r in BINNER.transform(df).collect()]
    assert got == [[0, 0, 0, 0], [1, 2, 1, 4], [4, 1, 265, 1], [3, 2, 6, 2]]


def test_row_keys_are_unique_and_repeat(spark, small):
    a, _ = B.write_binned(spark, BINNER, small, small, "y")
    b, _ = B.write_binned(spark, BINNER, small, small, "y")
    keys = sorted(r["key"] for r in a.select("key").collect())
    assert len(set(keys)) == 1200
    assert keys == sorted(r["key"] for r in b.select("key").collect())


def test_trials_trained_together_equal_those_trained_alone(spark, small):
    binned, _ = B.write_binned(spark, BINNER, small, small.filter("i % 4 = 0"), "y")
    configs = {
        0: B.BoostConfig(max_depth=2, subsample=0.7),
        3: B.BoostConfig(max_depth=5, learning_rate=0.1, colsample_bytree=0.5),
    }
    together = B.boost(binned, BINNER, configs, max_rounds=3, seed=9, cut_every=2)
    for t, c in configs.items():
        alone = B.boost(binned, BINNER, {t: c}, max_rounds=3, seed=9, cut_every=50)[t]
        assert together[t].valid_rmse == pytest.approx(alone.valid_rmse, abs=1e-12)
    assert together[0].valid_rmse != together[3].valid_rmse


def test_stops(spark, small):
    binned, _ = B.write_binned(spark, BINNER, small, small.limit(3), "y")
    e = B.boost(binned, BINNER, {0: B.BoostConfig(max_depth=6, learning_rate=1.0)}, 40, early_stop=2)[0]
    n = len(e.valid_rmse)
    assert n < 40 and e.best_round == int(np.argmin(e.valid_rmse)) == n - 3
    seen = []
    two = {0: B.BoostConfig(max_depth=1), 1: B.BoostConfig(max_depth=1)}

    def watch(r, live):
        seen.append(sorted(live))
        return {0} if r == 1 else set()

    B.boost(binned, BINNER, two, max_rounds=4, on_round=watch)
    assert seen == [[0, 1], [0, 1], [1], [1]]


@pytest.fixture(scope="module")
def months(spark, tmp_path_factory):
    out = {}
    for name, month, n in (("train", (2023, 4), 24_000), ("valid", (2024, 1), 6000), ("test", (2024, 4), 6000)):
        path = str(tmp_path_factory.mktemp(name) / "t")
        clean_and_featurize(month_trips(spark, month, n, seed=4, partitions=2)).write.parquet(path)
        out[name] = spark.read.parquet(path)
    return out


def test_finds_the_signal(spark, months, tmp_path):
    config = {"max_depth": 3, "learning_rate": 0.4, "min_child_weight": 300.0}
    model, metrics = fit_final(
        months["train"], months["valid"], months["test"], config, max_rounds=6, max_bins=32
    )
    m = metrics.first()
    assert m["test_rmse"] < m["baseline_rmse"] and m["improvement_pct"] > 0
    assert m["n_test"] == months["test"].count()
    rounds = model.ensemble.train_rmse
    assert rounds == sorted(rounds, reverse=True)
    top = model.top_gains(spark, 21).collect()
    assert len(top) == 21 and [r["gain"] for r in top] == sorted([r["gain"] for r in top], reverse=True)
    assert {r["feature"] for r in top} == set(S.FEATURES)
    model.save(spark, str(tmp_path / "m"))
    again = Model.load(spark, str(tmp_path / "m"))
    assert again.ensemble.config == model.ensemble.config
    a = model.score(months["test"]).agg(F.sum("prediction")).first()[0]
    b = again.score(months["test"]).agg(F.sum("prediction")).first()[0]
    assert a == pytest.approx(b, rel=1e-12)


def test_no_rows_is_an_error(spark, months):
    with pytest.raises(ValueError, match="no train rows"):
        fit(months["train"].limit(0), months["valid"], {}, max_rounds=1)


def test_row_draws_do_not_depend_on_the_partitions(spark, small):
    runs = []
    for parts in (2, 5):
        binned, _ = B.write_binned(spark, BINNER, small.repartition(parts), small, "y")
        e = B.boost(binned, BINNER, {0: B.BoostConfig(max_depth=3, subsample=0.5)}, max_rounds=3, seed=4)[0]
        runs.append(e.valid_rmse)
    assert runs[0] == pytest.approx(runs[1], abs=1e-12)


def same_trees(a, b):
    assert len(a.trees) == len(b.trees)
    for x, y in zip(a.trees, b.trees):
        assert (x.place, x.feature, x.child, x.right) == (y.place, y.feature, y.child, y.right)
        assert x.weight == pytest.approx(y.weight, abs=1e-12) and x.gain == pytest.approx(y.gain, abs=1e-9)
    assert a.valid_rmse == pytest.approx(b.valid_rmse, abs=1e-12) and a.best_round == b.best_round


class Killed(Exception):
    pass


@pytest.mark.parametrize("every", [1, 2, 10])
def test_a_broken_fit_goes_on_from_its_log(spark, small, tmp_path, every):
    """Killed in round 3: the rounds before the last commit are not trained again, the trees are the same."""
    binned, _ = B.write_binned(spark, BINNER, small, small.filter("i % 3 = 0"), "y")
    configs = {
        0: B.BoostConfig(max_depth=3, subsample=0.7, colsample_bytree=0.75),
        4: B.BoostConfig(max_depth=2, learning_rate=0.9),
    }
    folder = str(tmp_path / "log")
    seen = []

    def watch(kill):
        def on_round(r, live):
            seen.append(r)
            if r == kill:
                raise Killed
            return {4} if r == 1 else set()  # one trial is stopped on the way

        return on_round

    whole = B.boost(binned, BINNER, configs, max_rounds=6, seed=5, on_round=watch(None))
    seen.clear()
    with pytest.raises(Killed):
        B.boost(binned, BINNER, configs, max_rounds=6, seed=5, on_round=watch(3), cut_every=every, log=RoundLog(folder))
    seen.clear()
    again = B.boost(binned, BINNER, configs, max_rounds=6, seed=5, on_round=watch(None), cut_every=every, log=RoundLog(folder))
    assert seen[0] == {1: 3, 2: 2, 10: 0}[every]
    for t in configs:
        same_trees(whole[t], again[t])
    seen.clear()
    third = B.boost(binned, BINNER, configs, max_rounds=6, seed=5, on_round=watch(0), log=RoundLog(folder))
    assert seen == []  # all rounds are there
    same_trees(whole[0], third[0])


def test_only_finished_commits_count(spark, small, tmp_path):
    binned, _ = B.write_binned(spark, BINNER, small, small.limit(0), "y")
    folder = tmp_path / "log"
    config = {0: B.BoostConfig(max_depth=2)}
    whole = B.boost(binned, BINNER, config, max_rounds=4, cut_every=1, log=RoundLog(str(folder)))[0]
    (folder / "rounds-000002" / "_SUCCESS").unlink()  # its write broke off; the commit after it has no base
    seen = []
    again = B.boost(
        binned, BINNER, config, max_rounds=4, cut_every=1, log=RoundLog(str(folder)), on_round=lambda r, _: seen.append(r) or set()
    )[0]
    assert seen == [2, 3]
    same_trees(whole, again)
    with pytest.raises(ValueError, match="another fit"):
        B.boost(binned, BINNER, {0: B.BoostConfig(max_depth=3)}, max_rounds=4, log=RoundLog(str(folder)))


def test_fit_with_a_log(spark, months, tmp_path):
    options = dict(max_rounds=3, max_bins=16, commit_every=1)
    folder = str(tmp_path / "fit")

    def kill(r, live):
        if r == 1:
            raise Killed
        return set()

    with pytest.raises(Killed):
        fit(months["train"], months["valid"], {"max_depth": 2}, on_round=kill, log_folder=folder, **options)
    again = fit(months["train"], months["valid"], {"max_depth": 2}, log_folder=folder, **options)
    same_trees(fit(months["train"], months["valid"], {"max_depth": 2}, **options).ensemble, again.ensemble)


def test_light_nodes_move_to_their_task(spark, small, monkeypatch):
    """Past a number of nodes rows are laid out by node: the same trees, whichever nodes that takes."""
    binned, _ = B.write_binned(spark, BINNER, small, small.filter("i % 4 = 0"), "y")
    configs = {1: B.BoostConfig(max_depth=12, learning_rate=0.8, reg_lambda=0.1), 2: B.BoostConfig(max_depth=5, subsample=0.8)}
    want = B.boost(binned, BINNER, configs, max_rounds=2)
    assert max(t.depth for t in want[1].trees) >= 9
    for most in (0, 1, 3):
        monkeypatch.setattr(B, "_MOST_NODES", most)
        got = B.boost(binned, BINNER, configs, max_rounds=2)
        for t in configs:
            same_trees(want[t], got[t])


def test_logistic_objective(spark, small):
    """Trees on first and second derivatives of the log loss, against the plain formulas."""
    df = small.withColumn("y", (F.col("y") > 0.1).cast("double"))
    binned, _ = B.write_binned(spark, BINNER, df, df.filter("i % 3 = 0"), "y")
    config = B.BoostConfig(max_depth=2, learning_rate=0.6, min_child_weight=2.0)
    e = B.boost(binned, BINNER, {0: config}, max_rounds=3, objective=LOGISTIC)[0]
    rows = BINNER.transform(df, keep=["y", "i"]).orderBy("i").toPandas()
    y, codes = rows["y"].to_numpy(), np.array(rows["codes"].tolist())
    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    assert e.base == pytest.approx(margin[0])
    leaf, weight = B.walker(e.trees, BINNER.stride)
    for r, tree in enumerate(e.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = leaf(r, codes.astype(np.int64))
        first = sum(len(t.feature) for t in e.trees[:r])
        for n in np.unique(node):
            own = node == n
            assert weight[n] == pytest.approx(-0.6 * g[own].sum() / (h[own].sum() + 1), abs=1e-9)
            assert tree.cover[n - first] == pytest.approx(h[own].sum(), abs=1e-9) and h[own].sum() >= 2.0
        margin += weight[node]
        loss = np.mean(np.logaddexp(0, margin) - y * margin)
        assert e.train_rmse[r] == pytest.approx(loss, abs=1e-9)
    scored = Model(BINNER, e)
    e.best_round = 2
    got = scored.score(df, keep=["i"]).orderBy("i").toPandas()["prediction"]
    assert np.allclose(got, 1 / (1 + np.exp(-margin)), atol=1e-9)
    assert e.train_rmse == sorted(e.train_rmse, reverse=True)


def test_edges_of_few_values_in_few_buckets(spark):
    """Fewer distinct values than bins, some sharing a bucket; more values than bins in fewer buckets than bins."""
    few = [100_000.0, 100_001.0, 100_002.0, 5.0, -0.0, 0.0, -7.25] * 3
    narrow = [1_000_000.0 + i % 40 for i in range(400)]
    df = spark.createDataFrame([(a, b) for a, b in zip((few * 20)[:400], narrow)], "v double, w double").repartition(3)
    assert bucket_counts(df, ["v", "w"]).count() < 12
    got = {}
    for r in bin_edges(df, ["v", "w"], max_bins=16).collect():
        got.setdefault(r["pos"], set()).add(r["edge"])
    assert got[0] == {0.0, 5.0, 100_000.0, 100_001.0, 100_002.0}
    order = sorted(narrow)
    assert got[1] == {order[-(-j * 400 // 16) - 1] for j in range(1, 16)} - {order[0]}
    assert bin_edges(df.limit(0), ["v", "w"]).count() == 0


def test_first_look_is_bounded(spark):
    """Buckets per power of two, however many values."""
    df = spark.range(200_000).select(((F.col("id") * 0.61803398875 % 1) + 1).alias("v"))
    assert bucket_counts(df, ["v"]).count() <= 1 + (1 << 11)


def test_saved_table_scores_without_loading(spark, months, tmp_path, monkeypatch):
    log, folder = str(tmp_path / "log"), str(tmp_path / "m")
    model = fit(months["train"], months["valid"], {"max_depth": 3, "learning_rate": 0.5}, max_rounds=4, max_bins=32, log_folder=log)
    model.save(spark, folder, RoundLog(log).nodes(spark, 0))
    rows = months["test"].limit(500)
    keep = [c for c in rows.columns if c in ("PULocationID", "trip_distance")]
    want = model.score(rows, keep=keep).orderBy(*keep, "prediction").toPandas()
    for size in (1 << 28, 1):  # all trees in one block; a block per tree
        monkeypatch.setattr(model_module, "_BLOCK_BYTES", size)
        got = model_module.score_saved(spark, folder, rows, keep).orderBy(*keep, "prediction").toPandas()
        assert np.allclose(got["prediction"], want["prediction"], atol=1e-12)
    by_feature = {r["feature"]: r["gain"] for r in model_module.saved_gains(spark, folder).collect()}
    assert by_feature == pytest.approx({r["feature"]: r["gain"] for r in model.gains(spark).collect()})
    again = Model.load(spark, folder)
    same_trees(model.ensemble, again.ensemble)


def test_large_model_scores_from_its_table(spark, tmp_path, monkeypatch):
    """1,100 full trees of depth 12: nine million nodes, none of them loaded as a tree."""
    trees, size, inner = 1100, (1 << 13) - 1, (1 << 12) - 1
    binner = Binner(("a", "b"), ((1.0, 2.0, 3.0), (0.5,)), (), ())
    folder = str(tmp_path / "big")
    e = B.Ensemble(B.BoostConfig(max_depth=12), 0.5, train_rmse=[0.0] * trees, valid_rmse=[0.0] * trees, best_round=trees - 1)
    nodes = spark.range(trees * size).selectExpr(
        f"cast(id div {size} as int) as round", f"cast(id % {size} as int) as node", f"id % {size} as place",
        f"cast(if(id % {size} < {inner}, id * 7 % 13 % 2, -1) as int) as feature",
        f"cast(if(id % {size} < {inner}, id % {size} * 2 + 1, -1) as int) as child",
        "array(id * 11 % 31) as right", "0e0 as gain", "0e0 as cover", "(id * 17 % 1009) / 1e3 as weight",
    )
    Model(binner, e).save(spark, folder, nodes)
    rows = [(0.5, 0.1), (1.5, 0.9), (9.0, None), (None, 0.5), (2.0, 0.4)]
    df = spark.createDataFrame(rows, "a double, b double")
    bins = [[0 if v is None else 1 + sum(x <= v for x in e) for v, e in zip(r, binner.edges)] for r in rows]
    want = []
    for own in bins:
        total = 0.5
        for r in range(trees):
            n = 0
            while n < inner:
                at = r * size + n
                n = 2 * n + 1 + (at * 11 % 31 >> own[at * 7 % 13 % 2] & 1)
            total += (r * size + n) * 17 % 1009 / 1e3
        want.append(total)
    monkeypatch.setattr(model_module, "_BLOCK_BYTES", 64 << 20)  # five blocks
    got = model_module.score_saved(spark, folder, df, ["a", "b"]).collect()
    by = {(r["a"], r["b"]): r["prediction"] for r in got}
    assert [by[r] for r in rows] == pytest.approx(want, abs=1e-6)


def test_two_stages(spark, months):
    from meterline.operators.fit import fit_two_stage

    model = fit_two_stage(months["train"], months["valid"], {"max_depth": 2}, max_rounds=2, max_bins=16)
    rows = months["test"].limit(300)
    got = model.score(rows, keep=["trip_distance"]).toPandas()
    chance = model.chance.score(rows, keep=["trip_distance"]).toPandas()["prediction"]
    assert len(got) == 300 and ((chance > 0) & (chance < 1)).all()
    amount = model.amount.score(rows, keep=["trip_distance"]).toPandas()["prediction"]
    assert np.allclose(np.sort(got["prediction"]), np.sort(chance * amount), atol=1e-12)


def test_two_stages_are_the_fits_alone(spark, months):
    """Training side by side changes no tree of either stage."""
    from meterline.operators.fit import TIPPED, fit_two_stage, with_tipped

    parts = months["train"], months["valid"]
    model = fit_two_stage(*parts, {"max_depth": 2}, max_rounds=2, max_bins=16)
    chance = fit(*map(with_tipped, parts), {"max_depth": 2}, 2, max_bins=16, objective=LOGISTIC, label=TIPPED)
    amount = fit(*[df.filter("tip_pct > 0") for df in parts], {"max_depth": 2}, 2, max_bins=16)
    for got, want in ((model.chance, chance), (model.amount, amount)):
        assert got.binner == want.binner and got.ensemble.objective == want.ensemble.objective
        same_trees(got.ensemble, want.ensemble)


def test_two_stage_query_asks_for_the_whole_fit(spark, tmp_path, monkeypatch):
    """Both stages of the query go on until they stall, with all bins; only the test ends them after two rounds."""
    from meterline.operators import fit as fit_module
    from meterline.plans.queries import two_stage

    asked = []

    def two_rounds(binned, binner, configs, max_rounds, early_stop, *args, **options):
        asked.append((max_rounds, early_stop, configs, max(map(len, binner.edges)) > 200, options["objective"]))
        return B.boost(binned, binner, configs, 2, early_stop, *args, **options)

    monkeypatch.setattr(fit_module, "boost", two_rounds)
    lines = spark.range(6000).selectExpr(
        "id as l_orderkey", "id % 200 as l_partkey", "id % 10 as l_suppkey", "int(id % 7) as l_linenumber",
        "double(1 + id % 50) as l_quantity", "if(id % 3 = 0, 'R', 'N') as l_returnflag", "id % 9 / 100e0 as l_tax",
        "id % 11 / 100e0 as l_discount", "cast(date_add(date'1995-01-01', int(id * 2556 div 6000)) as timestamp_ntz) as l_shipdate",
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    row = two_stage(spark, str(tmp_path)).first()
    assert row["n_test"] > 0
    whole = [(B.MAX_ROUNDS, B.EARLY_STOP, {0: B.BoostConfig()}, True, o) for o in ("logistic", "squared")]
    assert (B.MAX_ROUNDS, B.EARLY_STOP) == (2000, 100) and sorted(asked, key=lambda a: a[-1]) == whole


def test_packed_codes_are_the_codes(spark):
    """Codes in bytes, as the training loop reads them, are those of ``transform``."""
    nan, inf = float("nan"), float("inf")
    binner = Binner(("a", "b"), ((0.0, 1.5, 7.0), ()), ("c",), (5,))
    rows = [(None, 1.0, 0), (nan, None, None), (-inf, 2.0, 4), (inf, nan, 1), (0.0, 0.0, 2), (1.5, -1.0, 3), (1.4999, 5.0, None), (7.0, inf, 0)]
    for df in (spark.createDataFrame(rows, "a double, b double, c int"), spark.range(5).selectExpr("2e0 as a", "float(1) as b", "3 as c")):
        want = [tuple(r["codes"]) for r in binner.transform(df).collect()]
        got = [tuple(np.frombuffer(r["packed"], "<i2")) for r in binner.pack(df).collect()]
        assert sorted(got) == sorted(want) and len(got) == df.count()


def test_fits_read_stored_features(spark, sf_dir):
    """Train and valid are made once for all passes of a fit; the folder goes afterwards."""
    from meterline.plans.queries import features_of, stored_features
    from meterline.session import scratch_root

    want, root = features_of(spark, sf_dir), scratch_root(spark).removeprefix("file:")
    with stored_features(spark, sf_dir) as f:
        for name in ("train", "valid"):
            assert all(root in path for path in f[name].inputFiles()) and f[name].columns == want[name].columns
        for name, df in f.items():
            assert df.count() == want[name].count() and df.exceptAll(want[name]).isEmpty()
        path = f["train"].inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)
