"""Registered queries: each operator over the whole supplied tables.

Computed doubles are rounded by ``floor(x * 1e6 + 0.5) / 1e6``, which any engine with
IEEE doubles repeats exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C
from ..functions.hashing import md5_uniform
from ..operators import clean as cl
from ..operators import curves, evaluate, lookup, mllib, sampling
from ..operators import split as sp
from ..operators.binning import Binner, bin_edges
from ..operators.boosting import BoostConfig, Ensemble, boost, write_binned
from ..operators.features import clean_and_featurize, featurize
from ..operators.fit import TIPPED, fit_final, fit_two_stage, with_tipped
from ..operators.histogram import LOGISTIC, SQUARED, gradient, histogram
from ..operators.model import Model, average_gains, saved_gains
from ..operators.splits import best_splits, scan_splits
from ..search import propose as tpe
from ..search import rungs, runner
from ..search.space import SPACE, draw_configs
from ..session import drop_path, list_folder, scratch_path, stored, tune
from ..sources.months import conform, load_months
from ..sources.trips import TRIP_KEY, line_trips, trips_of
from ..streaming.pipeline import ModelVersions, run_available, score_batches

YEARS = {"train": [1995, 1996, 1997, 1998, 1999], "valid": [2000], "test": [2001]}
SHARES = {"train": 0.7, "valid": 0.15, "test": 0.15}
STUMP_FEATURES = ["trip_distance", "duration_min", "hour_sin"]
STUMP_BINS = 16
STUMP_ROUNDS = 3


def q6(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c.cast("double") * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[q6(c).alias(c) if c in names else F.col(c) for c in df.columns])


def key() -> list[Column]:
    return [F.col(c) for c in TRIP_KEY]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def split_trips(spark: SparkSession, d: str) -> DataFrame:
    return sp.split_by_year(line_trips(spark, d), YEARS)


def cleaned_split(spark: SparkSession, d: str) -> DataFrame:
    return cl.clean(split_trips(spark, d))


def _split_features(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    trips = sp.split_by_year(trips_of(spark, lines), YEARS)
    return clean_and_featurize(trips, keep=("split",))


def features_of(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    f = _split_features(spark, d)
    return {n: f.filter(F.col("split") == n).drop("split") for n in YEARS}


@contextmanager
def stored_features(spark: SparkSession, d: str) -> Iterator[dict[str, DataFrame]]:
    """The same for fits, which pass over train and valid many times: these two are made once and stored."""
    f = _split_features(spark, d)
    with stored(f.filter(F.col("split") != "test"), "features") as kept:
        yield {n: (f if n == "test" else kept).filter(F.col("split") == n).drop("split") for n in YEARS}


# ---- scan, filters, projections ---------------------------------------------------------


def split_summary(spark, d):
    return rounded(sp.split_summary(cleaned_split(spark, d)), "mean_tip_pct")


def scan_pruned(spark, d):
    return conform(line_trips(spark, d)).agg(
        F.count("*").alias("n_rows"),
        F.count("passenger_count").alias("n_passengers"),
        q6(F.sum("fare_amount")).alias("fares"),
    )


def month_union(spark, d):
    """Two months' tables with different column types, conformed and united."""
    trips = line_trips(spark, d)
    odd = F.month("tpep_pickup_datetime") % 2 == 1
    drifted = trips.filter(odd).select(
        "*",
        F.col("payment_type").cast("double").alias("pt"),
        F.col("PULocationID").cast("bigint").alias("pu"),
        F.col("tpep_pickup_datetime").cast("string").alias("ts"),
    )
    drifted = drifted.drop("payment_type", "PULocationID", "tpep_pickup_datetime").withColumnsRenamed(
        {"pt": "payment_type", "pu": "PULocationID", "ts": "tpep_pickup_datetime"}
    )
    both = conform(trips.filter(~odd)).unionByName(conform(drifted))
    return both.groupBy(F.month("tpep_pickup_datetime").alias("month")).agg(
        F.count("*").alias("n_rows"),
        F.sum("PULocationID").alias("zone_sum"),
        F.sum("payment_type").alias("payment_sum"),
    )


def _filter_query(rule: str):
    def q(spark, d):
        return cl.only(line_trips(spark, d), rule).agg(
            F.count("*").alias("n_rows"),
            F.sum("l_orderkey").alias("key_sum"),
            q6(F.avg("duration_min")).alias("mean_duration"),
        )

    return q


def reject_waterfall(spark, d):
    return cl.waterfall(line_trips(spark, d))


def duration_speed(spark, d):
    df = cl.derive(line_trips(spark, d))
    return df.select(*TRIP_KEY, q6("duration_min").alias("duration_min"), q6("speed_mph").alias("speed_mph"))


def tip_pct(spark, d):
    df = cl.derive(line_trips(spark, d))
    return df.select(*TRIP_KEY, q6("tip_pct").alias("tip_pct"))


def cyclic_hour(spark, d):
    pu = F.col("tpep_pickup_datetime")
    return line_trips(spark, d).select(
        *TRIP_KEY, q6(C.hour_sin(pu)).alias("hour_sin"), q6(C.hour_cos(pu)).alias("hour_cos")
    )


def calendar_flags(spark, d):
    pu = F.col("tpep_pickup_datetime")
    return line_trips(spark, d).select(
        *TRIP_KEY,
        C.day_of_week(pu).alias("dow"),
        C.is_weekend(pu).alias("is_weekend"),
        C.is_night(pu).alias("is_night"),
    )


def location_flags(spark, d):
    return line_trips(spark, d).select(
        *TRIP_KEY, C.is_airport("PULocationID").alias("pu_airport"), C.is_airport("DOLocationID").alias("do_airport")
    )


def store_fwd_flag(spark, d):
    return line_trips(spark, d).select(*TRIP_KEY, C.store_and_fwd("store_and_fwd_flag").alias("store_and_fwd"))


def coerce_fill(spark, d):
    names = ("passenger_count", "congestion_surcharge", "airport_fee", "extra", "tolls_amount")
    return line_trips(spark, d).select(*TRIP_KEY, *[q6(C.filled(c)).alias(c) for c in names])


def pinned_codes(spark, d):
    return line_trips(spark, d).select(*TRIP_KEY, *[C.category_code(c).alias(c) for c in S.CATEGORICAL_FEATURES])


def feature_matrix(spark, d):
    df = featurize(cl.clean(line_trips(spark, d)), keep=TRIP_KEY)
    return rounded(df, *S.NUMERIC_FEATURES, S.TARGET)


def stream_feature_matrix(spark, d):
    """The same matrix through a file stream over the lines, drained once."""
    schema = table(spark, d, "lineitem").schema
    lines = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(d)
    features = featurize(cl.clean(trips_of(spark, lines)), keep=TRIP_KEY)
    root = scratch_path(spark, "stream")
    run_available(features, f"{root}/out", f"{root}/checkpoint")
    return rounded(spark.read.parquet(f"{root}/out"), *S.NUMERIC_FEATURES, S.TARGET)


def stream_scores(spark, d):
    """Test rows scored through a file stream by the newest published model, counted by prediction."""
    f = features_of(spark, d)
    binner, e = _stumps(spark, f, SQUARED)
    e.best_round = STUMP_ROUNDS - 1
    root = scratch_path(spark, "scores")
    versions = ModelVersions(f"{root}/models")
    versions.publish(spark, Model(binner, e))
    schema = table(spark, d, "lineitem").schema
    lines = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(d)

    def test_rows(batch: DataFrame) -> DataFrame:
        trips = sp.split_by_year(trips_of(batch.sparkSession, batch), YEARS)
        return clean_and_featurize(trips, keep=("split",)).filter("split = 'test'").drop("split")

    score_batches(lines, versions, f"{root}/out", f"{root}/checkpoint", prepare=test_rows)
    scored = spark.read.parquet(f"{root}/out")
    return scored.groupBy(q6("prediction").alias("prediction"), "model_version").agg(F.count("*").alias("n_rows"))


def load_months_query(spark, d):
    """Month files written from the lines, odd months with other column types, read back as one table."""
    trips = line_trips(spark, d).withColumn("m", F.date_format("tpep_pickup_datetime", "yyyy-MM"))
    root = scratch_path(spark, "months")
    odd = F.month("tpep_pickup_datetime") % 2 == 1
    drifted = trips.withColumn("payment_type", F.col("payment_type").cast("double")).withColumn(
        "PULocationID", F.col("PULocationID").cast("bigint")
    )
    for part, df in (("odd", drifted.filter(odd)), ("even", trips.filter(~odd))):
        df.repartition("m").write.partitionBy("m").parquet(f"{root}/{part}")
    paths = [f"{root}/{part}/{n}" for part in ("odd", "even") for n in list_folder(spark, f"{root}/{part}") if n.startswith("m=")]
    return load_months(spark, sorted(paths)).groupBy("src_month").agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("row_key").alias("n_keys"),
        F.sum("payment_type").cast("bigint").alias("payment_sum"),
        F.sum("PULocationID").cast("bigint").alias("zone_sum"),
        F.min("tpep_pickup_datetime").alias("first_pickup"),
    )


# ---- splits, samples, evaluation --------------------------------------------------------


def temporal_split_counts(spark, d):
    return split_trips(spark, d).groupBy("split").agg(
        F.count("*").alias("n_rows"),
        F.min("tpep_pickup_datetime").alias("first_pickup"),
        F.max("tpep_pickup_datetime").alias("last_pickup"),
    )


def hash_sample(spark, d):
    return sampling.bernoulli(line_trips(spark, d), 0.1, key()).select(*TRIP_KEY)


def capped_sample(spark, d):
    trips = line_trips(spark, d)
    return sampling.cap(trips, 5000, key()).select(*TRIP_KEY)


def exact_sample(spark, d):
    trips = trips_of(spark, table(spark, d, "lineitem"))  # hashed more than once
    return sampling.exact_sample(trips, 1000, key()).select(*TRIP_KEY)


def round_subsample(spark, d):
    """Rows a boosting round would draw at 80%, per round, and the mean target it sees."""
    rows = cleaned_split(spark, d).withColumn("round", F.explode(F.array(*map(F.lit, range(3)))))
    u = md5_uniform(*key(), F.col("round"), seed=7)
    return rows.filter(u < 0.8).groupBy("round").agg(
        F.count("*").alias("n_rows"), q6(F.avg("tip_pct")).alias("mean_tip_pct")
    )


def baseline_rmse(spark, d):
    return rounded(evaluate.baseline_rmse(cleaned_split(spark, d)), "baseline_rmse")


_METRICS = ("test_rmse", "test_mae", "baseline_rmse", "improvement_pct")


def zone_mean_metrics(spark, d):
    return rounded(evaluate.group_mean_metrics(cleaned_split(spark, d), "PULocationID"), *_METRICS)


def random_vs_temporal(spark, d):
    """The same predictor under a split by time and a random one."""
    trips = cl.clean(line_trips(spark, d))
    out = None
    for name, df in (
        ("temporal", sp.split_by_year(trips, YEARS)),
        ("random", sp.split_at_random(trips, SHARES, key(), seed=3)),
    ):
        m = evaluate.group_mean_metrics(df, "PULocationID").withColumn("split_style", F.lit(name))
        out = m if out is None else out.unionByName(m)
    return rounded(out, *_METRICS)


def zone_join(spark, d):
    """Trips per borough of pickup and drop-off; nations stand in for the zone table."""
    zones = (
        table(spark, d, "nation")
        .join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select((F.col("n_nationkey") * 10 + 1).alias("zone_id"), F.col("r_name").alias("borough"))
    )
    return (
        lookup.add_boroughs(line_trips(spark, d), zones)
        .groupBy("pu_borough", "do_borough")
        .agg(F.count("*").alias("n_trips"), q6(F.avg("trip_distance")).alias("mean_distance"))
    )


# ---- binning, histograms, splits --------------------------------------------------------


def train_features(spark, d):
    return features_of(spark, d)["train"]


def edges(spark, d):
    e = bin_edges(train_features(spark, d), S.NUMERIC_FEATURES)
    return e.select("pos", q6("edge").alias("edge"))


def binned_counts(spark, d):
    """Rows per bin when train's edges are applied to the valid split."""
    f = features_of(spark, d)
    binner = Binner.fit(f["train"])
    codes = binner.transform(f["valid"]).select(F.explode("codes").alias("code"))
    return codes.groupBy("code").agg(F.count("*").alias("n_rows")).select(
        F.expr(f"int(code div {binner.stride})").alias("pos"),
        (F.col("code") % binner.stride).cast("int").alias("bin"),
        "n_rows",
    )


def _fixed_bins(spark, d) -> DataFrame:
    """Train rows with whole-number bins of three columns; passenger_count has missing rows."""
    df = cleaned_split(spark, d).filter("split = 'train'")
    bins = [
        F.floor("trip_distance") + 1,
        F.coalesce(F.floor("passenger_count"), F.lit(0)),
        F.coalesce(C.category_code("PULocationID") + 1, F.lit(0)),
        F.coalesce(C.category_code("RatecodeID") + 1, F.lit(0)),
    ]
    codes = F.array(*[(b + i * 300).cast("smallint") for i, b in enumerate(bins)])
    # Gradients in whole numbers, so that engines that add in other orders agree.
    g = F.floor(gradient(F.lit(0.15), F.col("tip_pct")) * 1e6)
    return df.select((F.col("VendorID") % 2).cast("bigint").alias("slot"), g.cast("double").alias("g"), codes.alias("codes"))


def _cells(spark, d, onehot_below: int = 8) -> DataFrame:
    h = histogram(_fixed_bins(spark, d), 1200)
    feature = F.expr("int(code div 300)")
    size = F.when(feature == 2, 265).when(feature == 3, 7).otherwise(0)
    return h.repartition("slot").select(
        "slot",
        feature.alias("feature"),
        (F.col("code") % 300).alias("bin"),
        "g",
        "h",
        (feature >= 2).alias("is_cat"),
        ((feature >= 2) & (size < onehot_below)).alias("onehot"),
        F.lit(1.0).alias("reg_lambda"),
        F.lit(1000.0).alias("reg_alpha"),
        F.lit(5.0).alias("min_child_weight"),
    )


def grad_histogram(spark, d):
    return _cells(spark, d).select("slot", "feature", "bin", "g", "h")


def root_split(spark, d):
    b = best_splits(_cells(spark, d))
    return b.select(
        "slot", "feature", "bin", "missing_right", q6(F.col("gain") / 1e12).alias("gain"), "g_left", "h_left"
    )


def missing_direction(spark, d):
    scan = scan_splits(_cells(spark, d)).filter("feature = 1 and bin > 0")
    return scan.select(
        "slot",
        "bin",
        q6(F.col("gain_left") / 1e12).alias("gain_left"),
        q6(F.col("gain_right") / 1e12).alias("gain_right"),
        "missing_right",
    )


def categorical_order(spark, d):
    scan = scan_splits(_cells(spark, d)).filter("feature = 2 and bin > 0")
    return scan.select("slot", "bin", F.col("pos").cast("bigint").alias("pos"), q6(F.col("gain") / 1e12).alias("gain"))


def _stumps(spark, f: dict[str, DataFrame], objective: str) -> tuple[Binner, Ensemble]:
    """Three depth-1 rounds of the training loop."""
    binner = Binner.fit(f["train"], STUMP_FEATURES, [], max_bins=STUMP_BINS)
    binned, path = write_binned(spark, binner, f["train"], f["valid"])
    config = BoostConfig(max_depth=1, learning_rate=0.5)
    e = boost(binned, binner, {0: config}, max_rounds=STUMP_ROUNDS, objective=objective)[0]
    drop_path(spark, path)
    return binner, e


def _stump_rows(spark, binner: Binner, e: Ensemble, errors: tuple[str, str]) -> DataFrame:
    """The split chosen in each round."""
    rows = []
    for r, t in enumerate(e.trees):
        cut = min(b for b in range(1, binner.stride) if t.right[0] >> b & 1)
        edge = binner.edges[t.feature[0]][cut - 2]
        rows.append((r, binner.features[t.feature[0]], edge, t.gain[0], t.cover[1], t.weight[1],
                     t.weight[2], e.train_rmse[r], e.valid_rmse[r]))
    out = spark.createDataFrame(
        rows,
        "round int, feature string, edge double, gain double, n_left double, left_weight double, "
        f"right_weight double, {errors[0]} double, {errors[1]} double",
    )
    return rounded(out, "edge", "gain", "n_left", "left_weight", "right_weight", *errors)


def boost_stumps(spark, d):
    binner, e = _stumps(spark, features_of(spark, d), SQUARED)
    return _stump_rows(spark, binner, e, ("train_rmse", "valid_rmse"))


def boost_logistic(spark, d):
    """The same rounds for the question whether a trip is tipped at all."""
    f = {n: with_tipped(df) for n, df in features_of(spark, d).items()}
    f = {n: df.withColumn(S.TARGET, F.col(TIPPED)) for n, df in f.items()}
    binner, e = _stumps(spark, f, LOGISTIC)
    return _stump_rows(spark, binner, e, ("train_loss", "valid_loss"))


def model_gains(spark, d):
    """Average gain per feature from the node table of a saved model."""
    f = features_of(spark, d)
    binner, e = _stumps(spark, f, SQUARED)
    folder = scratch_path(spark, "model")
    Model(binner, e).save(spark, folder)
    return rounded(saved_gains(spark, folder), "gain")


# ---- curves, rungs, search --------------------------------------------------------------


def round_curves(spark, d) -> DataFrame:
    """A trial per part, a round per whole quantity, a whole-number error."""
    lines = table(spark, d, "lineitem")
    return lines.groupBy(
        F.col("l_partkey").alias("trial"), F.col("l_quantity").cast("int").alias("boost_round")
    ).agg((F.sum(F.col("l_orderkey") % 997) / F.count("*")).alias("valid_rmse"))


def early_stop(spark, d):
    return curves.early_stop(round_curves(spark, d), patience=10)


def report_rows(spark, d):
    return curves.report_rows(round_curves(spark, d), every=10).select(
        "trial", "boost_round", "report_no", q6("valid_rmse").alias("valid_rmse")
    )


def study_reports(spark, d) -> DataFrame:
    """A study per supplier, twelve trials in each, seven reports per trial."""
    lines = table(spark, d, "lineitem")
    trial = (F.col("l_partkey") % 12).cast("int")
    report = (F.col("l_orderkey") % 7 + 1).cast("int")
    return (
        lines.groupBy(
            F.col("l_suppkey").cast("string").alias("study"), trial.alias("trial_id"), report.alias("report_no")
        )
        .agg((F.sum(F.col("l_orderkey") % 997) / F.count("*")).alias("valid_rmse"))
        .withColumn("seq", (F.col("report_no") * 100 + F.col("trial_id") * 5 % 12).cast("bigint"))
    )


def asha_cutoffs(spark, d):
    out = rungs.rung_cutoffs(study_reports(spark, d), rungs.rung_levels(7))
    return out.select("study", "trial_id", "report_no", q6("cutoff").alias("cutoff"), "stops")


def asha_survivors(spark, d):
    out = rungs.survivors(study_reports(spark, d), rungs.rung_levels(7))
    return out.select("study", "trial_id", "report_no", q6("cutoff").alias("cutoff"), "stops")


def sync_halving(spark, d):
    out = rungs.synchronous_keep(study_reports(spark, d), 2)
    return out.select("study", "trial_id", q6("valid_rmse").alias("valid_rmse"))


def best_trial(spark, d):
    return rounded(rungs.best_trial(study_reports(spark, d)), "best_rmse")


def best_trial_min(spark, d):
    return rounded(rungs.best_trial(study_reports(spark, d), "min"), "best_rmse")


def node_gains(spark, d) -> DataFrame:
    """A split per line: its part's brand as feature, a whole-number gain."""
    lines = table(spark, d, "lineitem")
    parts = table(spark, d, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("feature"), (F.col("l_orderkey") % 1009).cast("double").alias("gain")
    )


def gain_topk(spark, d):
    names = table(spark, d, "part").select(F.col("p_brand").alias("feature")).distinct()
    return rounded(average_gains(node_gains(spark, d), names).orderBy(F.desc("gain"), "feature").limit(12), "gain")


def search_space_sample(spark, d):
    ids = table(spark, d, "customer").select(F.col("c_custkey").alias("trial_id"))
    out = draw_configs(ids, seed=1)
    return rounded(out, *[p.name for p in SPACE if p.kind != "int"])


def config_listing(spark, d):
    """Each drawn config as (parameter, value) rows in name order."""
    ids = table(spark, d, "supplier").select(F.col("s_suppkey").alias("trial_id"))
    drawn = draw_configs(ids, seed=2)
    pairs = F.array(
        *[F.struct(F.lit(p.name).alias("param"), q6(p.name).alias("value")) for p in sorted(SPACE, key=lambda p: p.name)]
    )
    return drawn.select("trial_id", F.inline(pairs)).orderBy("trial_id", "param")


def search_history(spark, d) -> DataFrame:
    """A study per sixty customers, a trial per customer."""
    ids = table(spark, d, "customer").select(
        F.col("c_custkey").cast("int").alias("trial_id"),
        F.expr("cast(c_custkey div 60 as string)").alias("study"),
        F.abs("c_acctbal").alias("rmse"),
    )
    return ids.join(draw_configs(ids, seed=1), "trial_id")


def tpe_scores(spark, d):
    scores = tpe.cell_scores(tpe.unit_history(tpe.mark_good(search_history(spark, d))))
    return rounded(scores, "good_density", "bad_density", "score")


def tpe_proposals(spark, d):
    history = search_history(spark, d)
    trials = history.groupBy("study").agg((F.max("trial_id") + 1).alias("trial_id"))
    return rounded(tpe.propose(history, trials), *[p.name for p in SPACE if p.kind != "int"])


# ---- whole fits (checked by row count only) ---------------------------------------------


def _train_mean(f: dict[str, DataFrame]) -> float:
    return f["train"].agg(F.avg(S.TARGET)).first()[0]


def fit_hist(spark, d):
    config = BoostConfig(max_depth=4, learning_rate=0.3, subsample=0.8, colsample_bytree=0.8)
    with stored_features(spark, d) as f:
        _, metrics = fit_final(f["train"], f["valid"], f["test"], config, max_rounds=5, max_bins=64)
    return metrics


def fit_mllib(spark, d):
    f = features_of(spark, d)
    model = mllib.fit_gbt(f["train"], rounds=3, max_depth=3)
    return evaluate.test_metrics(mllib.predict(model, f["test"]), _train_mean(f))


def ridge_baseline(spark, d):
    f = features_of(spark, d)
    model = mllib.fit_ridge(f["train"])
    return evaluate.test_metrics(mllib.predict(model, f["test"]), _train_mean(f))


def two_stage(spark, d):
    """Chance of a tip times its expected size, both from boosted trees grown until they stall."""
    with stored_features(spark, d) as f:
        model = fit_two_stage(f["train"], f["valid"], BoostConfig())
        return evaluate.test_metrics(model.score(f["test"], keep=[S.TARGET]), _train_mean(f))


def two_stage_linear(spark, d):
    f = features_of(spark, d)
    models = mllib.fit_two_stage(f["train"])
    return evaluate.test_metrics(mllib.predict_two_stage(models, f["test"]), _train_mean(f))


def search_small(spark, d):
    with stored_features(spark, d) as f:
        found = runner.run(
            f["train"], f["valid"], n_trials=3, wave=3, report_every=1, max_reports=3, max_bins=32,
            overrides={"max_depth": 3},
        )
    return found.reports


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {
        "split_summary": split_summary,
        "scan_pruned": scan_pruned,
        "month_union": month_union,
        "reject_waterfall": reject_waterfall,
        "duration_speed": duration_speed,
        "tip_pct": tip_pct,
        "cyclic_hour": cyclic_hour,
        "calendar_flags": calendar_flags,
        "location_flags": location_flags,
        "store_fwd_flag": store_fwd_flag,
        "coerce_fill": coerce_fill,
        "pinned_codes": pinned_codes,
        "feature_matrix": feature_matrix,
        "stream_features": stream_feature_matrix,
        "stream_scores": stream_scores,
        "load_months": load_months_query,
        "temporal_split_counts": temporal_split_counts,
        "hash_sample": hash_sample,
        "capped_sample": capped_sample,
        "exact_sample": exact_sample,
        "round_subsample": round_subsample,
        "baseline_rmse": baseline_rmse,
        "zone_mean_metrics": zone_mean_metrics,
        "random_vs_temporal": random_vs_temporal,
        "zone_join": zone_join,
        "bin_edges": edges,
        "binned_counts": binned_counts,
        "grad_histogram": grad_histogram,
        "root_split": root_split,
        "missing_direction": missing_direction,
        "categorical_order": categorical_order,
        "boost_stumps": boost_stumps,
        "boost_logistic": boost_logistic,
        "model_gains": model_gains,
        "early_stop": early_stop,
        "report_rows": report_rows,
        "asha_cutoffs": asha_cutoffs,
        "asha_survivors": asha_survivors,
        "sync_halving": sync_halving,
        "best_trial": best_trial,
        "best_trial_min": best_trial_min,
        "gain_topk": gain_topk,
        "search_space_sample": search_space_sample,
        "config_listing": config_listing,
        "tpe_scores": tpe_scores,
        "tpe_proposals": tpe_proposals,
        "fit_hist": fit_hist,
        "fit_mllib": fit_mllib,
        "ridge_baseline": ridge_baseline,
        "two_stage": two_stage,
        "two_stage_linear": two_stage_linear,
        "search_small": search_small,
    }
    for rule in cl.RULES:
        out[f"filter_{rule}"] = _filter_query(rule)
    return {name: _tuned(q) for name, q in out.items()}


def _tuned(query):
    @wraps(query)
    def run(spark: SparkSession, d: str) -> DataFrame:
        return query(tune(spark), d)

    return run
