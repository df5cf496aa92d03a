import pytest
from pyspark.sql import functions as F

from meterline.operators.clean import clean, waterfall
from meterline.operators.features import clean_and_featurize
from meterline.schema import RAW_COLUMNS, SMALL_SPLIT
from meterline.sources import months as M
from meterline.sources import synthetic as syn


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("months"))
    syn.write_months(spark, out, [(2023, 1), (2024, 2)], rows_per_month=3000, seed=5)
    return out


def test_paths():
    assert M.month_paths("s3a://b/x/", [(2023, 1), (2023, 12)]) == [
        "s3a://b/x/yellow_tripdata_2023-01.parquet",
        "s3a://b/x/yellow_tripdata_2023-12.parquet",
    ]
    assert M.paths_under("/d")([(2024, 4)]) == ["/d/yellow_tripdata_2024-04.parquet"]


def test_load_months(spark, folder):
    df = M.load_months(spark, M.month_paths(folder, [(2023, 1), (2024, 2)]))
    assert df.columns == [*RAW_COLUMNS, "src_month", "row_key"]
    counts = {r["src_month"]: r["count"] for r in df.groupBy("src_month").count().collect()}
    assert counts == {"2023-01": 3000, "2024-02": 3000}
    assert df.select("row_key").distinct().count() == 6000


def test_only_needed_columns_and_filters_reach_the_scan(spark, folder):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    df = M.load_months(spark, M.month_paths(folder, [(2023, 1)]))
    plan = clean(df).select("tip_pct")._jdf.queryExecution().executedPlan().toString()
    assert "mta_tax" not in plan and "store_and_fwd_flag" not in plan
    assert "PushedFilters" in plan
    assert "EqualTo(payment_type,1)" in plan
    assert "GreaterThanOrEqual(fare_amount,2.5)" in plan


def test_drifting_types_are_conformed(spark, folder, tmp_path):
    base = M.load_months(spark, M.month_paths(folder, [(2023, 1)])).select(*RAW_COLUMNS)
    odd = (
        base.withColumn("payment_type", F.col("payment_type").cast("double"))
        .withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
        .withColumn("PULocationID", F.col("PULocationID").cast("bigint"))
        .withColumnRenamed("airport_fee", "Airport_fee")
    )
    path = M.month_paths(str(tmp_path), [(2023, 3)])[0]
    odd.write.parquet(path)
    both = M.load_months(spark, [*M.month_paths(folder, [(2023, 1)]), path])
    assert [f.dataType for f in both.schema][:16] == [f.dataType for f in base.schema]
    got = both.groupBy("src_month").agg(F.sum("PULocationID"), F.sum("airport_fee"), F.count("*"))
    (a, b) = [tuple(r)[1:] for r in got.collect()]
    assert a == b


def test_a_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="tpep_pickup_datetime"):
        M.conform(spark.range(1))


def test_temporal_split_by_file_and_by_pickup(spark, folder):
    months = {"train": [(2023, 1)], "test": [(2024, 2)]}
    parts = M.temporal_split(spark, months, M.paths_under(folder))
    assert {k: v.count() for k, v in parts.items()} == {"train": 3000, "test": 3000}
    df = M.load_months(spark, M.month_paths(folder, [(2023, 1), (2024, 2)]))
    for by in ("src_month", "pickup"):
        got = M.label_split(df, months, by).groupBy("split").count().collect()
        assert {r["split"]: r["count"] for r in got} == {"train": 3000, "test": 3000}


def test_month_folders_are_pruned(spark, folder, tmp_path):
    df = M.load_months(spark, M.month_paths(folder, [(2023, 1), (2024, 2)]))
    syn.write_partitioned(df, str(tmp_path / "t"))
    back = M.load_partitioned(spark, str(tmp_path / "t"))
    jan = back.filter(F.col("src_month") == "2023-01")
    assert jan.count() == 3000
    plan = jan.select("fare_amount")._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :]
    assert "2023-01" in filters[: filters.index("]")]


def test_synthetic_shares_and_determinism(spark):
    n = 20_000
    a = syn.month_trips(spark, (2023, 1), n, seed=1, partitions=3)
    b = syn.month_trips(spark, (2023, 1), n, seed=1, partitions=7)
    assert a.exceptAll(b).count() == 0
    r = a.agg(
        F.avg((F.col("payment_type") == 1).cast("int")),
        F.avg(F.col("passenger_count").isNull().cast("int")),
        F.avg((F.col("junk_slot") < 4).cast("int")),
        F.min("tpep_pickup_datetime").cast("string"),
        F.max("tpep_pickup_datetime").cast("string"),
        F.avg((F.col("store_and_fwd_flag") == "Y").cast("int")),
    ).first()
    assert r[0] == pytest.approx(0.72, abs=0.02)
    assert r[1] == pytest.approx(0.01, abs=0.004)
    assert r[2] == pytest.approx(0.02, abs=0.005)
    assert r[3].startswith("2023-01-01") and r[4].startswith("2023-01-31")
    assert r[5] == pytest.approx(0.02, abs=0.005)


def test_junk_never_survives(spark):
    df = syn.month_trips(spark, (2023, 2), 20_000, seed=2)
    assert clean(df).filter("junk_slot < 4").count() == 0
    assert {r["outcome"] for r in waterfall(df).collect()} >= {"kept", "card", "duration", "distance", "fare"}


def test_transform_ignores_partitioning(spark, folder):
    df = M.load_months(spark, M.month_paths(folder, [(2023, 1)]))
    one = clean_and_featurize(df.coalesce(1))
    many = clean_and_featurize(df.repartition(9))
    assert one.exceptAll(many).count() == 0 and one.count() == many.count()


def test_presets():
    assert SMALL_SPLIT["test"] == [(2024, 4)] and len(SMALL_SPLIT["train"]) == 4
