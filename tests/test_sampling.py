from pyspark.sql import functions as F

from meterline.operators.sampling import bernoulli, cap, exact_sample

KEY = ["id"]


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_bernoulli_ignores_partitioning(spark):
    a = bernoulli(spark.range(0, 20_000, numPartitions=2), 0.1, KEY)
    b = bernoulli(spark.range(0, 20_000, numPartitions=13), 0.1, KEY)
    assert ids(a) == ids(b)
    assert abs(a.count() - 2000) < 200


def test_cap(spark):
    df = spark.range(5000)
    assert cap(df, None, KEY).count() == cap(df, 0, KEY).count() == cap(df, 5000, KEY).count() == 5000
    assert abs(cap(df, 1000, KEY).count() - 1000) < 150


def test_exact_sample(spark):
    df = spark.range(0, 30_000, numPartitions=5)
    a = exact_sample(df, 777, KEY)
    assert a.count() == 777 and len(set(ids(a))) == 777
    assert ids(a) == ids(exact_sample(df.repartition(3), 777, KEY))
    assert ids(a) != ids(exact_sample(df, 777, KEY, seed=1))
    assert exact_sample(df, 40_000, KEY).count() == 30_000


def test_exact_sample_with_a_hot_key(spark):
    """A third of the rows are copies of one key: the size is still exact."""
    df = spark.range(0, 45_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"))
    for n in (10, 14_000, 20_000, 44_999):
        assert exact_sample(df, n, KEY).count() == n


def test_hot_key_gives_the_same_rows_however_partitioned(spark):
    """15,000 rows share a key but differ otherwise."""
    df = spark.range(0, 45_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"), F.col("id").alias("other")
    )
    a, b = (exact_sample(df.repartition(p), 14_000, KEY) for p in (3, 7))
    assert sorted(r["other"] for r in a.collect()) == sorted(r["other"] for r in b.collect())
    assert a.count() == 14_000
