"""Held-out error, the mean baseline and the comparison of the two."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rmse(pred: Column, y: Column) -> Column:
    return F.sqrt(F.avg((pred - y) * (pred - y)))


def mae(pred: Column, y: Column) -> Column:
    return F.avg(F.abs(pred - y))


def improvement_pct(test_rmse: Column, baseline: Column) -> Column:
    return F.lit(100.0) * (F.lit(1.0) - F.try_divide(test_rmse, baseline))


def test_metrics(scored: DataFrame, train_mean: float | Column, label: str = "tip_pct") -> DataFrame:
    """One row: test_rmse, test_mae, baseline_rmse, n_test, improvement_pct."""
    base = F.lit(train_mean) if isinstance(train_mean, float) else train_mean
    y, pred = F.col(label), F.col("prediction")
    out = scored.agg(
        rmse(pred, y).alias("test_rmse"),
        mae(pred, y).alias("test_mae"),
        rmse(base, y).alias("baseline_rmse"),
        F.count("*").alias("n_test"),
    )
    return out.withColumn(
        "improvement_pct", improvement_pct(F.col("test_rmse"), F.col("baseline_rmse"))
    )


def with_train_mean(df: DataFrame, label: str = "tip_pct") -> DataFrame:
    """Test rows with the train split's mean target beside them, a scalar subquery."""
    mean = df.filter("split = 'train'").agg(F.avg(label))
    return df.filter("split = 'test'").withColumn("train_mean", mean.scalar())


def baseline_rmse(df: DataFrame, label: str = "tip_pct") -> DataFrame:
    """Error on test of always predicting the train mean."""
    return with_train_mean(df, label).agg(
        rmse(F.col("train_mean"), F.col(label)).alias("baseline_rmse"), F.count("*").alias("n_test")
    )


def group_mean_metrics(df: DataFrame, group: str, label: str = "tip_pct") -> DataFrame:
    """Test metrics of predicting each group's train mean (train mean for unseen groups)."""
    per_group = (
        df.filter("split = 'train'").groupBy(group).agg(F.avg(label).alias("group_mean"))
    )
    scored = (
        with_train_mean(df, label)
        .join(per_group.withColumnRenamed(group, "_g"), F.col(group).eqNullSafe(F.col("_g")), "left")
        .withColumn("prediction", F.coalesce("group_mean", "train_mean"))
    )
    return test_metrics(scored, F.col("train_mean"), label)
