"""Plausibility filters and the audit of what each of them rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C


def derive(df: DataFrame) -> DataFrame:
    """Adds the columns the later filters test: duration, speed and target."""
    pu, do = C.timestamp("tpep_pickup_datetime"), C.timestamp("tpep_dropoff_datetime")
    return (
        df.withColumn("duration_min", C.duration_min(pu, do))
        .withColumn("speed_mph", C.speed_mph(F.col("trip_distance"), F.col("duration_min")))
        .withColumn(S.TARGET, C.tip_pct(F.col("tip_amount"), F.col("fare_amount")))
    )


RULES = ("card", "duration", "distance", "fare", "tip", "speed", "target")


def rules() -> dict[str, Column]:
    """Name -> predicate a good row meets, in the order rows are charged to them.

    Null never meets a rule. Spark sorts NaN above all numbers, which fails every upper
    bound; the one rule without an upper bound tests for it.
    """
    c = F.col
    return {
        "card": c("payment_type") == S.CARD_PAYMENT,
        "duration": c("duration_min").between(*S.DURATION_MIN),
        "distance": c("trip_distance").between(*S.DISTANCE_MI),
        "fare": c("fare_amount").between(*S.FARE),
        "tip": (c("tip_amount") >= 0) & ~F.isnan(c("tip_amount")),
        "speed": c("speed_mph") <= S.MAX_SPEED_MPH,
        "target": c(S.TARGET).between(*S.TIP_PCT),
    }


def clean(df: DataFrame) -> DataFrame:
    """Rows that meet every rule, with the derived columns."""
    df = derive(df)
    for ok in rules().values():
        df = df.filter(ok)
    return df


def only(df: DataFrame, rule: str) -> DataFrame:
    """Rows that meet one rule, whatever the others say."""
    return derive(df).filter(rules()[rule])


def with_reject_reason(df: DataFrame) -> DataFrame:
    """Adds ``reject_reason``: the first rule the row breaks, null for a good row."""
    reason = None
    for name, ok in rules().items():
        bad = ~F.coalesce(ok, F.lit(False))
        reason = F.when(bad, name) if reason is None else reason.when(bad, name)
    return derive(df).withColumn("reject_reason", reason)


def waterfall(df: DataFrame) -> DataFrame:
    """Rows charged to each rule; good rows under 'kept'."""
    return (
        with_reject_reason(df)
        .groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("outcome"))
        .agg(F.count("*").alias("n_rows"))
    )
