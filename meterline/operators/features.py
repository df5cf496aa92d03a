"""The feature matrix: 21 model inputs and the target, from cleaned rows."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C
from .clean import clean


def check_no_leak(columns: list[str]) -> None:
    leaked = S.FORBIDDEN.intersection(columns)
    if leaked:
        raise ValueError(f"columns that contain the target reached the features: {sorted(leaked)}")


def featurize(cleaned: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Model inputs and target of cleaned rows; ``keep`` names columns to carry along.

    Month and year are left out on purpose: the split is by time, so their test values
    would lie outside everything seen in training.
    """
    pu = C.timestamp("tpep_pickup_datetime")
    exprs = {
        "hour_sin": C.hour_sin(pu),
        "hour_cos": C.hour_cos(pu),
        "dow": C.day_of_week(pu),
        "is_weekend": C.is_weekend(pu),
        "is_night": C.is_night(pu),
        "store_and_fwd": C.store_and_fwd("store_and_fwd_flag"),
        "pu_airport": C.is_airport("PULocationID"),
        "do_airport": C.is_airport("DOLocationID"),
    }
    for name in ("passenger_count", "congestion_surcharge", "airport_fee", "extra", "tolls_amount"):
        exprs[name] = C.filled(name)
    out = cleaned.select(
        *[F.col(k) for k in keep],
        *[exprs.get(c, F.col(c)).cast("float").alias(c) for c in S.NUMERIC_FEATURES],
        *[C.category_code(c).alias(c) for c in S.CATEGORICAL_FEATURES],
        F.col(S.TARGET),
    )
    check_no_leak(out.columns)
    return out


def clean_and_featurize(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Row-independent: the same call serves batch tables and streams."""
    return featurize(clean(df), keep)


def filled_codes(df: DataFrame) -> DataFrame:
    """Gives missing category codes their own last code, for learners that reject null.

    The number of codes goes into the column's ML attribute, so that learners and encoders
    take it from there and not from the values they happen to see.
    """
    for c in S.CATEGORICAL_FEATURES:
        n = len(S.VOCABULARY[c])
        attr = {"ml_attr": {"name": c, "type": "nominal", "num_vals": n + 1}}
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit(n))).withMetadata(c, attr)
    return df


def assemble(df: DataFrame, label: str = S.TARGET) -> DataFrame:
    """X/y pair as ``features`` vector and float ``label`` in one table."""
    assembler = VectorAssembler(inputCols=S.FEATURES, outputCol="features")
    labelled = filled_codes(df).withColumn("label", F.col(label).cast("float").cast("double"))
    return assembler.transform(labelled)
