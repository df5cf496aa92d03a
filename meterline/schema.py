"""Column names, types, vocabularies and thresholds shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw columns read from the monthly files, with the type each is conformed to.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.DoubleType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("airport_fee", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
    ]
)
RAW_COLUMNS = RAW_SCHEMA.fieldNames()

TARGET = "tip_pct"

# Model inputs in their pinned order.
NUMERIC_FEATURES = [
    "trip_distance",
    "duration_min",
    "speed_mph",
    "fare_amount",
    "extra",
    "tolls_amount",
    "congestion_surcharge",
    "airport_fee",
    "passenger_count",
    "hour_sin",
    "hour_cos",
    "dow",
    "is_weekend",
    "is_night",
    "store_and_fwd",
    "pu_airport",
    "do_airport",
]
CATEGORICAL_FEATURES = ["PULocationID", "DOLocationID", "RatecodeID", "VendorID"]
FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES

# Columns that carry the answer; none of them may reach the model.
FORBIDDEN = frozenset({"total_amount", "tip_amount", "payment_type"})

# Vocabularies. A category's code is its position in the list.
ZONE_COUNT = 265
VOCABULARY = {
    "PULocationID": range(1, ZONE_COUNT + 1),
    "DOLocationID": range(1, ZONE_COUNT + 1),
    "RatecodeID": [1, 2, 3, 4, 5, 6, 99],
    "VendorID": [1, 2, 6, 7],
}
AIRPORT_ZONES = [1, 132, 138]

# Plausibility bounds, all inclusive.
CARD_PAYMENT = 1
DURATION_MIN = (1.0, 180.0)
DISTANCE_MI = (0.1, 100.0)
FARE = (2.5, 500.0)
MAX_SPEED_MPH = 80.0
TIP_PCT = (0.0, 1.0)

FEATURE_SCHEMA = T.StructType(
    [T.StructField(c, T.FloatType()) for c in NUMERIC_FEATURES]
    + [T.StructField(c, T.IntegerType()) for c in CATEGORICAL_FEATURES]
    + [T.StructField(TARGET, T.DoubleType())]
)

# Month presets (year, month) for the full and the small run.
FULL_SPLIT = {
    "train": [(2023, m) for m in range(1, 13)],
    "valid": [(2024, 1), (2024, 2), (2024, 3)],
    "test": [(2024, 4), (2024, 5), (2024, 6)],
}
SMALL_SPLIT = {
    "train": [(2023, 1), (2023, 4), (2023, 7), (2023, 10)],
    "valid": [(2024, 1)],
    "test": [(2024, 4)],
}
