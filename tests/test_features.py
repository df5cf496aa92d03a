import math

import pytest

from meterline import schema as S
from meterline.operators.clean import RULES, clean, rules, waterfall, with_reject_reason
from meterline.operators.features import assemble, check_no_leak, clean_and_featurize

# A Saturday trip from zone 70 to an airport: 24 minutes, 4.8 miles, a quarter of the fare as tip.
BASE = {
    "tpep_pickup_datetime": "2022-05-14 10:00:00",
    "tpep_dropoff_datetime": "2022-05-14 10:24:00",
    "VendorID": 2,
    "passenger_count": 3.0,
    "trip_distance": 4.8,
    "RatecodeID": 5.0,
    "store_and_fwd_flag": "Y",
    "PULocationID": 70.0,
    "DOLocationID": 138.0,
    "payment_type": 1,
    "fare_amount": 8.0,
    "extra": 1.0,
    "tolls_amount": 6.55,
    "congestion_surcharge": 0.0,
    "airport_fee": 0.0,
    "tip_amount": 2.0,
    "total_amount": 17.55,
}
TYPES = {
    "tpep_pickup_datetime": "string",
    "tpep_dropoff_datetime": "string",
    "store_and_fwd_flag": "string",
    "VendorID": "int",
    "payment_type": "bigint",
}


def trips(spark, *changes):
    rows = [tuple({**BASE, **c}.values()) for c in changes]
    return spark.createDataFrame(rows, ", ".join(f"{c} {TYPES.get(c, 'double')}" for c in BASE))


def out(spark, **change):
    return clean_and_featurize(trips(spark, change)).collect()


def test_cash_trips_are_dropped(spark):
    df = trips(spark, {}, {"payment_type": 2, "tip_amount": 0.0})
    assert clean_and_featurize(df).count() == 1


def test_no_leaky_columns(spark):
    df = clean_and_featurize(trips(spark, {}))
    assert not S.FORBIDDEN & set(df.columns)
    assert df.columns == S.FEATURES + [S.TARGET]
    assert [f.dataType for f in df.schema] == [f.dataType for f in S.FEATURE_SCHEMA]
    assert not {"month", "year"} & set(df.columns)
    with pytest.raises(ValueError):
        check_no_leak(["trip_distance", "total_amount"])


def test_derived_values(spark):
    (r,) = out(spark)
    assert r["tip_pct"] == pytest.approx(0.25, abs=1e-12)
    assert (r["duration_min"], r["speed_mph"]) == (24.0, pytest.approx(12.0))
    assert r["hour_sin"] == pytest.approx(0.5)
    assert r["hour_cos"] == pytest.approx(-math.sqrt(3) / 2)
    assert (r["dow"], r["is_weekend"], r["is_night"]) == (5, 1, 0)
    assert (r["pu_airport"], r["do_airport"], r["store_and_fwd"]) == (0, 1, 1)
    assert [r[c] for c in S.CATEGORICAL_FEATURES] == [69, 137, 4, 1]


def test_zero_distance_is_dropped(spark):
    assert out(spark, trip_distance=0.0) == []


# Each bound is inclusive; the value next to it is out.
@pytest.mark.parametrize(
    "change, kept",
    [
        ({"tpep_dropoff_datetime": "2022-05-14 10:01:00", "trip_distance": 0.1}, 1),
        ({"tpep_dropoff_datetime": "2022-05-14 10:00:59", "trip_distance": 0.1}, 0),
        ({"tpep_dropoff_datetime": "2022-05-14 13:00:00"}, 1),
        ({"tpep_dropoff_datetime": "2022-05-14 13:00:01"}, 0),
        ({"trip_distance": 0.1}, 1),
        ({"trip_distance": 0.09}, 0),
        ({"trip_distance": 100.0, "tpep_dropoff_datetime": "2022-05-14 12:00:00"}, 1),
        ({"trip_distance": 100.1, "tpep_dropoff_datetime": "2022-05-14 12:00:00"}, 0),
        ({"fare_amount": 2.5}, 1),
        ({"fare_amount": 2.49}, 0),
        ({"fare_amount": 500.0}, 1),
        ({"fare_amount": 500.5}, 0),
        ({"tip_amount": 0.0}, 1),
        ({"tip_amount": -0.01}, 0),
        ({"trip_distance": 80.0, "tpep_dropoff_datetime": "2022-05-14 11:00:00"}, 1),
        ({"trip_distance": 80.5, "tpep_dropoff_datetime": "2022-05-14 11:00:00"}, 0),
        ({"tip_amount": 8.0}, 1),
        ({"tip_amount": 8.1}, 0),
        ({"tpep_dropoff_datetime": "2022-05-14 09:00:00"}, 0),
        ({"tpep_pickup_datetime": "no date"}, 0),
    ],
)
def test_bounds(spark, change, kept):
    assert len(out(spark, **change)) == kept


@pytest.mark.parametrize(
    "column", ["payment_type", "trip_distance", "fare_amount", "tip_amount", "tpep_pickup_datetime"]
)
def test_null_never_passes(spark, column):
    assert out(spark, **{column: None}) == []


@pytest.mark.parametrize("column", ["trip_distance", "fare_amount", "tip_amount"])
def test_nan_never_passes(spark, column):
    assert out(spark, **{column: float("nan")}) == []


def test_missing_values_of_good_rows(spark):
    (r,) = out(
        spark, passenger_count=None, extra=float("nan"), store_and_fwd_flag=None, PULocationID=None,
        DOLocationID=1.5, VendorID=3, RatecodeID=99.0,
    )
    assert (r["passenger_count"], r["extra"], r["store_and_fwd"], r["pu_airport"]) == (0, 0, 0, 0)
    assert [r[c] for c in S.CATEGORICAL_FEATURES] == [None, None, 6, None]


@pytest.mark.parametrize("zone, code", [(0.0, None), (1.0, 0), (265.0, 264), (266.0, None)])
def test_zone_codes(spark, zone, code):
    assert out(spark, PULocationID=zone)[0]["PULocationID"] == code


@pytest.mark.parametrize(
    "start, end, night",
    [
        ("2023-01-02 05:59:00", "2023-01-02 06:19:00", 1),
        ("2023-01-02 06:00:00", "2023-01-02 06:20:00", 0),
        ("2023-01-02 21:59:00", "2023-01-02 22:19:00", 0),
        ("2023-01-02 22:00:00", "2023-01-02 22:20:00", 1),
        ("2023-01-02 23:59:59", "2023-01-03 00:19:59", 1),
    ],
)
def test_night(spark, start, end, night):
    (r,) = out(spark, tpep_pickup_datetime=start, tpep_dropoff_datetime=end)
    assert r["is_night"] == night


@pytest.mark.parametrize("day, weekend", [("2023-01-06", 0), ("2023-01-07", 1), ("2023-01-09", 0)])
def test_weekend(spark, day, weekend):
    (r,) = out(
        spark, tpep_pickup_datetime=f"{day} 10:00:00", tpep_dropoff_datetime=f"{day} 10:20:00"
    )
    assert r["is_weekend"] == weekend


def test_waterfall_charges_first_broken_rule(spark):
    df = trips(spark, {}, {"payment_type": 2, "trip_distance": 0.0}, {"trip_distance": 0.0}, {"tip_amount": None})
    got = {r["outcome"]: r["n_rows"] for r in waterfall(df).collect()}
    assert got == {"kept": 1, "card": 1, "distance": 1, "tip": 1}
    assert with_reject_reason(df).filter("reject_reason is null").count() == clean(df).count()
    assert tuple(rules()) == RULES


def test_session_zone_does_not_move_hours(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        # 2 to 3 o'clock does not exist on that night in that zone.
        (r,) = out(
            spark, tpep_pickup_datetime="2024-03-10 01:30:00", tpep_dropoff_datetime="2024-03-10 03:30:00"
        )
        assert r["duration_min"] == 120.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_assemble(spark):
    row = assemble(clean_and_featurize(trips(spark, {"VendorID": 3}))).first()
    assert len(row["features"]) == len(S.FEATURES)
    assert row["features"][20] == len(S.VOCABULARY["VendorID"])
    assert row["label"] == pytest.approx(0.25, abs=1e-7)
