"""A trip table derived from order lines, for checks against another engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import pinned

# Integer arithmetic only, so that engines agree. {add} is the one dialect difference.
TRIPS_SQL = """
with k as (
  select *, l_orderkey*7 + l_partkey*31 + l_suppkey*17 + l_linenumber as k from lineitem
), b as (
  select *, {pickup} as pu,
    case when k % 59 = 0 then 0 when k % 61 = 0 then 108000 else 30 + (k*104729) % 5400 end as dur_s,
    case when k % 47 = 0 then 0e0 else l_quantity*0.2e0 end as dist
  from k
)
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  pu as tpep_pickup_datetime, {dropoff} as tpep_dropoff_datetime,
  cast(1 + k % 4 as int) as VendorID,
  case when k % 100 = 0 then null else 1e0 + k % 5 end as passenger_count,
  dist as trip_distance,
  case when k % 10 = 0 then 99e0 else 1e0 + k % 7 end as RatecodeID,
  case when l_returnflag = 'R' then 'Y' when l_returnflag = 'N' then 'N' end as store_and_fwd_flag,
  cast(1 + k % 268 as int) as PULocationID, cast(1 + (k*13) % 265 as int) as DOLocationID,
  cast(case when k % 10 < 7 then 1 else 2 end as bigint) as payment_type,
  (case when k % 53 = 0 then -1e0 else 1e0 end) * (3e0 + 2.9e0*dist + 0.0075e0*dur_s) as fare_amount,
  l_tax * 10e0 as extra,
  case when k % 17 = 0 then 6.55e0 else 0e0 end as tolls_amount,
  case when k % 5 < 4 then 2.5e0 else 0e0 end as congestion_surcharge,
  case when k % 268 in (131, 137) then 1.75e0 else 0e0 end as airport_fee,
  case when k % 10 < 7 then (l_discount*3e0) * (3e0 + 2.9e0*dist + 0.0075e0*dur_s) else 0e0 end
    as tip_amount
from b
"""

SPARK_TRIPS = TRIPS_SQL.format(
    pickup="timestampadd(SECOND, cast((k*7919) % 86400 as int), l_shipdate)",
    dropoff="timestampadd(SECOND, cast(dur_s as int), pu)",
)
DUCK_TRIPS = TRIPS_SQL.format(
    pickup="l_shipdate + to_seconds((k*7919) % 86400)", dropoff="pu + to_seconds(dur_s)"
)

TRIP_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def line_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip table over ``{sf_dir}/lineitem.parquet``."""
    return trips_of(spark, spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def trips_of(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """Trips of a table or stream of order lines. The made-up fare is long: it is pinned."""
    sql = SPARK_TRIPS.replace("from lineitem", "from {lineitem}")
    trips = spark.sql(sql, lineitem=lines)
    return trips.withColumn("fare_amount", pinned(F.col("fare_amount")))
