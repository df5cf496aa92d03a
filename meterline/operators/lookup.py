"""Zone lookup: borough columns for both ends of a trip."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_boroughs(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Left join of (zone_id, borough) to the pickup and the drop-off zone.

    Spark picks the join by the lookup's size. A zone that is listed with two boroughs is an error.
    """
    twice = F.raise_error(F.concat(F.lit("zone listed with two boroughs: "), F.col("zone_id").cast("string")))
    one = F.min("borough").eqNullSafe(F.max("borough"))
    zones = zones.groupBy("zone_id").agg(F.when(one, F.min("borough")).otherwise(twice).alias("borough"))
    for end in ("PU", "DO"):
        side = zones.select(
            F.col("zone_id").alias(f"{end}LocationID"), F.col("borough").alias(f"{end.lower()}_borough")
        )
        trips = trips.join(side, f"{end}LocationID", "left")
    return trips
