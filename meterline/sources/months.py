"""Monthly Parquet files: path resolution, conformed scan and the split by month."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import timestamp
from ..schema import RAW_SCHEMA

Month = tuple[int, int]
PathFn = Callable[[Iterable[Month]], list[str]]

# Fixed value: the file name the publisher uses for a month.
FILE_NAME = "yellow_tripdata_{year}-{month:02d}.parquet"

FOOTERS = 16  # files whose schema is asked for at once


def month_paths(base: str, months: Iterable[Month]) -> list[str]:
    """One path per month under any Hadoop folder (file, s3a, abfs, ...)."""
    return [f"{base.rstrip('/')}/{FILE_NAME.format(year=y, month=m)}" for y, m in months]


def paths_under(base: str) -> PathFn:
    """A path function bound to a folder, for ``temporal_split``."""
    return lambda months: month_paths(base, months)


def month_label(month: Month) -> str:
    return f"{month[0]}-{month[1]:02d}"


def conform(df: DataFrame) -> DataFrame:
    """Selects the raw columns by name (any case) and casts those whose type differs.

    A column already of the right type gets no cast, so its filters reach the Parquet scan.
    """
    have = {f.name.lower(): f.dataType for f in df.schema.fields}
    cols = []
    for f in RAW_SCHEMA.fields:
        if f.name.lower() not in have:
            raise ValueError(f"column {f.name} is missing")
        if have[f.name.lower()] == f.dataType:
            col = F.col(f.name)
        elif f.dataType.typeName() == "timestamp_ntz":
            col = timestamp(f.name)
        else:
            col = F.col(f.name).try_cast(f.dataType)
        cols.append(col.alias(f.name))
    return df.select(*cols, *[c for c in ("src_month", "row_key") if c in df.columns])


def load_months(
    spark: SparkSession, paths: list[str], partitions: int | None = None
) -> DataFrame:
    """One table of the raw columns from all ``paths``.

    Month files may differ in column types, which a single scan rejects. Paths are grouped
    by their footer's schema, so there is one scan per distinct schema, not per file. Footers
    are read side by side.
    Adds ``src_month`` (from the path) and ``row_key`` (file and row position, which is
    the same on every re-read however Spark cuts the files).
    """
    if not paths:
        raise ValueError("no paths given")
    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(FOOTERS) as pool:
        schemas = pool.map(lambda p: spark.read.parquet(p).schema.json(), paths)
        for p, schema in zip(paths, schemas):
            groups.setdefault(schema, []).append(p)
    out = None
    for members in groups.values():
        df = conform(with_provenance(spark.read.parquet(*members)))
        out = df if out is None else out.unionByName(df)
    return out.repartition(partitions) if partitions else out


def with_provenance(df: DataFrame) -> DataFrame:
    path = F.col("_metadata.file_path")
    return df.select(
        "*",
        F.regexp_extract(path, r".*(\d{4}-\d{2})(?:\.parquet|/)", 1).alias("src_month"),
        F.xxhash64(path, F.col("_metadata.row_index")).alias("row_key"),
    )


def load_partitioned(spark: SparkSession, folder: str) -> DataFrame:
    """A table written by month folders (``src_month=YYYY-MM``), pruned by folder."""
    df = spark.read.parquet(folder)
    key = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("row_key")
    df = df.select("*", key).withColumn("src_month", F.col("src_month").cast("string"))
    return conform(df)


def label_split(df: DataFrame, months: dict[str, list[Month]], by: str = "src_month") -> DataFrame:
    """Adds ``split`` and drops rows of no split.

    ``by="src_month"`` follows the file a row came from; ``by="pickup"`` its own timestamp.
    """
    if by == "pickup":
        label = F.date_format(timestamp("tpep_pickup_datetime"), "yyyy-MM")
    else:
        label = F.col(by)
    split = None
    for name, ms in months.items():
        hit = label.isin([month_label(m) for m in ms])
        split = F.when(hit, name) if split is None else split.when(hit, name)
    wanted = [month_label(m) for ms in months.values() for m in ms]
    return df.filter(label.isin(wanted)).withColumn("split", split)


def temporal_split(
    spark: SparkSession,
    months: dict[str, list[Month]],
    path_fn: PathFn,
    partitions: int | None = None,
) -> dict[str, DataFrame]:
    """Raw table of each split; a split reads only its own months' files."""
    return {name: load_months(spark, path_fn(ms), partitions) for name, ms in months.items()}
