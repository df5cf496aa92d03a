"""Quantile bins: cut points from the train rows, bin codes for any rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES, VOCABULARY
from .histogram import PACKED, as_bytes

MAX_BINS = 256  # fixed value: the learner's default number of bins
# Buckets of the first look at a feature: values alike in so many leading binary digits.
BUCKET_BITS = 12
_BLOCK_ROWS = 1 << 18  # rows a task sorts at a time


def bucket(v: np.ndarray, bits: int = BUCKET_BITS) -> np.ndarray:
    """Rounds to ``bits`` significant binary digits, which keeps the order of values.

    A feature then has at most 2**(bits-1) buckets per power of two, however many rows there are.
    """
    whole = np.isfinite(v)
    part, power = np.frexp(np.where(whole, v, 0.0))
    return np.where(whole, np.ldexp(np.floor(np.ldexp(part, bits) + 0.5), power - bits), v)


def counted(df: DataFrame, features: list[str], runs) -> DataFrame:
    """Rows (pos, ...) of each feature's values, as ``runs(pos, sorted values, buckets)`` counts them in blocks.

    Missing values are left out. A task holds ``_BLOCK_ROWS`` rows at a time.
    """

    def block(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pos in range(len(features)):
            v = np.concatenate([b.column(pos).drop_null().to_numpy() for b in held])
            v = np.sort(v[~np.isnan(v)])
            columns = runs(pos, v, bucket(v))
            if len(columns[0]):
                own = [pa.array(np.full(len(columns[0]), pos, np.int32)), *map(pa.array, columns)]
                yield pa.RecordBatch.from_arrays(own, runs.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= _BLOCK_ROWS:
                yield from block(held)
                held, n = [], 0
        if n:
            yield from block(held)

    values = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(features)])
    return values.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in zip(runs.names, runs.types)))


def _starts(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and their lengths."""
    at = np.flatnonzero(np.r_[True, v[1:] != v[:-1]][: len(v)])
    return at, np.diff(np.r_[at, len(v)])


class _BucketRuns:
    names, types = ("pos", "bucket", "n", "lo", "hi"), ("int", "double", "long", "double", "double")

    def __call__(self, pos: int, v: np.ndarray, buckets: np.ndarray) -> list[np.ndarray]:
        at, n = _starts(buckets)
        return [buckets[at], n, v[at], v[at + n - 1]]


@dataclass
class _ValueRuns:
    """Values one by one, of some buckets of each feature."""

    asked: dict[int, list[float]]
    names, types = ("pos", "bucket", "value", "n"), ("int", "double", "double", "long")

    def __call__(self, pos: int, v: np.ndarray, buckets: np.ndarray) -> list[np.ndarray]:
        own = np.isin(buckets, self.asked.get(pos, []))
        v, buckets = v[own], buckets[own]
        at, n = _starts(v)
        return [buckets[at], v[at], n]


def bucket_counts(df: DataFrame, features: list[str]) -> DataFrame:
    """(pos, bucket, n, lo, hi): rows, least and greatest value per bucket.

    Partial sums form before the shuffle: at most 2**(BUCKET_BITS-1) rows per feature and power of two leave
    a task, however many values there are.
    """
    return counted(df, features, _BucketRuns()).groupBy("pos", "bucket").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )


def cut_buckets(counts: DataFrame, max_bins: int) -> DataFrame:
    """(pos, bucket, n, lo, hi, before, total, open): buckets that hold an edge.

    These are fewer than ``max_bins + 1`` per feature. All buckets of a feature count that may have at
    most ``max_bins`` distinct values, which has an edge at each of them; ``open`` says that this is not known yet.
    """
    order, whole = Window.partitionBy("pos").orderBy("bucket"), Window.partitionBy("pos")
    least = F.sum(F.when(F.col("lo") < F.col("hi"), 2).otherwise(1)).over(whole)  # distinct values at least
    ranked = counts.select(
        "*",
        (F.sum("n").over(order) - F.col("n")).alias("before"),
        F.sum("n").over(whole).alias("total"),
        (least <= max_bins).alias("open"),
    )
    return ranked.filter(f"open or (before + n) * {max_bins} div total > before * {max_bins} div total")


_CUT = "pos int, bucket double, n long, lo double, hi double, before long, total long, open boolean"


def bin_edges(df: DataFrame, features: list[str], max_bins: int = MAX_BINS) -> DataFrame:
    """(pos, edge): values that start a new bin. The smallest value starts none.

    An edge is the smallest value whose cumulative count reaches j/max_bins of all rows, exactly;
    a feature with at most ``max_bins`` distinct values has an edge at each of them. Two looks: rows
    are counted in buckets of near values, of which few hold an edge; then only the values in those are
    counted one by one, and of those only in buckets that hold more than one value. No window sees more
    rows than a feature has buckets, or a bucket has values (2**12 for 32-bit floats). Both looks sort and count
    blocks of rows in arrays; Spark adds up the counts.
    """
    spark = df.sparkSession
    found = cut_buckets(bucket_counts(df, features), max_bins).select(*[c.split()[0] for c in _CUT.split(", ")]).collect()
    cut = spark.createDataFrame(found, _CUT)  # at most max_bins rows per feature
    values = cut.filter("lo = hi").select("pos", "bucket", F.col("lo").alias("value"), "n")
    many = [r for r in found if r["lo"] < r["hi"]]
    if many:
        asked = {p: [r["bucket"] for r in many if r["pos"] == p] for p in {r["pos"] for r in many}}
        inner = counted(df, features, _ValueRuns(asked))
        values = values.union(inner.groupBy("pos", "bucket", "value").agg(F.sum("n").alias("n")))
    known = values.join(F.broadcast(cut.select("pos", "bucket", "before", "total", "open")), ["pos", "bucket"])
    inside, whole = Window.partitionBy("pos", "bucket").orderBy("value"), Window.partitionBy("pos")
    upto = F.sum("n").over(inside) + F.col("before")
    placed = known.select("pos", "value", "n", "total", "open", upto.alias("upto"))
    # Features in question have few buckets, so that few rows meet in this window.
    asked = placed.filter("open").withColumn("few", F.count("*").over(whole) <= max_bins)
    placed = placed.filter("not open").withColumn("few", F.lit(False)).union(asked)
    reached = f"least(upto * {max_bins} div total, {max_bins - 1}) > (upto - n) * {max_bins} div total"
    return placed.filter(f"upto > n and (few or {reached})").select("pos", F.col("value").alias("edge"))


@dataclass(frozen=True)
class Binner:
    """Cut points of the numeric features and sizes of the categorical ones.

    Bin 0 means missing. Feature f's bin b has the code f*stride + b, so one integer
    names both, and the codes of a row fit one small array.
    """

    numeric: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]
    categorical: tuple[str, ...]
    sizes: tuple[int, ...]

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    @property
    def n_features(self) -> int:
        return len(self.numeric) + len(self.categorical)

    @property
    def stride(self) -> int:
        return 1 + max([len(e) + 1 for e in self.edges] + list(self.sizes))

    @property
    def words(self) -> int:
        """64-bit words that hold one bit per bin of a feature."""
        return (self.stride + 63) // 64

    @property
    def code_type(self) -> str:
        """The smallest type that holds every code."""
        return "smallint" if self.n_features * self.stride <= 1 << 15 else "int"

    @classmethod
    def fit(
        cls,
        train: DataFrame,
        numeric: list[str] = NUMERIC_FEATURES,
        categorical: list[str] = CATEGORICAL_FEATURES,
        max_bins: int = MAX_BINS,
    ) -> Binner:
        edges: list[list[float]] = [[] for _ in numeric]
        for row in bin_edges(train, numeric, max_bins).collect():  # < max_bins per feature
            edges[row["pos"]].append(row["edge"])
        return cls(
            tuple(numeric),
            tuple(tuple(sorted(e)) for e in edges),
            tuple(categorical),
            tuple(len(VOCABULARY[c]) for c in categorical),
        )

    def transform(self, df: DataFrame, keep: list[Column | str] = ()) -> DataFrame:
        """``keep`` columns plus ``codes`` (array of ``code_type``, in feature order)."""
        cut = [(c, e) for c, e in zip(self.numeric, self.edges) if e]
        nan = F.lit(float("nan"))
        # The columns to bin sit beside the kept ones under names of their own.
        work = df.select(
            *keep,
            *[F.coalesce(F.col(c).cast("double"), nan).alias(f"_v_{c}") for c in self.numeric],
            *[F.col(c).alias(f"_v_{c}") for c in self.categorical],
        )
        if cut:
            work = Bucketizer(
                splitsArray=[[float("-inf"), *e, float("inf")] for _, e in cut],
                inputCols=[f"_v_{c}" for c, _ in cut],
                outputCols=[f"_b_{c}" for c, _ in cut],
                handleInvalid="keep",
            ).transform(work)
        bins = []
        for c, e in zip(self.numeric, self.edges):
            missing = F.isnan(f"_v_{c}")
            bins.append(F.when(missing, 0).otherwise(F.col(f"_b_{c}") + 1 if e else F.lit(1)))
        bins += [F.coalesce(F.col(f"_v_{c}") + 1, F.lit(0)) for c in self.categorical]
        codes = F.array(*[(b + f * self.stride).cast(self.code_type) for f, b in enumerate(bins)])
        kept = [c for c in work.columns if not c.startswith(("_v_", "_b_"))]
        return work.select(*kept, codes.alias("codes"))

    def pack(self, df: DataFrame, keep: list[Column | str] = ()) -> DataFrame:
        """``keep`` columns plus ``packed``: the same codes as bytes of ``code_type``.

        For tables that tasks pass over many times: bytes go between Spark and the tasks' arrays as they are.
        """
        edges, n, stride = [np.array(e, np.float64) for e in self.edges], self.n_features, self.stride
        kind = PACKED[self.code_type]

        @F.arrow_udf("binary")
        def packed(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            for rows, *columns in batches:  # a constant column comes as a scalar, the first one is none
                codes = np.empty((len(rows), n), np.int64)
                for f, column in enumerate(columns):
                    if isinstance(column, pa.Scalar):
                        column = pa.repeat(column, len(rows))
                    if f < len(edges):
                        v = column.fill_null(np.nan).to_numpy(zero_copy_only=False)
                        bins = np.where(np.isnan(v), 0, np.searchsorted(edges[f], v, "right") + 1)
                    else:
                        bins = column.fill_null(-1).to_numpy(zero_copy_only=False) + 1
                    codes[:, f] = bins + f * stride
                yield as_bytes(codes.astype(kind))

        work = df.select(
            *keep,
            *[F.col(c).cast("double").alias(f"_v_{c}") for c in self.numeric],
            *[F.col(c).cast("long").alias(f"_v_{c}") for c in self.categorical],
        )
        kept = [c for c in work.columns if not c.startswith("_v_")]
        return work.select(*kept, packed(F.spark_partition_id(), *[f"_v_{c}" for c in self.features]).alias("packed"))
