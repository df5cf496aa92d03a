"""The row-independent transform and scoring over file streams."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.features import clean_and_featurize
from ..operators.model import Model
from ..schema import RAW_SCHEMA
from ..session import list_folder, write_text


def read_trips(
    spark: SparkSession, folder: str, schema: StructType = RAW_SCHEMA, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files as they arrive in ``folder``."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def stream_features(raw: DataFrame) -> DataFrame:
    """The batch function as is: no state, no watermark, nothing late."""
    return clean_and_featurize(raw)


def stream_scores(raw: DataFrame, model: Model) -> DataFrame:
    """Cleaned rows with their prediction."""
    return model.score(clean_and_featurize(raw), keep=["tip_pct"])


@dataclass(frozen=True)
class ModelVersions:
    """Saved models by number in one folder; the newest whole one counts."""

    folder: str

    def publish(self, spark: SparkSession, model: Model) -> int:
        """Saves a model as the next version. Its marker is written last."""
        number = 1 + max(self.numbers(spark), default=0)
        path = f"{self.folder.rstrip('/')}/{number:06d}"
        model.save(spark, path)
        write_text(spark, f"{path}/published", str(number))
        return number

    def numbers(self, spark: SparkSession) -> list[int]:
        root = self.folder.rstrip("/")
        names = [n for n in list_folder(spark, root) if n.isdigit()]
        return sorted(int(n) for n in names if "published" in list_folder(spark, f"{root}/{n}"))

    def load(self, spark: SparkSession, number: int) -> Model:
        return Model.load(spark, f"{self.folder.rstrip('/')}/{number:06d}")


def score_batches(
    raw: DataFrame, versions: ModelVersions, sink: str, checkpoint: str, keep: list[Column | str] = ("tip_pct",),
    prepare: Callable[[DataFrame], DataFrame] = clean_and_featurize,
) -> None:
    """Scores each micro-batch by the newest model and stops when the source is drained.

    A batch is written to a folder of its own number, with the model's version beside each row. Spark
    repeats a batch that broke off under the same number, and the repeat replaces the folder, so each
    row is in the sink once. A model published on the way counts from the next batch on.
    """
    held: dict[int, Model] = {}

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        newest = versions.numbers(spark)[-1]
        if newest not in held:
            held.clear()
            held[newest] = versions.load(spark, newest)
        scored = held[newest].score(prepare(batch), keep=list(keep)).withColumn("model_version", F.lit(newest))
        scored.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch={number}")

    run_batches(raw, one, checkpoint)


def run_available(stream: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Processes everything present into Parquet and stops; a re-run takes up new files only."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_batches(stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hands each micro-batch to ``on_batch`` until the source is drained."""
    query = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
