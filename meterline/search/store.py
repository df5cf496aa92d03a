"""The trial history as append-only commits, one folder per append.

A commit is one table: a row per trial with its reports inside, so trials and reports are there together or
not at all. Spark writes it atomically; readers take only folders whose write was finished.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import list_folder
from .space import SPACE

_PARAMS = ", ".join(f"{p.name} {'int' if p.kind == 'int' else 'double'}" for p in SPACE)
TRIALS = f"study string, trial_id int, {_PARAMS}, status string, rmse double"
_REPORT = "report_no int, boost_round int, valid_rmse double, seq bigint"
REPORTS = f"study string, trial_id int, {_REPORT}"
_COMMIT = f"{TRIALS}, reports array<struct<{', '.join(c.replace(' ', ': ') for c in _REPORT.split(', '))}>>"


@dataclass(frozen=True)
class TrialStore:
    folder: str

    def commits(self, spark: SparkSession, study: str | None = None) -> list[str]:
        """Folders of finished commits, of one study or of all."""
        root = self.folder.rstrip("/")
        studies = list_folder(spark, root) if study is None else [quote(study, safe="")]
        every = [f"{root}/{s}/{c}" for s in studies for c in list_folder(spark, f"{root}/{s}")]
        return sorted(p for p in every if "_SUCCESS" in list_folder(spark, p))

    def _read(self, spark: SparkSession, study: str | None) -> DataFrame:
        paths = self.commits(spark, study)
        return spark.read.schema(_COMMIT).parquet(*paths) if paths else spark.createDataFrame([], _COMMIT)

    def trials(self, spark: SparkSession, study: str | None = None) -> DataFrame:
        return self._read(spark, study).drop("reports")

    def reports(self, spark: SparkSession, study: str | None = None) -> DataFrame:
        return self._read(spark, study).select("study", "trial_id", F.inline("reports"))

    def append(self, trials: DataFrame, reports: DataFrame) -> None:
        """Adds finished trials of a study with their reports, in one commit; the first one creates the study.

        A few hundred rows at most, hence one file. Reports of other trials are not kept.
        """
        key = ["study", "trial_id"]
        fields = [c.split()[0] for c in _REPORT.split(", ")]
        nested = reports.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("reports"))
        rows = trials.join(nested, key, "left").select(*[c.strip().split()[0] for c in TRIALS.split(",")], "reports")
        for (study,) in trials.select("study").distinct().collect():  # one study as a rule
            path = f"{self.folder.rstrip('/')}/{quote(study, safe='')}/{uuid.uuid4().hex}"
            own = rows.filter(F.col("study") == study).withColumn("reports", F.coalesce("reports", F.array()))
            own.coalesce(1).write.parquet(path)
