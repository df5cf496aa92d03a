"""Session helpers for local runs, and the shared scratch folder for jobs that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def tune(spark: SparkSession) -> SparkSession:
    """Session settings this package's applications run with.

    Methods above 8,000 bytes of bytecode stay uncompiled in the JVM. With the limit set,
    Spark runs such a stage (feature columns and their binning, say) operator by operator,
    in methods that do compile: four to ten times faster here.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def local_session(cores: str | int = "*", app: str = "meterline", **conf: str) -> SparkSession:
    """A session for tests and benches. On a cluster the session comes from spark-submit."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # The training loop alternates more generated classes than the default 100 entries.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def loop_session(spark: SparkSession) -> SparkSession:
    """A session beside the caller's, for loops of many small, similar jobs.

    Adaptive planning is off in it: the loop knows its shuffle sizes, and re-planning every
    stage (each time describing all cached tables beneath it) took longer than the stages.
    The caller's settings are otherwise taken over and its own session is left alone.
    """
    side = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if k.startswith("spark.sql.") and side.conf.isModifiable(k):
            side.conf.set(k, v)
    side.conf.set("spark.sql.adaptive.enabled", "false")
    return side


def file_per_task(spark: SparkSession) -> SparkSession:
    """Sets that a file costs a whole partition to open: scans then read a file, or a piece of one, per task."""
    for name in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.set(f"spark.sql.files.{name}", "128m")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="meterline-")
        sc.setCheckpointDir(root)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch table this process wrote."""
    if not path.startswith(scratch_root(spark).rstrip("/") + "/"):
        raise ValueError(f"{path} is not a scratch path")
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def stored(df: DataFrame, label: str, rows_per_task: int = 0) -> Iterator[DataFrame]:
    """The rows as a scratch table, for loops that read them often; it goes when the block ends.

    With ``rows_per_task`` the table is read by tasks of so many rows at most, in a session of its own.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    try:
        df.write.option("maxRecordsPerFile", rows_per_task).parquet(path)
        if rows_per_task:
            spark = file_per_task(loop_session(spark))
        yield spark.read.parquet(path)
    finally:
        drop_path(df.sparkSession, path)


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder of any file system Spark knows holds; none if there is no such folder."""
    fs, p = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, None if there is no such file."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return None
    return "\n".join(r["value"] for r in spark.read.text(path).collect())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file under another name and renames it: it is there whole or not at all."""
    fs, p = _path(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(p, False)
    if not fs.rename(part, p):
        raise OSError(f"cannot write {path}")
