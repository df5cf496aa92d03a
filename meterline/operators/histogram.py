"""Gradient histograms per (tree node, feature, bin)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SQUARED, LOGISTIC = "squared", "logistic"
_P = "(1e0 / (1e0 + exp(-pred)))"
#: First and second derivative of the objective by the prediction, as SQL over (pred, y).
GRADIENT = {SQUARED: "(pred - y)", LOGISTIC: f"({_P} - y)"}
HESSIAN = {SQUARED: "1e0", LOGISTIC: f"greatest({_P} * (1e0 - {_P}), 1e-16)"}


def gradient(pred: Column, y: Column) -> Column:
    """First derivative of squared error; the second derivative is 1 for every row."""
    return pred - y


def derivatives(pred: np.ndarray, y: np.ndarray, objective: str) -> tuple[np.ndarray, np.ndarray | None]:
    """The same two in arrays; None stands for a second derivative of 1."""
    if objective == SQUARED:
        return pred - y, None
    p = 1.0 / (1.0 + np.exp(-pred))
    return p - y, np.maximum(p * (1.0 - p), 1e-16)


class Sums:
    """Sums of g and h by (node, code) of a task: at most nodes x codes numbers, whatever its rows."""

    def __init__(self, nodes: int, span: int):
        self.nodes, self.span = nodes, span
        self.g, self.h = np.zeros(nodes * span), np.zeros(nodes * span)

    def add(self, node: np.ndarray, codes: np.ndarray, g: np.ndarray, h: np.ndarray | None) -> None:
        """Rows' nodes (from 0), codes (a matrix), and derivatives."""
        cell = (node[:, None] * self.span + codes).ravel()
        width, size = codes.shape[1], len(self.g)
        self.g += np.bincount(cell, np.repeat(g, width), size)
        self.h += np.bincount(cell, None if h is None else np.repeat(h, width), size)

    def of(self, node: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(node * self.span, (node + 1) * self.span)
        return self.g[at], self.h[at]


#: Codes of a type as bytes.
PACKED = {"smallint": "<i2", "int": "<i4"}


def matrix(codes: pa.Array, code_type: str | None = None) -> np.ndarray:
    """A batch of code arrays as one matrix; with ``code_type`` they are packed as bytes of that type."""
    if code_type is None:
        flat = codes.flatten().to_numpy(zero_copy_only=False)
    else:
        _, ends, data = codes.buffers()
        ends = np.frombuffer(ends, np.int64 if pa.types.is_large_binary(codes.type) else np.int32)
        first, last = ends[codes.offset], ends[codes.offset + len(codes)]
        flat = np.frombuffer(data, np.uint8)[first:last].view(PACKED[code_type])
    return flat.reshape(len(codes), -1).astype(np.int64)


def as_bytes(codes: np.ndarray) -> pa.Array:
    """The rows of a matrix as one binary value each."""
    ends = np.arange(len(codes) + 1, dtype=np.int32) * (codes.shape[1] * codes.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(codes), [None, pa.py_buffer(ends), pa.py_buffer(codes.tobytes())])


def histogram(rows: DataFrame, span: int) -> DataFrame:
    """(slot, code, g, h) from rows (slot, g, codes), h being the number of rows; ``span`` exceeds every code.

    Tasks add up by (slot, code) as the training loop's scans do; Spark adds the tasks' sums.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Sums] = {}
        for batch in batches:
            slot, g = batch["slot"].to_numpy(), batch["g"].to_numpy()
            codes = matrix(batch["codes"])
            for s in np.unique(slot):
                own = slot == s
                held.setdefault(int(s), Sums(1, span)).add(np.zeros(own.sum(), np.int64), codes[own], g[own], None)
        for s, sums in held.items():
            code = np.flatnonzero(sums.h)
            columns = [pa.array(np.full(len(code), s)), pa.array(code.astype(np.int32)), pa.array(sums.g[code]), pa.array(sums.h[code])]
            yield pa.RecordBatch.from_arrays(columns, ["slot", "code", "g", "h"])

    parts = rows.select("slot", "g", "codes").mapInArrow(run, "slot long, code int, g double, h double")
    return parts.groupBy("slot", "code").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def histogram_by_slot(rows: DataFrame, keep_code: str | None = None, unpack: Callable[[str], Column] = F.col) -> DataFrame:
    """(slot, code, g, h) from rows (slot, g, h, codes) that first move to their slot's task, as they are until ``unpack``.

    For many slots with few rows each, where partial sums would save nothing: a row moves once, with its
    codes as one array, and its slot's cells form and stay in one task. No slot may be hot. ``keep_code``
    is a SQL condition on code and the rows' other columns.
    """
    moved = rows.repartition("slot").withColumn("codes", unpack("codes"))
    cells = moved.selectExpr(*[c for c in moved.columns if c != "codes"], "explode(codes) as code")
    if keep_code is not None:
        cells = cells.filter(keep_code)
    return cells.groupBy("slot", F.col("code").cast("int").alias("code")).agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
