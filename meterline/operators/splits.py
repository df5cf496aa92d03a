"""Best split per tree node from its histogram.

A node's histogram is a small matrix, features by bins, so all its split candidates are a few numpy
operations. Spark brings each node's cells to one task and runs the nodes side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MIN_GAIN = 1e-6  # fixed value: a split must gain more than this
MAX_CAT_THRESHOLD = 64  # fixed value: largest category set on the smaller side


@dataclass
class Penalty:
    """What a node's trial asks of a split; which features are categories, and which of them one against the rest."""

    reg_lambda: float
    reg_alpha: float
    min_child_weight: float
    is_cat: np.ndarray
    onehot: np.ndarray


def _score(g: np.ndarray, h: np.ndarray, p: Penalty) -> np.ndarray:
    """Objective of a node that takes its best weight: T(g)^2 / (h + lambda); NaN where that has no value."""
    top = np.maximum(np.abs(g) - p.reg_alpha, 0.0) ** 2
    below = h + p.reg_lambda
    return np.divide(top, below, out=np.full(np.shape(top), np.nan), where=below != 0)


def scan_node(g: np.ndarray, h: np.ndarray, p: Penalty) -> dict[str, np.ndarray]:
    """Every split candidate of a node with its gain, for missing rows sent left and sent right.

    ``g`` and ``h`` are sums by (feature, bin). Numeric bins are cut in their own order, categories in
    the order of their mean gradient, and features with ``onehot`` one bin against the rest. Bin 0
    holds the missing rows; bins without rows are no candidates and have no place.
    """
    present = h > 0
    present[:, 0] = False
    by_mean = p.is_cat & ~p.onehot
    bins = np.arange(h.shape[1])
    mean = np.divide(g, h + p.reg_lambda, out=np.zeros_like(g), where=h + p.reg_lambda != 0)
    key = np.where(by_mean[:, None], mean, bins)
    order = np.lexsort((np.broadcast_to(bins, key.shape), key, ~present), axis=1)
    gp, hp, pos = np.zeros_like(g), np.zeros_like(h), np.zeros(h.shape, np.int64)
    shown = np.take_along_axis(present, order, 1)
    for into, values in ((gp, g), (hp, h), (pos, np.ones_like(g))):
        sums = np.cumsum(np.where(shown, np.take_along_axis(values, order, 1), 0.0), axis=1)
        np.put_along_axis(into, order, sums.astype(into.dtype), 1)
    gt, ht, gm, hm = g.sum(1)[:, None], h.sum(1)[:, None], g[:, :1], h[:, :1]
    gl = np.where(p.onehot[:, None], gt - gm - g, gp)
    hl = np.where(p.onehot[:, None], ht - hm - h, hp)
    few = np.minimum(pos, present.sum(1)[:, None] - pos) <= MAX_CAT_THRESHOLD
    fits = present & (~by_mean[:, None] | few)

    def gain(left_g: np.ndarray, left_h: np.ndarray) -> np.ndarray:
        rg, rh = gt - left_g, ht - left_h
        ok = fits & (left_h > 0) & (rh > 0) & (left_h >= p.min_child_weight) & (rh >= p.min_child_weight)
        total = _score(left_g, left_h, p) + _score(rg, rh, p) - _score(gt, ht, p)
        return np.where(ok & ~np.isnan(total), total, -1.0)

    right, left = gain(gl, hl), gain(gl + gm, hl + hm)
    to_right = right >= left
    return {
        "gain_right": right,
        "gain_left": left,
        "missing_right": to_right,
        "gain": np.maximum(right, left),
        "pos": pos,
        "present": present,
        "by_mean": by_mean,
        "g_left": np.where(to_right, gl, gl + gm),
        "h_left": np.where(to_right, hl, hl + hm),
        "gt": gt[:, 0],
        "ht": ht[:, 0],
    }


def best_of(scan: dict[str, np.ndarray]) -> dict:
    """The candidate of greatest gain (ties: lower feature, lower bin); gain -1 if there is none.

    ``right`` lists the bins right of a cut through categories in the order of their means.
    """
    f, b = np.unravel_index(int(scan["gain"].argmax()), scan["gain"].shape)
    if scan["gain"][f, b] < 0:  # no candidate: totals of a feature that has rows
        f, b = int(scan["ht"].argmax()), 0
    by_mean = bool(scan["by_mean"][f])
    right = np.flatnonzero(scan["present"][f] & (scan["pos"][f] > scan["pos"][f, b])) if by_mean else ()
    return {
        "feature": int(f),
        "gain": float(scan["gain"][f, b]),
        "bin": int(b),
        "missing_right": bool(scan["missing_right"][f, b]),
        "by_mean": by_mean,
        "g_left": float(scan["g_left"][f, b]),
        "h_left": float(scan["h_left"][f, b]),
        "g": float(scan["gt"][f]),
        "h": float(scan["ht"][f]),
        "right": [int(x) for x in right],
    }


SPLIT = pa.schema(
    [
        ("slot", pa.int64()),
        ("feature", pa.int32()),
        ("gain", pa.float64()),
        ("bin", pa.int32()),
        ("missing_right", pa.bool_()),
        ("by_mean", pa.bool_()),
        ("g_left", pa.float64()),
        ("h_left", pa.float64()),
        ("g", pa.float64()),
        ("h", pa.float64()),
        ("right", pa.list_(pa.int32())),
    ]
)
SPLIT_TYPE = (
    "slot long, feature int, gain double, bin int, missing_right boolean, by_mean boolean, "
    "g_left double, h_left double, g double, h double, right array<int>"
)


def _node(table: pa.Table) -> tuple[np.ndarray, np.ndarray, Penalty]:
    """A node's matrices and penalty from its cells (feature, bin, g, h, is_cat, onehot, ...)."""
    feature, bin_no = table["feature"].to_numpy().astype(int), table["bin"].to_numpy().astype(int)
    shape = feature.max() + 1, bin_no.max() + 1
    g, h = np.zeros(shape), np.zeros(shape)
    g[feature, bin_no], h[feature, bin_no] = table["g"].to_numpy(), table["h"].to_numpy()
    flags = {}
    for name in ("is_cat", "onehot"):
        flags[name] = np.zeros(shape[0], bool)
        flags[name][feature] = table[name].to_numpy(zero_copy_only=False)
    first = [float(table[c][0].as_py()) for c in ("reg_lambda", "reg_alpha", "min_child_weight")]
    return g, h, Penalty(*first, flags["is_cat"], flags["onehot"])


def scan_splits(cells: DataFrame) -> DataFrame:
    """A row per cell: (slot, feature, bin, gain_left, gain_right, gain, missing_right, pos).

    ``cells`` has (slot, feature, bin, g, h, is_cat, onehot, reg_lambda, reg_alpha, min_child_weight).
    """

    def run(table: pa.Table) -> pa.Table:
        scan = scan_node(*_node(table))
        f, b = table["feature"].to_numpy().astype(int), table["bin"].to_numpy().astype(int)
        out = {c: pa.array(scan[c][f, b]) for c in ("gain_left", "gain_right", "gain", "missing_right")}
        pos = pa.array(scan["pos"][f, b].astype(np.int32))
        return pa.table(
            {"slot": table["slot"], "feature": pa.array(f.astype(np.int32)), "bin": pa.array(b.astype(np.int32)), **out, "pos": pos}
        )

    kind = "slot long, feature int, bin int, gain_left double, gain_right double, gain double, missing_right boolean, pos int"
    return cells.groupBy("slot").applyInArrow(run, kind)


def best_splits(cells: DataFrame) -> DataFrame:
    """One row per slot: its best candidate. ``cells`` as for ``scan_splits``."""

    def run(table: pa.Table) -> pa.Table:
        best = best_of(scan_node(*_node(table)))
        return pa.Table.from_pylist([{"slot": table["slot"][0].as_py(), **best}], SPLIT)

    return cells.groupBy("slot").applyInArrow(run, SPLIT_TYPE)


def merged_splits(partials: DataFrame, penalties: dict[int, Penalty], node_span: int, stride: int) -> DataFrame:
    """Best splits of both children of each split node, and their sums, from partial sums of one child.

    ``partials`` has (pair, slot, g, h): under the parent's slot the scans' sums of the child that was
    scanned, and the parent's own sums with ``slot`` null. The other child is parent minus child; at the
    root, where there is no parent, the pair is its only node. Sums are 64-bit floats as bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, sums, parent = None, None, None
        for batch in batches:
            for at, g, h in zip(batch["slot"].to_pylist(), batch["g"], batch["h"]):
                both = np.stack([np.frombuffer(x.as_buffer(), np.float64) for x in (g, h)])
                if at is None:
                    parent = both
                else:
                    slot, sums = at, both.copy() if sums is None else sums + both
        if slot is None:  # the parent was a leaf in the end
            return
        nodes = [(slot, sums)]
        if parent is not None:
            other = parent - sums
            other[:, other[1] <= 1e-9 * np.maximum(parent[1], 1e-30)] = 0.0
            nodes.append((slot + 1 if slot % node_span % 2 else slot - 1, other))
        rows, held = [], []
        for at, (g, h) in nodes:
            p = penalties[at // node_span]
            rows.append({"slot": at, **best_of(scan_node(g.reshape(-1, stride), h.reshape(-1, stride), p))})
            held.append((g.tobytes(), h.tobytes()))
        out = pa.RecordBatch.from_pylist(rows, SPLIT)
        columns = [*out.columns, *(pa.array(c, pa.binary()) for c in zip(*held))]
        yield pa.RecordBatch.from_arrays(columns, [*SPLIT.names, "g_sums", "h_sums"])

    return partials.groupBy("pair").applyInArrow(run, f"{SPLIT_TYPE}, g_sums binary, h_sums binary")
