"""The eight searched parameters and draws from their ranges."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import md5_uniform


@dataclass(frozen=True)
class Param:
    """``int`` ranges exclude ``high``. ``log`` draws are uniform in the logarithm."""

    name: str
    kind: str
    low: float
    high: float

    def value(self, u: Column) -> Column:
        """Maps a unit coordinate to the range."""
        if self.kind == "int":
            return (F.floor(u * (self.high - self.low)) + int(self.low)).cast("int")
        if self.kind == "log":
            a, b = math.log(self.low), math.log(self.high)
            return F.exp(F.lit(a) + u * F.lit(b - a))
        return F.lit(float(self.low)) + u * F.lit(float(self.high - self.low))

    def unit(self, v: Column) -> Column:
        """Maps a value back to [0, 1)."""
        if self.kind == "int":
            return (v - int(self.low) + 0.5) / (self.high - self.low)
        if self.kind == "log":
            a, b = math.log(self.low), math.log(self.high)
            return (F.log(v) - a) / (b - a)
        return (v - self.low) / (self.high - self.low)


# The search ranges.
SPACE = (
    Param("max_depth", "int", 4, 13),
    Param("learning_rate", "log", 0.01, 0.3),
    Param("subsample", "uniform", 0.5, 1.0),
    Param("colsample_bytree", "uniform", 0.4, 1.0),
    Param("min_child_weight", "log", 1.0, 300.0),
    Param("reg_lambda", "log", 0.01, 100.0),
    Param("reg_alpha", "log", 0.001, 10.0),
    Param("max_cat_to_onehot", "int", 1, 16),
)


def space() -> tuple[Param, ...]:
    return SPACE


def draw_configs(trials: DataFrame, id_col: str = "trial_id", seed: int = 0) -> DataFrame:
    """One independent draw per row of ``trials``; the draw depends on the id and seed."""
    draws = [
        p.value(md5_uniform(F.col(id_col), F.lit(p.name), seed=seed)).alias(p.name) for p in SPACE
    ]
    return trials.select(id_col, *draws)
