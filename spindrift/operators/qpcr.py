"""Cycle ranges of qPCR wells by knees of their curves; a well has a few dozen cycles."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.operators.matrix import cycles_with_groups, pad_cycles, qpcr_groups


def knee(x: np.ndarray, y: np.ndarray, curve: str, sensitivity: float = 1.0) -> float | None:
    """The last knee of an increasing curve, by the published Kneedle rule; None without one.

    Both axes are scaled to 0..1 and, for a convex curve, turned by half a circle so
    that the elbow becomes a knee.  A local maximum of y - x is one if the
    difference later falls below it by ``sensitivity`` mean steps before the next
    maximum, or starts to rise again after a local minimum.
    """
    if len(x) < 3 or np.ptp(x) == 0 or np.ptp(y) == 0:
        return None
    u, v = (x - x.min()) / np.ptp(x), (y - y.min()) / np.ptp(y)
    if curve == "convex":
        u, v, x = 1 - u[::-1], 1 - v[::-1], x[::-1]
    rise = v - u
    step = sensitivity * np.diff(u).mean()
    found, at, bar = None, None, 0.0
    for i in range(1, len(u) - 1):
        if rise[i] >= rise[i - 1] and rise[i] >= rise[i + 1]:
            at, bar = i, rise[i] - step
        elif at is not None and rise[i] <= rise[i - 1] and rise[i] <= rise[i + 1]:
            bar = 0.0
        if at is not None and rise[i + 1] < bar:
            found = at
    return None if found is None else float(x[found])


def check_wells(df: DataFrame, column: str = "rn", sensitivity: float = 2.0, low_offset: int = 1, high_offset: int = 0, prepend: int = 2) -> DataFrame:
    """(well_id, low, high, mean, error) from (well_id, cycle, ``column``): the elbow and the knee of each well.

    Cycles are padded below first.  A well without an elbow starts at its first
    cycle, one without a knee ends at its last; either is an error when the bound
    falls on the curve's own end, and so is a range that ends before it starts.
    Rows with a null are left out.
    """

    def one(key, g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["cycle", "y"])
        x, y = g["cycle"].to_numpy(dtype=float), g["y"].to_numpy(dtype=float)
        elbow, top = knee(x, y, "convex", sensitivity), knee(x, y, "concave", sensitivity)
        low = x.min() if elbow is None else elbow + low_offset
        high = x.max() if top is None else top + high_offset
        error = bool(low > high or low == x.min() + low_offset or high == x.max() + high_offset)
        return pd.DataFrame({"well_id": [key[0]], "low": [int(low)], "high": [int(high)], "mean": [(low + high) / 2], "error": [error]})

    rows = df.select(F.col("well_id").cast("string").alias("well_id"), F.col("cycle").cast("int").alias("cycle"), F.col(column).cast("double").alias("y")).na.drop()
    padded = pad_cycles(rows, prepend=prepend)
    return padded.groupBy("well_id").applyInPandas(one, "well_id string, low int, high int, mean double, error boolean")


def cycle_report(df: DataFrame, span: float = 3.0, **settings) -> DataFrame:
    """Every well's range with the group and the recommended cycles of the wells without an error."""
    wells = check_wells(df, **settings)
    return cycles_with_groups(wells, qpcr_groups(wells, span))
