"""The convex hull of the curve of true against false positives.

Only the hull's points can be the best threshold at any cost of the two errors. The curve has
a point per distinct score; its hull, whole numbers in a box of N by N, has at most some
N^(2/3), and few in practice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subscore.operators.metrics import roc_points
from subscore.session import ship_package

X, Y = "false_positives", "true_positives"


def upper_hull(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Places of the points on the upper hull, from left to right; points must differ.

    A point on or below the line between any two others isn't on the hull. So whatever fails
    between its neighbours goes, until all that is left turns right: that is the hull.
    Products are exact up to 2^64.
    """
    kept = np.lexsort((y, x))
    while len(kept) > 2:
        dx, dy = (np.diff(v[kept].astype(np.longdouble)) for v in (x, y))
        turns_right = dx[:-1] * dy[1:] < dy[:-1] * dx[1:]
        if turns_right.all():
            break
        kept = kept[np.r_[True, turns_right, True]]
    return kept


def _hull_of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hull = None
    for batch in batches:
        points = batch if hull is None else pd.concat([hull, batch], ignore_index=True)
        hull = points.iloc[upper_hull(points[X].to_numpy(), points[Y].to_numpy())] if len(points) else None
    if hull is not None:
        yield hull


def _whole_hull(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    origin = pd.DataFrame({"threshold": [None], Y: [0], X: [0]}).astype({"threshold": "float64"})
    for hull in _hull_of_batches(batches):
        yield from _hull_of_batches(iter([pd.concat([origin, hull], ignore_index=True)]))


def roc_hull(df: DataFrame, score: str, label: str) -> DataFrame:
    """The points of ``roc_points`` on the curve's upper hull, with the one at the origin (threshold null).

    A hull of each partition, then the hull of those: a task holds a batch and a hull, and what
    meets in one task are hulls only. Points on a line between two others are left out.
    No labelled rows give no points.
    """
    ship_package(df.sparkSession)
    points = roc_points(df.filter(F.col(label).isin(0, 1)), score, label).select(
        F.col("threshold").cast("double").alias("threshold"), Y, X
    )
    shape = f"threshold double, {Y} bigint, {X} bigint"
    hull = points.mapInPandas(_hull_of_batches, shape).repartition(1).mapInPandas(_whole_hull, shape)
    everything = Window.partitionBy()  # the hull only, which is in one partition already
    return hull.select(
        "threshold",
        Y,
        X,
        F.try_divide(Y, F.max(Y).over(everything)).alias("true_positive_rate"),
        F.try_divide(X, F.max(X).over(everything)).alias("false_positive_rate"),
    )
