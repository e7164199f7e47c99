"""Features over the three months p0, p1 and p2 of each measure."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subscore.schemas import LAG_COLUMNS, MEASURES, lag_name


def _months(measure: str) -> list[Column]:
    return [F.col(measure), F.col(lag_name(measure, 1)), F.col(lag_name(measure, 2))]


def derive_mean(df: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    return df.withColumns({f"avg_{m}": reduce(add, _months(m)) / 3 for m in measures})


def derive_sd(df: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Population deviation of the three months; needs the ``avg_`` columns."""

    def deviation(measure: str) -> Column:
        mean = F.col(f"avg_{measure}")
        return F.sqrt(reduce(add, [(x - mean) * (x - mean) for x in _months(measure)]) / 3)

    return df.withColumns({f"sd_{m}": deviation(m) for m in measures})


def derive_slope(df: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Growth of p0 over the mean of p1 and p2; null where that mean is zero."""

    def slope(measure: str) -> Column:
        now, one_back, two_back = _months(measure)
        return F.try_divide(now.cast("double"), (one_back + two_back) / 2) - 1

    return df.withColumns({f"slope_{m}_p1": slope(m) for m in measures})


def finalize_features(df: DataFrame) -> DataFrame:
    """Drop helpers; any number still missing, the label too, becomes zero."""
    kept = df.drop("national_id", *LAG_COLUMNS)
    numeric = [f.name for f in kept.schema if isinstance(f.dataType, T.NumericType)]
    return kept.na.fill(0, subset=numeric)


def derive_features(df: DataFrame) -> DataFrame:
    return finalize_features(derive_slope(derive_sd(derive_mean(df))))
