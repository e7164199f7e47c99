"""Eligibility, imputation and regrouping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscore.schemas import MEAN_IMPUTED, UNKNOWN_IMPUTED, zero_imputed

# --------------------------------------------------------------------------
# Thresholds, loyalty classes and handset systems.
# --------------------------------------------------------------------------

MIN_SERVICE_MONTHS = 4
MIN_AVERAGE_REVENUE = 40

SEGMENT_CLASS = {
    "NA": "Classic",
    "Prospect Emerald": "Classic",
    "Platinum Plus": "Platinum",
    "Prospect Plat Plus": "Platinum",
    "Prospect Platinum": "Gold",
    "Prospect Gold": "Emerald",
    "Standard": "Classic",
}
MISSING_SEGMENT_CLASS = "Classic"

KNOWN_HANDSET_OS = ["Android", "iOS", "Proprietary", "Unknown"]
OTHER_HANDSET_OS = "others"


def eligible_base(df: DataFrame) -> DataFrame:
    """Active subscribers with enough service months and revenue; numeric age.

    Text that is no number becomes a null age.
    """
    return df.withColumn("age", F.col("age").try_cast("double")).filter(
        (F.col("mobile_status") == "SA")
        & F.col("analytic_id").isNotNull()
        & (F.col("service_month") >= MIN_SERVICE_MONTHS)
        & (F.col("norms_net_revenue_avg_3mth_p0_p2") >= MIN_AVERAGE_REVENUE)
    )


def _present(column: str) -> Column:
    """The value as double, null if it is null or NaN."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def column_means(df: DataFrame, columns: Sequence[str] = MEAN_IMPUTED) -> DataFrame:
    """One row: the mean of each column over its present values."""
    return df.agg(*[F.avg(_present(c)).alias(c) for c in columns])


def _mean_filled(fit_on: DataFrame, columns: Sequence[str], means: Mapping[str, float] | None) -> dict[str, Column]:
    if means is not None:
        return {c: F.coalesce(_present(c), F.lit(float(means[c]))) for c in columns}
    fitted = column_means(fit_on, columns).select(F.struct(*columns)).scalar()
    return {c: F.coalesce(_present(c), fitted.getField(c)) for c in columns}


def impute_mean(
    df: DataFrame,
    columns: Sequence[str] = MEAN_IMPUTED,
    means: Mapping[str, float] | None = None,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Replace null and NaN by the column mean.

    The mean is that of ``df``, or of ``fit_on`` if that gives the same values
    from a narrower plan, or is given in ``means`` (to score with the means of
    the training set). It enters as a scalar subquery: neither a join nor a
    value fetched to the driver.
    """
    return df.withColumns(_mean_filled(fit_on or df, columns, means))


def impute_unknown(df: DataFrame, columns: Sequence[str] = UNKNOWN_IMPUTED) -> DataFrame:
    return df.na.fill("unknown", subset=list(columns))


def impute_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace null and NaN by zero."""
    return df.na.fill(0, subset=list(columns or zero_imputed()))


def regroup_segment(df: DataFrame) -> DataFrame:
    """``master_segment_id`` becomes the loyalty class ``serenade``."""
    segment = F.col("master_segment_id")
    serenade = F.when(segment.isNull(), MISSING_SEGMENT_CLASS)
    for name, group in SEGMENT_CLASS.items():
        serenade = serenade.when(segment == name, group)
    return df.withColumn("serenade", serenade.otherwise(segment)).drop("master_segment_id")


def bucket_handset_os(df: DataFrame) -> DataFrame:
    """Keep the known systems; all else, the imputed ``unknown`` too, is one group."""
    system = F.col("handset_os")
    return df.withColumn(
        "handset_os", F.when(system.isin(KNOWN_HANDSET_OS), system).otherwise(F.lit(OTHER_HANDSET_OS))
    )


def default_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("mnp_flag", F.coalesce("mnp_flag", F.lit("N")))


def imputed_base(
    eligible: DataFrame,
    training: bool,
    validity_features: list[str] | None = None,
    means: Mapping[str, float] | None = None,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """The three imputations as one projection over the eligible rows.

    Imputing in place equals imputing three projections and joining them back
    on the subscription key, as long as that key is unique and not null.
    """
    zeros = zero_imputed(validity_features)
    label = ["bad_flag"] if training else []
    filled = impute_zero(impute_unknown(impute_mean(eligible, means=means, fit_on=fit_on)), zeros)
    return filled.select(
        "analytic_id",
        "crm_sub_id",
        *label,
        "national_id",
        "register_date",
        *MEAN_IMPUTED,
        "mnp_flag",
        "master_segment_id",
        *UNKNOWN_IMPUTED,
        *zeros,
    )


def assemble_clean_base(
    features: DataFrame,
    training: bool,
    validity_features: list[str] | None = None,
    means: Mapping[str, float] | None = None,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Eligible, imputed and regrouped rows.

    ``fit_on`` holds the rows before the eligibility test from which the means
    are taken; by default ``features`` themselves.
    """
    fitted = eligible_base(fit_on) if fit_on is not None else None
    base = imputed_base(eligible_base(features), training, validity_features, means, fitted)
    return default_flag(bucket_handset_os(regroup_segment(base)))
