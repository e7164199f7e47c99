"""Ranking quality: area under the curve, its points, gains, decile lift.

All but the gains groups come from the counts per distinct score, combined on the map
side. Scores are taken as they are; their running sums are summed up by ranges, so
there may be as many distinct scores as rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subscore.functions.positions import with_running_sums
from subscore.operators.ranking import ntile_exact
from subscore.schemas import LIFT_SCHEMA, SUBSCRIPTION_KEY
from subscore.session import shared_folder


def score_histogram(df: DataFrame, score: str, label: str) -> DataFrame:
    """Rows of each class per distinct score; unlabelled rows do not count."""
    return (
        df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(
            F.count_if(F.col(label) == 1).alias("events"),
            F.count_if(F.col(label) == 0).alias("nonevents"),
        )
    )


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Chance that an event scores above a non-event, ties counting one half."""
    path = f"{shared_folder(df.sparkSession, 'auc')}/histogram"
    histogram = with_running_sums(score_histogram(df, score, label), [F.asc("score")], ["nonevents"], path)
    wins = F.sum(F.col("events") * (F.col("before_nonevents") + F.col("nonevents") / 2))
    pairs = F.sum("events").cast("double") * F.sum("nonevents")
    return histogram.agg(
        F.sum("events").alias("n_events"),
        F.sum("nonevents").alias("n_nonevents"),
        F.try_divide(wins, pairs).alias("auc"),
    )


def roc_points(df: DataFrame, score: str, label: str) -> DataFrame:
    """True and false positive rate when every score from the threshold up is positive."""
    path = f"{shared_folder(df.sparkSession, 'roc')}/histogram"
    rates = {"true": "events", "false": "nonevents"}
    histogram = with_running_sums(score_histogram(df, score, label), [F.desc("score")], list(rates.values()), path)
    upto = {kind: F.col(f"before_{c}") + F.col(c) for kind, c in rates.items()}
    return histogram.select(
        F.col("score").alias("threshold"),
        *[n.alias(f"{kind}_positives") for kind, n in upto.items()],
        *[F.try_divide(upto[kind], F.col(f"total_{c}")).alias(f"{kind}_positive_rate") for kind, c in rates.items()],
    )


def gains_lift(
    df: DataFrame, score: str, label: str, groups: int = 16, tie_break: Sequence[str] = SUBSCRIPTION_KEY
) -> DataFrame:
    """Gains and lift per equal-count group, group 1 holding the highest scores."""
    labelled = df.filter(F.col(label).isNotNull())
    ranked = ntile_exact(labelled, score, {"group": groups}, tie_break, descending=True)
    per_group = ranked.groupBy("group").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(label).cast("long")).alias("events"),
        F.min(score).alias("lower_threshold"),
    )
    running = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def total(column: str) -> Column:
        return F.sum(column).over(whole)

    def so_far(column: str) -> Column:
        return F.sum(column).over(running)

    overall = F.try_divide(total("events"), total("n"))
    return per_group.withColumns(
        {
            "cumulative_data_fraction": so_far("n") / total("n"),
            "response_rate": F.col("events") / F.col("n"),
            "cumulative_response_rate": so_far("events") / so_far("n"),
            "capture_rate": F.try_divide(F.col("events"), total("events")),
            "cumulative_capture_rate": F.try_divide(so_far("events"), total("events")),
            "lift": F.try_divide(F.col("events") / F.col("n"), overall),
            "cumulative_lift": F.try_divide(so_far("events") / so_far("n"), overall),
            "kolmogorov_smirnov": F.try_divide(so_far("events"), total("events"))
            - F.try_divide(so_far("n") - so_far("events"), total("n") - total("events")),
        }
    ).select(
        "group",
        "cumulative_data_fraction",
        "lower_threshold",
        "lift",
        "cumulative_lift",
        "response_rate",
        "cumulative_response_rate",
        "capture_rate",
        "cumulative_capture_rate",
        (100 * (F.col("lift") - 1)).alias("gain"),
        (100 * (F.col("cumulative_lift") - 1)).alias("cumulative_gain"),
        "kolmogorov_smirnov",
    )


def decile_lift_table(subscribers: DataFrame) -> DataFrame:
    """Usage, bad rate and lift per month and decile, and cumulated from decile 1.

    Input columns: ``prof_date``, ``decile``, ``score``, ``bad`` (null if
    unlabelled), ``used`` and ``trx``. Rates are over labelled subscribers.
    ``lift_rate`` is the month's bad rate over the cumulated one: high is good.
    """
    is_labelled = F.col("bad").isNotNull()
    per_decile = subscribers.groupBy("prof_date", "decile").agg(
        F.count(F.lit(1)).alias("no_subs"),
        F.min("score").alias("lower_treshold"),
        F.count_if(is_labelled).alias("base"),
        F.count_if(is_labelled & (F.col("used") == 1)).alias("users"),
        F.count_if(F.col("bad") == 1).alias("bads"),
        F.coalesce(F.sum(F.when(is_labelled, F.col("trx"))), F.lit(0)).alias("trx"),
    )
    month = Window.partitionBy("prof_date")
    running = month.orderBy("decile").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def so_far(column: str) -> Column:
        return F.sum(column).over(running)

    month_rate = F.round(F.try_divide(F.sum("bads").over(month), F.sum("base").over(month)), 5)
    cumulated_rate = F.try_divide(so_far("bads"), so_far("base"))
    return per_decile.select(
        F.col("decile").cast("int").alias("decile"),
        F.try_divide(so_far("trx"), so_far("users")).alias("cum_avg_trx"),
        "no_subs",
        so_far("no_subs").alias("cum_no_subs"),
        "lower_treshold",
        F.round(F.try_divide("users", "base"), 5).alias("use_prop"),
        so_far("users").alias("cum_no_use"),
        F.try_divide(so_far("users"), so_far("base")).alias("cum_use_prop"),
        F.round(F.try_divide("bads", "base"), 5).alias("bad_prop"),
        cumulated_rate.alias("cum_bad_prop"),
        F.try_divide(month_rate, cumulated_rate).alias("lift_rate"),
        "prof_date",
    ).select(*LIFT_SCHEMA.fieldNames())
