"""Profit and loss of offering the loan down to each decile."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --------------------------------------------------------------------------
# Range and default of the scenario inputs, report rounding.
# --------------------------------------------------------------------------

TAKEUP_PERCENT = list(range(0, 101, 5))
DEFAULT_TAKEUP = 20
DEFAULT_FEE = 2
DEFAULT_LOAN = 20

# Report column -> (factor, digits). Columns not listed are shown as they are.
REPORT_ROUNDING = {
    "cum_use_prop": (100, 2),
    "cum_avg_trx": (1, 2),
    "bad_prop": (100, 2),
    "cum_bad_prop": (100, 2),
    "lift_rate": (1, 0),
    "take_adj": (100, 0),
    "cum_fee": (1, 0),
    "cum_loss": (-1, 0),
    "p_l": (1, 0),
}
REPORT_COLUMNS = ["decile", "cum_no_subs", *REPORT_ROUNDING]

SCENARIO = ["prof_date", "takeup", "fee", "loan"]


def with_scenarios(
    lift: DataFrame,
    takeup: Sequence[float] = TAKEUP_PERCENT,
    fee: Sequence[float] = (DEFAULT_FEE,),
    loan: Sequence[float] = (DEFAULT_LOAN,),
) -> DataFrame:
    """Repeat the lift rows for every combination of the scenario inputs."""

    def values(options: Sequence[float]) -> Column:
        return F.explode(F.array(*[F.lit(float(v)) for v in options]))

    return (
        lift.withColumn("takeup", values(takeup)).withColumn("fee", values(fee)).withColumn("loan", values(loan))
    )


def profit_loss(scenarios: DataFrame) -> DataFrame:
    """Fee income, loan loss and their difference, cumulated from decile 1.

    The take-up percentage applies to the decile range with the highest usage
    of the month; the others follow in proportion.
    """
    highest = F.max("cum_use_prop").over(Window.partitionBy(*SCENARIO))
    return (
        scenarios.withColumn("take_adj", F.try_divide("cum_use_prop", highest) * F.col("takeup") / 100)
        .withColumns(
            {
                "cum_fee": F.col("cum_no_subs")
                * F.col("take_adj")
                * F.col("cum_avg_trx")
                * F.col("fee")
                * (1 - F.col("cum_bad_prop")),
                "cum_loss": F.col("cum_no_subs") * F.col("cum_bad_prop") * F.col("take_adj") * F.col("loan"),
            }
        )
        .withColumn("p_l", F.col("cum_fee") - F.col("cum_loss"))
    )


def best_decile(profit: DataFrame) -> DataFrame:
    """The rows with the highest profit of each month and scenario, ties kept."""
    best = F.max("p_l").over(Window.partitionBy(*SCENARIO))
    return profit.withColumn("_best", best).filter(F.col("p_l") == F.col("_best")).drop("_best")


def _short(number: Column, digits: int) -> Column:
    """Rounded number as text, without a fraction of zero."""
    return F.regexp_replace(F.bround(number, digits).cast("string"), r"\.0$", "")


def profit_headline(best: DataFrame) -> DataFrame:
    """Best decile with its subscribers, risk and profit as display text."""
    return best.select(
        *SCENARIO,
        "decile",
        F.concat(_short(F.col("cum_no_subs") / 1_000_000, 2), F.lit(" M")).alias("subs"),
        F.concat(_short(F.col("cum_bad_prop") * 100, 2), F.lit("%")).alias("risky"),
        F.concat(_short(F.col("p_l") / 1_000_000, 0), F.lit(" M")).alias("profit"),
    )


def profit_report_table(profit: DataFrame) -> DataFrame:
    """All deciles, rates as percentages, losses negative; half-even rounding."""
    shown = {c: F.bround(F.col(c) * factor, digits) for c, (factor, digits) in REPORT_ROUNDING.items()}
    return profit.withColumns(shown).select(*SCENARIO, *REPORT_COLUMNS)


def profit_series(profit: DataFrame) -> DataFrame:
    """The three chart series in long form: lift, cumulated risk, profit."""
    return profit.select(
        *SCENARIO,
        "decile",
        F.col("lift_rate"),
        (F.col("cum_bad_prop") * 100).alias("risky_percent"),
        (F.col("p_l") / 1_000_000).alias("profit_millions"),
    ).unpivot([*SCENARIO, "decile"], ["lift_rate", "risky_percent", "profit_millions"], "series", "value")


def profile_months(lift: DataFrame) -> DataFrame:
    """Months that can be chosen, as text in ascending order."""
    return lift.select(F.col("prof_date").cast("string").alias("prof_month")).distinct().orderBy("prof_month")


@dataclass(frozen=True)
class ProfitReport:
    """The tables of a profit report, for every month and scenario."""

    headline: DataFrame
    table: DataFrame
    series: DataFrame
    months: DataFrame


def profit_report(
    lift: DataFrame,
    takeup: Sequence[float] = (DEFAULT_TAKEUP,),
    fee: Sequence[float] = (DEFAULT_FEE,),
    loan: Sequence[float] = (DEFAULT_LOAN,),
) -> ProfitReport:
    """Report on a lift table, by default for the usual scenario of all its months.

    Filter ``lift`` to a ``prof_date`` to see one month. A lift table has ten
    rows per month: write it first, so that the four tables do not each make it.
    """
    profit = profit_loss(with_scenarios(lift, takeup, fee, loan))
    return ProfitReport(
        headline=profit_headline(best_decile(profit)),
        table=profit_report_table(profit),
        series=profit_series(profit),
        months=profile_months(lift),
    )
