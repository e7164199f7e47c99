"""In which range of a scenario input each decile is the best one, exactly.

With the other inputs held, a decile's profit is a straight line in the take-up, the fee
or the loan. The best decile at each value is the upper envelope of a month's lines, so a
grid of values isn't needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subscore.operators.profit import DEFAULT_FEE, DEFAULT_LOAN, DEFAULT_TAKEUP

INPUTS = ("takeup", "fee", "loan")


def profit_lines(
    lift: DataFrame,
    varied: str,
    takeup: float = DEFAULT_TAKEUP,
    fee: float = DEFAULT_FEE,
    loan: float = DEFAULT_LOAN,
) -> DataFrame:
    """``prof_date``, ``decile``, and the ``slope`` and ``intercept`` of its profit in the input ``varied``."""
    if varied not in INPUTS:
        raise ValueError(f"{varied} is none of {', '.join(INPUTS)}")
    highest = F.max("cum_use_prop").over(Window.partitionBy("prof_date"))
    takers = F.col("cum_no_subs") * F.try_divide("cum_use_prop", highest) / 100
    income = takers * F.col("cum_avg_trx") * (1 - F.col("cum_bad_prop"))  # for a fee of one, at one per cent
    loss = takers * F.col("cum_bad_prop")
    slope, intercept = {
        "takeup": (income * fee - loss * loan, F.lit(0.0)),
        "fee": (income * takeup, -loss * (takeup * loan)),
        "loan": (-loss * takeup, income * (takeup * fee)),
    }[varied]
    return lift.select("prof_date", "decile", slope.alias("slope"), intercept.alias("intercept"))


def upper_envelope(lines: DataFrame, low: float, high: float, by: str = "prof_date", name: str = "decile") -> DataFrame:
    """Where each line is the highest of its group between ``low`` and ``high``: ``from_value`` to ``to_value``.

    Of lines that are the same, the one with the least ``name`` counts. A line that is highest at a
    single value only is left out, as is one without a slope or an intercept. The intervals of a
    group meet and cover all of ``low`` to ``high``. A group is one row of lines inside a window,
    for groups as small as the deciles of a month.
    """
    known = lines.filter(F.col("slope").isNotNull() & F.col("intercept").isNotNull())
    others = F.collect_list(F.struct("slope", "intercept", name)).over(Window.partitionBy(by))

    def crossing(other: Column) -> Column:
        return (other["intercept"] - F.col("intercept")) / (F.col("slope") - other["slope"])

    def ends(steeper: bool, pick, bound: float) -> Column:
        chosen = F.filter(
            F.col("_others"),
            lambda o: (o["slope"] > F.col("slope")) if steeper else (o["slope"] < F.col("slope")),
        )
        met = pick(F.transform(chosen, crossing))
        limit = F.lit(float(bound))
        return F.least(met, limit) if steeper else F.greatest(met, limit)

    covered = F.exists(
        F.col("_others"),
        lambda o: (o["slope"] == F.col("slope"))
        & ((o["intercept"] > F.col("intercept")) | ((o["intercept"] == F.col("intercept")) & (o[name] < F.col(name)))),
    )
    return (
        known.withColumn("_others", others)
        .filter(~covered)
        .withColumns({"from_value": ends(False, F.array_max, low), "to_value": ends(True, F.array_min, high)})
        .filter(F.col("from_value") < F.col("to_value"))
        .withColumns({f"profit_{e}": F.col("slope") * F.col(f"{e}_value") + F.col("intercept") for e in ("from", "to")})
        .drop("_others")
    )


def best_decile_intervals(
    lift: DataFrame,
    varied: str,
    low: float,
    high: float,
    takeup: float = DEFAULT_TAKEUP,
    fee: float = DEFAULT_FEE,
    loan: float = DEFAULT_LOAN,
) -> DataFrame:
    """Per month, the intervals of the input ``varied`` in which each decile is best, with the profit at their ends."""
    envelope = upper_envelope(profit_lines(lift, varied, takeup, fee, loan), low, high)
    return envelope.select(
        "prof_date", F.lit(varied).alias("varied"), "decile", "from_value", "to_value", "profit_from", "profit_to"
    )
