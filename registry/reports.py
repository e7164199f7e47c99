"""Queries of exact best-decile intervals, the curve's hull, delivered files and stage profiles, and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import oracle as o
from registry import queries as q
from registry import views as v
from subscore.operators import envelope, hull, stage_profile
from subscore.schemas import SCORES_SCHEMA, SUBSCRIPTION_KEY
from subscore.session import shared_folder
from subscore.sources import delivered, tables

RANGES = {"takeup": (0, 100), "fee": (0, 40), "loan": (0, 200)}
GRID = (0.13, 40.0, 0.25)  # fees between which no interval is likely to end
FAULTS = 10  # a subscriber's number modulo this tells what is wrong with the delivered line
QUANTILES = (0.25, 0.5, 0.75)


def _stored_lift(spark: SparkSession, folder: str) -> DataFrame:
    """The lift table, ten rows a month, written so that it isn't made once per input."""
    return tables.write_feature_set(q.decile_lift_table(spark, folder), f"{shared_folder(spark, 'lift')}/lift")


def best_decile_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """For each month and each input, the intervals in which each decile is best."""
    lift = _stored_lift(spark, folder)
    parts = [envelope.best_decile_intervals(lift, varied, low, high) for varied, (low, high) in RANGES.items()]
    return reduce(DataFrame.unionByName, parts)


def best_decile_on_grid(spark: SparkSession, folder: str) -> DataFrame:
    """The best decile at each fee of a fine grid, looked up in the intervals."""
    found = envelope.best_decile_intervals(_stored_lift(spark, folder), "fee", *RANGES["fee"])
    first, last, step = GRID
    fees = F.array(*[F.lit(first + step * k) for k in range(int((last - first) / step) + 1)])
    inside = F.filter(fees, lambda x: (x >= F.col("from_value")) & (x < F.col("to_value")))
    slope = F.try_divide(F.col("profit_to") - F.col("profit_from"), F.col("to_value") - F.col("from_value"))
    return found.withColumn("fee", F.explode(inside)).select(
        "prof_date", "fee", "decile", (F.col("profit_from") + slope * (F.col("fee") - F.col("from_value"))).alias("p_l")
    )


def roc_hull(spark: SparkSession, folder: str) -> DataFrame:
    return hull.roc_hull(q._labelled(spark, folder), "risk", "bad")


def delivered_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores as delivered text with faulty lines: those read, and those in quarantine with their fault."""
    target = shared_folder(spark, "delivered")
    scores = q._scores(spark, folder)
    text = [F.col(c).cast("string").alias(c) for c in scores.columns]
    kind = F.col("analytic_id").cast("bigint") % FAULTS
    fields = {c: F.col(c) for c in scores.columns}
    line = (
        F.when(kind == 1, F.concat_ws(",", *[fields[c] for c in scores.columns[:-1]], F.lit("n/a")))
        .when(kind == 2, F.concat_ws(",", *fields.values(), F.lit("more")))
        .when(kind == 3, F.concat_ws(",", fields["crm_sub_id"], F.lit(""), *[fields[c] for c in scores.columns[2:]]))
        .when(kind == 4, F.concat_ws(",", fields["crm_sub_id"], fields["analytic_id"]))
        .otherwise(F.concat_ws(",", *fields.values()))
    )
    # The header is the name of the single column, written without quoting.
    header = ",".join(scores.columns)
    lines = scores.select(*text).select(line.alias(header))
    lines.write.option("header", True).option("sep", "\t").option("quote", "\0").csv(f"{target}/text")
    read = delivered.read_delivered(
        spark, f"{target}/text", SCORES_SCHEMA, f"{target}/rows", required=["crm_sub_id", *SUBSCRIPTION_KEY]
    )
    bad = read.quarantine.select(F.split("record", ",")[0].alias("crm_sub_id"), "fault")
    return read.good.unionByName(bad, allowMissingColumns=True)


def stage_profile_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """Profile of three months of profiles from stored sketches, and whether its estimates keep their bounds."""
    target = f"{shared_folder(spark, 'profiles')}/states"
    rows = v.profile(spark, folder, v.SCORING_MONTH)
    for _ in range(2):  # the second run replaces the first
        stage_profile.store_states(stage_profile.profile_states(rows, "profile", "ddate"), target)
    merged = stage_profile.merged_profile(spark.read.parquet(target), ["stage"], QUANTILES)
    columns = stage_profile.numeric_columns(rows)
    values = rows.select(*[F.col(c).cast("double") for c in columns]).unpivot([], columns, "column_name", "value")
    # The merged profile has a row per column of the table.
    compared = values.filter("value IS NOT NULL").join(
        F.broadcast(merged.select("column_name", "quantiles", F.col("n_distinct").alias("estimate"))), "column_name"
    )
    ranks = [
        f(F.col("value"), F.col("quantiles")[k]).alias(f"{name}_{k}")
        for k in range(len(QUANTILES))
        for name, f in (("below", lambda a, b: a < b), ("upto", lambda a, b: a <= b))
    ]
    exact = (
        compared.select("column_name", "value", "estimate", *ranks)
        .groupBy("column_name", "value")
        .agg(
            F.max("estimate").alias("estimate"),
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(f"{name}_{k}").alias(f"{name}_{k}") for k in range(len(QUANTILES)) for name in ("below", "upto")],
        )
        .groupBy("column_name")
        .agg(
            F.count(F.lit(1)).alias("n_distinct"),
            F.max("estimate").alias("estimate"),
            F.sum("n").alias("n"),
            *[F.sum(f"{name}_{k}").alias(f"{name}_{k}") for k in range(len(QUANTILES)) for name in ("below", "upto")],
        )
    )
    slack = stage_profile.RANK_ERROR * F.col("n")
    within = [
        (F.col(f"below_{k}") <= wanted * F.col("n") + slack) & (F.col(f"upto_{k}") >= wanted * F.col("n") - slack)
        for k, wanted in enumerate(QUANTILES)
    ]
    near = F.abs(F.col("estimate") - F.col("n_distinct")) <= F.greatest(
        F.lit(1.0), stage_profile.DISTINCT_ERROR * F.col("n_distinct")
    )
    checked = exact.select(
        "column_name",
        "n_distinct",
        near.cast("int").alias("distinct_in_bounds"),
        reduce(lambda a, b: a & b, within).cast("int").alias("quantiles_in_bounds"),
    )
    return merged.select("column_name", "n_rows", "n_null", "least", "largest").join(checked, "column_name")


def all_queries() -> dict:
    found = (best_decile_intervals, best_decile_on_grid, roc_hull, delivered_scores, stage_profile_bounds)
    return {f.__name__: f for f in found}


# --- SQL ---------------------------------------------------------------------

_LINES = {
    "unit": """
    SELECT prof_date, decile,
           cum_no_subs * (cum_use_prop / max(cum_use_prop) OVER (PARTITION BY prof_date)) / 100 * cum_avg_trx
             * (1 - cum_bad_prop) AS income,
           cum_no_subs * (cum_use_prop / max(cum_use_prop) OVER (PARTITION BY prof_date)) / 100 * cum_bad_prop AS loss
    FROM lift""",
    "line": """
    SELECT * FROM (
      SELECT prof_date, decile, 'takeup' AS varied, 100.0::DOUBLE AS high, income * 2 - loss * 20 AS slope, 0.0::DOUBLE AS intercept FROM unit
      UNION ALL SELECT prof_date, decile, 'fee', 40.0, income * 20, -loss * 400 FROM unit
      UNION ALL SELECT prof_date, decile, 'loan', 200.0, -loss * 20, income * 40 FROM unit)
    WHERE slope IS NOT NULL AND intercept IS NOT NULL""",
}
_INTERVALS = """
    SELECT a.prof_date, a.varied, a.decile, a.slope, a.intercept,
           greatest(max(CASE WHEN b.slope < a.slope THEN (b.intercept - a.intercept) / (a.slope - b.slope) END), 0.0::DOUBLE) AS from_value,
           least(min(CASE WHEN b.slope > a.slope THEN (b.intercept - a.intercept) / (a.slope - b.slope) END), any_value(a.high)) AS to_value
    FROM line a JOIN line b ON a.prof_date = b.prof_date AND a.varied = b.varied
    GROUP BY a.prof_date, a.varied, a.decile, a.slope, a.intercept
    HAVING NOT bool_or(b.slope = a.slope AND (b.intercept > a.intercept OR b.intercept = a.intercept AND b.decile < a.decile))"""

_HULL = {
    "per_threshold": """
    SELECT risk AS threshold, count(*) FILTER (WHERE bad = 1) AS e, count(*) FILTER (WHERE bad = 0) AS n
    FROM scored WHERE bad IS NOT NULL GROUP BY risk""",
    "point": """
    SELECT threshold, CAST(sum(e) OVER w AS BIGINT) AS y, CAST(sum(n) OVER w AS BIGINT) AS x
    FROM per_threshold WINDOW w AS (ORDER BY threshold DESC) UNION ALL SELECT NULL, 0, 0""",
    # A point of the hull: every line to it from the left is steeper than every line from it to the right.
    "steep": """
    SELECT p.threshold, p.x, p.y,
           min(CASE WHEN (a.x, a.y) < (p.x, p.y) THEN CASE WHEN a.x = p.x THEN 1e300 ELSE (p.y - a.y) / CAST(p.x - a.x AS DOUBLE) END END) AS l,
           max(CASE WHEN (a.x, a.y) > (p.x, p.y) THEN CASE WHEN a.x = p.x THEN 1e300 ELSE (a.y - p.y) / CAST(a.x - p.x AS DOUBLE) END END) AS r
    FROM point p, point a GROUP BY p.threshold, p.x, p.y""",
}


def _scored(columns: list[str]) -> str:
    return o._select(columns, "(SELECT *, CAST(analytic_id AS BIGINT) % 10 AS fault_kind FROM scored)")


def _profile_summary() -> str:
    parts = [
        f"""
    SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null,
           round(CAST(min({c}) AS DOUBLE), 4) + 0.0 AS least, round(CAST(max({c}) AS DOUBLE), 4) + 0.0 AS largest,
           count(DISTINCT {c}) AS n_distinct, 1 AS distinct_in_bounds, 1 AS quantiles_in_bounds
    FROM profile"""
        for c in ("credit_limit", "days_active", "service_month", "handset_launchprice", *o.REVENUE)
    ]
    return " UNION ALL ".join(parts)


def all_statements() -> dict[str, str]:
    lift = o._scored_steps(o.SCORING[:2]) | o._LIFT_STEPS
    fees = f"(SELECT {GRID[0]}::DOUBLE + {GRID[2]}::DOUBLE * range AS fee FROM range(0, {int((GRID[1] - GRID[0]) / GRID[2]) + 1}))"
    return {
        "best_decile_intervals": o._statement(
            lift | _LINES | {"found": _INTERVALS},
            o._select(
                [
                    "prof_date",
                    "varied",
                    "decile",
                    o._r("from_value"),
                    o._r("to_value"),
                    o._r("slope * from_value + intercept", "profit_from"),
                    o._r("slope * to_value + intercept", "profit_to"),
                ],
                "found WHERE from_value < to_value",
            ),
        ),
        "best_decile_on_grid": o._statement(
            lift | _LINES,
            f"""
    SELECT prof_date, {o._r("fee")}, decile, {o._r("slope * fee + intercept", "p_l")}
    FROM line, {fees} WHERE varied = 'fee'
    QUALIFY row_number() OVER (PARTITION BY prof_date, fee ORDER BY slope * fee + intercept DESC, decile) = 1""",
        ),
        "roc_hull": o._statement(
            o._scored_steps(o.SCORING[:1]) | _HULL,
            f"""
    SELECT {o._r("threshold")}, y AS true_positives, x AS false_positives,
           {o._r("y / CAST(max(y) OVER () AS DOUBLE)", "true_positive_rate")},
           {o._r("x / CAST(max(x) OVER () AS DOUBLE)", "false_positive_rate")}
    FROM steep WHERE l IS NULL OR r IS NULL OR l > r""",
        ),
        "delivered_scores": o._statement(
            o._scored_steps(o.SCORING[:1]),
            _scored(
                [
                    "crm_sub_id",
                    "CASE WHEN fault_kind NOT IN (1, 2, 3, 4) THEN analytic_id END AS analytic_id",
                    "CASE WHEN fault_kind NOT IN (1, 2, 3, 4) THEN register_date END AS register_date",
                    "CASE WHEN fault_kind NOT IN (1, 2, 3, 4) THEN round(score, 4) + 0.0 END AS p0",
                    "CASE WHEN fault_kind IN (1, 2, 4) THEN 'malformed' WHEN fault_kind = 3 THEN 'missing analytic_id' END AS fault",
                ]
            ),
        ),
        "stage_profile_bounds": o._statement(o._profile_tables(o.SCORING), _profile_summary()),
    }
