"""The registered queries in plain SQL, over the same tables.

Written from the definitions and not from the Spark plans: windows are global,
lags are joins, and every step is a common table expression of its own.
"""

from __future__ import annotations

from subscore.schemas import (
    AVG_COLUMNS,
    CATEGORICAL,
    MEAN_IMPUTED,
    MEASURES,
    REVENUE,
    SD_COLUMNS,
    SLOPE_COLUMNS,
    TOPUP,
    USAGE,
    USAGE_HISTORY,
    feature_columns,
    lag_name,
    zero_imputed,
)

DIGITS = 4
SERIES_DIGITS = 9

LABEL_MONTH = "1998-06-30"
TRAINING = ["1998-03-31", "1998-02-28", "1998-01-31"]
SCORING = ["1998-06-30", "1998-05-31", "1998-04-30"]

WHOLE = {"sum_monthly_tran_topup", "min_monthly_topup_tran", "max_monthly_topup_tran"} | {
    c for c in USAGE if c.endswith("_cnt")
}


def _r(column: str, name: str | None = None, digits: int = DIGITS) -> str:
    return f"round({column}, {digits}) + 0.0 AS {name or column}"


def _usage(columns: list[str]) -> list[str]:
    """Measures as they leave the datamart: counts whole, the rest rounded."""
    return [c if _base(c) in WHOLE else _r(c) for c in columns]


def _base(column: str) -> str:
    return column[:-3] if column.endswith(("_p1", "_p2")) and column[:-3] in MEASURES else column


def _select(columns: list[str], source: str) -> str:
    return "SELECT " + ", ".join(columns) + f" FROM {source}"


def _dates(months: list[str]) -> str:
    return ", ".join(f"(DATE '{m}')" for m in months)


def _registered(key: str) -> str:
    return f"(DATE '1990-01-01' + CAST(({key} * 7919) % 3000 AS INTEGER))"


TIE = "md5(analytic_id || '|' || CAST(register_date AS VARCHAR)), analytic_id || '|' || CAST(register_date AS VARCHAR)"


def _hash(salt: str) -> str:
    text = f"analytic_id || '|' || CAST(register_date AS VARCHAR) || '|' || '{salt}'"
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


# --------------------------------------------------------------------------
# Tables of the subscriber model.
# --------------------------------------------------------------------------


def _customers(months: list[str]) -> str:
    return f"""
    SELECT c.*, CAST(c_custkey AS VARCHAR) AS analytic_id, {_registered("c_custkey")} AS register_date, m.ddate
    FROM customer c JOIN (VALUES {_dates(months)}) AS m(ddate) ON TRUE"""


TOPUP_DAILY = f"""
    SELECT CAST(o_custkey AS VARCHAR) AS analytic_id,
           {_registered("o_custkey")} + CASE WHEN o_orderpriority = '1-URGENT' THEN 365 ELSE 0 END AS register_date,
           CAST(o_orderdate AS DATE) AS ddate,
           1 + o_orderkey % 3 AS top_up_tran,
           o_totalprice AS top_up_value
    FROM orders"""

USAGE_DAILY = """
    SELECT CAST(o_custkey AS VARCHAR) AS analytic_id, CAST(l_shipdate AS DATE) AS ddate,
           l_extendedprice AS data_vol_kb, l_quantity AS voice_out_minute, l_linenumber AS voice_out_cnt,
           l_quantity * l_discount AS voice_in_minute, l_linenumber % 3 AS voice_in_cnt, l_linenumber % 2 AS sms_in_cnt
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def _in_months(months: list[str]) -> str:
    return "last_day(ddate) IN (" + ", ".join(f"DATE '{m}'" for m in months) + ")"


def _topup_month(months: list[str]) -> str:
    return f"""
    SELECT analytic_id, register_date, last_day(ddate) AS ddate,
           CAST(sum(top_up_tran) AS BIGINT) AS sum_monthly_tran_topup,
           avg(top_up_tran) AS mean_monthly_topup_tran, stddev_samp(top_up_tran) AS sd_monthly_topup_tran,
           min(top_up_tran) AS min_monthly_topup_tran, max(top_up_tran) AS max_monthly_topup_tran,
           sum(top_up_value) AS sum_monthly_topup_value,
           avg(top_up_value) AS mean_monthly_topup_value, stddev_samp(top_up_value) AS sd_monthly_topup_value,
           min(top_up_value) AS min_monthly_topup_value, max(top_up_value) AS max_monthly_topup_value
    FROM topup_daily WHERE {_in_months(months)} GROUP BY ALL"""


def _usage_month(months: list[str]) -> str:
    return f"""
    SELECT analytic_id, last_day(ddate) AS ddate,
           sum(data_vol_kb) AS sum_monthly_data_kb, sum(voice_out_minute) AS sum_monthly_voice_out_minute,
           CAST(sum(voice_out_cnt) AS BIGINT) AS sum_monthly_voice_out_cnt,
           sum(voice_in_minute) AS sum_monthly_voice_in_minute,
           CAST(sum(voice_in_cnt) AS BIGINT) AS sum_monthly_voice_in_cnt,
           CAST(sum(sms_in_cnt) AS BIGINT) AS sum_monthly_sms_in_cnt
    FROM usage_daily WHERE {_in_months(months)} GROUP BY ALL"""


USAGE_MONTHLY = "SELECT * FROM topup_month FULL JOIN usage_month USING (analytic_id, ddate)"


def _profile(months: list[str]) -> str:
    return f"""
    SELECT analytic_id, CAST(register_date AS TIMESTAMP) AS activation_date, ddate,
           'N' || analytic_id AS national_id, 'C' || analytic_id AS crm_sub_id,
           CASE WHEN c_custkey % 97 = 0 THEN 'n/a'
                WHEN c_custkey % 11 <> 0 THEN CAST(c_custkey % 60 + 15 AS VARCHAR) END AS age,
           CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 50 * 100 AS DOUBLE) END AS credit_limit,
           c_custkey % 31 AS days_active,
           (year(ddate) - year(register_date)) * 12 + month(ddate) - month(register_date) AS service_month,
           CASE WHEN c_nationkey = 0 THEN 'Y' ELSE 'N' END AS foreigner_flag,
           CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender,
           CASE WHEN c_custkey % 10 = 0 THEN 'Post-paid' ELSE 'Pre-paid' END AS charge_type,
           CASE WHEN c_custkey % 13 = 0 THEN 'SP' ELSE 'SA' END AS mobile_status,
           CASE WHEN c_custkey % 4 = 1 THEN 'Y' WHEN c_custkey % 4 > 1 THEN 'N' END AS mnp_flag,
           CASE WHEN c_nationkey = 1 THEN 'Prospect Platinum' WHEN c_nationkey = 2 THEN 'Prospect Emerald'
                WHEN c_nationkey = 3 THEN 'NA' WHEN c_nationkey = 4 THEN 'Prospect Plat Plus'
                WHEN c_mktsegment = 'MACHINERY' THEN 'Prospect Gold' WHEN c_mktsegment = 'BUILDING' THEN 'Platinum Plus'
                WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Standard' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Gold'
                END AS master_segment_id,
           CASE WHEN c_custkey % 9 <> 0 THEN c_custkey % 200 * CAST(50 AS DOUBLE) END AS handset_launchprice,
           CASE c_custkey % 6 WHEN 0 THEN 'Android' WHEN 1 THEN 'iOS' WHEN 2 THEN 'Proprietary' WHEN 3 THEN 'Unknown'
                WHEN 5 THEN 'Symbian' END AS handset_os,
           abs(c_acctbal) * month(ddate) / CAST(20 AS DOUBLE) AS norms_net_revenue_avg_3mth_p0_p2,
           abs(c_acctbal) * (month(ddate) % 4 + 1) / CAST(50 AS DOUBLE) AS norms_net_revenue_gprs,
           CASE WHEN c_custkey % 8 <> 0 THEN abs(c_acctbal) / CAST(10 AS DOUBLE) END AS norms_net_revenue_vas,
           CASE WHEN c_custkey % 5 = 0 AND month(ddate) IN (1, 2, 4, 5) THEN CAST(0 AS DOUBLE)
                ELSE abs(c_acctbal) * (c_custkey % 3) / CAST(4 AS DOUBLE) END AS norms_net_revenue_voice
    FROM customers WHERE register_date <= ddate"""


MONTHLY_ORDERS = """
    SELECT o_custkey, last_day(CAST(o_orderdate AS DATE)) AS order_month, o_orderpriority FROM orders"""
ORDER_COUNTS = "SELECT o_custkey, order_month, count(*) AS n FROM monthly_orders GROUP BY ALL"
COUNTED = """
    SELECT c.*, coalesce(n, 0) AS n_orders
    FROM customers c LEFT JOIN order_counts ON c_custkey = o_custkey AND ddate = order_month"""

LOANS = """
    SELECT CASE WHEN c_acctbal <= 9900 THEN analytic_id END AS analytic_id, register_date, ddate,
           CASE WHEN c_nationkey <> 24 THEN c_acctbal END AS remain_balance_p1, n_orders AS recharge_count
    FROM (SELECT * FROM counted
          UNION ALL
          SELECT c.* FROM counted c JOIN monthly_orders ON c_custkey = o_custkey AND ddate = order_month
          WHERE o_orderpriority = '1-URGENT')"""

SURVEY = """
    SELECT analytic_id, register_date, ddate AS month_id, 'SA' AS mobile_status, c_custkey % 5 AS survey_topup_cnt
    FROM customers"""
VALIDITY = """
    SELECT analytic_id, register_date, ddate, strftime(ddate, '%Y%m%d') AS date_id,
           'C' || analytic_id AS crm_subscription_id,
           CASE WHEN c_custkey % 12 <> 0 THEN CAST(c_custkey % 10 AS DOUBLE) END AS vald_res_10
    FROM customers"""

SCORED = """
    SELECT 'C' || analytic_id AS crm_sub_id, analytic_id, register_date, ddate AS prof_date,
           step / 200.0::DOUBLE AS score, (200 - step) / 200.0::DOUBLE AS risk,
           CASE WHEN c_acctbal <= 9900 THEN
                CASE WHEN c_acctbal < 0 OR (c_nationkey < 5 AND c_acctbal < 5000) THEN 1 ELSE 0 END END AS bad,
           CASE WHEN n_orders > 0 THEN 1 ELSE 0 END AS used, n_orders AS trx
    FROM (SELECT *, floor((c_acctbal + 1000) / CASE WHEN ddate = DATE '1998-06-30' THEN 60 ELSE 55 END) AS step
          FROM counted)"""

# --------------------------------------------------------------------------
# Steps of the feature table, for the month of the run.
# --------------------------------------------------------------------------


def _snapshot(month: str) -> dict[str, str]:
    history = f"ddate < DATE '{month}'"
    return {
        "profile_now": f"""
    SELECT analytic_id, national_id, crm_sub_id, CAST(activation_date AS DATE) AS register_date, ddate AS prof_month, age,
           credit_limit, days_active, service_month, foreigner_flag, gender, charge_type, mobile_status, mnp_flag,
           master_segment_id, handset_launchprice, handset_os, {", ".join(REVENUE)}
    FROM profile WHERE ddate = DATE '{month}' AND charge_type = 'Pre-paid' AND mobile_status = 'SA'""",
        "usage_now": f"SELECT * EXCLUDE (ddate) FROM usage_monthly WHERE ddate = DATE '{month}'",
        "survey_now": f"SELECT * EXCLUDE (month_id, mobile_status) FROM survey WHERE month_id = DATE '{month}'",
        "validity_now": f"SELECT analytic_id, register_date, vald_res_10 FROM validity WHERE ddate = DATE '{month}'",
        "profile_past": f"""
    SELECT analytic_id, CAST(activation_date AS DATE) AS register_date, ddate, {", ".join(REVENUE)} FROM profile WHERE {history}""",
        "usage_past": f"""
    SELECT analytic_id, register_date, ddate, {", ".join(USAGE_HISTORY)} FROM usage_monthly WHERE {history}""",
        "past": "SELECT * FROM profile_past FULL JOIN usage_past USING (analytic_id, register_date, ddate)",
    }


LABELLED = f"""
    SELECT *, CASE WHEN remain_balance_p1 < 0 AND recharge_count = 0 THEN 1
                   WHEN NOT (remain_balance_p1 < 0 AND recharge_count = 0) THEN 0 END AS bad_flag,
           DATE '1998-03-31' AS prof_month
    FROM loans WHERE ddate = DATE '{LABEL_MONTH}'"""
SINGLE_LABELS = """
    SELECT l.* FROM labelled l
    LEFT JOIN (SELECT analytic_id FROM labelled GROUP BY analytic_id HAVING count(*) > 1) d
           ON l.analytic_id = d.analytic_id
    WHERE d.analytic_id IS NULL"""

TRAINING_SPINE = """
    SELECT l.analytic_id, l.register_date, l.bad_flag, l.prof_month,
           p.* EXCLUDE (analytic_id, register_date, prof_month)
    FROM single_labels l LEFT JOIN profile_now p USING (analytic_id, register_date, prof_month)"""
SCORING_SPINE = "SELECT * FROM profile_now"
ASSEMBLED = """
    SELECT * FROM spine LEFT JOIN usage_now USING (analytic_id, register_date)
    LEFT JOIN survey_now USING (analytic_id, register_date)
    LEFT JOIN validity_now USING (analytic_id, register_date)"""


def _lagged(source: str, measures: list[str] = MEASURES) -> str:
    one = ", ".join(f"h1.{m} AS {lag_name(m, 1)}" for m in measures)
    two = ", ".join(f"h2.{m} AS {lag_name(m, 2)}" for m in measures)
    return f"""
    SELECT b.*, {one}, {two} FROM {source} b
    LEFT JOIN past h1 ON b.analytic_id = h1.analytic_id AND b.register_date = h1.register_date
         AND h1.ddate = last_day(b.prof_month - INTERVAL 1 MONTH)
    LEFT JOIN past h2 ON b.analytic_id = h2.analytic_id AND b.register_date = h2.register_date
         AND h2.ddate = last_day(b.prof_month - INTERVAL 2 MONTH)"""


def _eligible(source: str) -> str:
    return f"""
    SELECT * REPLACE (TRY_CAST(age AS DOUBLE) AS age) FROM {source}
    WHERE mobile_status = 'SA' AND analytic_id IS NOT NULL AND service_month >= 4
      AND norms_net_revenue_avg_3mth_p0_p2 >= 40"""


def _mean(column: str) -> str:
    return f"coalesce({column}, (SELECT avg({column}) FROM eligible)) AS {column}"


SERENADE = """CASE WHEN master_segment_id IS NULL OR master_segment_id IN ('NA', 'Prospect Emerald', 'Standard')
                    THEN 'Classic'
                    WHEN master_segment_id IN ('Platinum Plus', 'Prospect Plat Plus') THEN 'Platinum'
                    WHEN master_segment_id = 'Prospect Platinum' THEN 'Gold'
                    WHEN master_segment_id = 'Prospect Gold' THEN 'Emerald'
                    ELSE master_segment_id END AS serenade"""
HANDSET = """CASE WHEN handset_os IN ('Android', 'iOS', 'Proprietary', 'Unknown') THEN handset_os
                   ELSE 'others' END AS handset_os"""


def _clean(label: list[str]) -> str:
    zeros = [f"coalesce({c}, 0) AS {c}" for c in zero_imputed()]
    return _select(
        [
            "analytic_id",
            "crm_sub_id",
            *label,
            "national_id",
            "register_date",
            *[_mean(c) for c in MEAN_IMPUTED],
            "coalesce(mnp_flag, 'N') AS mnp_flag",
            "coalesce(gender, 'unknown') AS gender",
            HANDSET,
            *zeros,
            SERENADE,
        ],
        "eligible",
    )


def _three(measure: str) -> list[str]:
    return [measure, lag_name(measure, 1), lag_name(measure, 2)]


WITH_MEAN = "SELECT *, " + ", ".join(f"({' + '.join(_three(m))}) / 3 AS avg_{m}" for m in MEASURES) + " FROM clean"
WITH_SD = (
    "SELECT *, "
    + ", ".join(
        "sqrt((" + " + ".join(f"power({x} - avg_{m}, 2)" for x in _three(m)) + f") / 3) AS sd_{m}" for m in MEASURES
    )
    + " FROM with_mean"
)


def _with_slope(source: str) -> str:
    slopes = [
        f"{m} / NULLIF(({lag_name(m, 1)} + {lag_name(m, 2)}) / CAST(2 AS DOUBLE), 0) - 1 AS slope_{m}_p1"
        for m in MEASURES
    ]
    return f"SELECT *, {', '.join(slopes)} FROM {source}"


# Only whole-number columns and text stay as they are when features are shown.
_WHOLE_FEATURES = ["days_active", "service_month"]


def _feature_rows(training: bool, source: str) -> str:
    label = ["coalesce(bad_flag, 0) AS bad_flag"] if training else []
    return _select(
        [
            "analytic_id",
            "crm_sub_id",
            *label,
            "register_date",
            *[_r(c) for c in MEAN_IMPUTED],
            "mnp_flag",
            "gender",
            "handset_os",
            *_WHOLE_FEATURES,
            *[_r(c) for c in REVENUE],
            *_usage(TOPUP),
            *_usage(USAGE),
            _r("vald_res_10"),
            "serenade",
            *[_r(c) for c in AVG_COLUMNS],
            *[_r(c) for c in SD_COLUMNS],
            *[_r(f"coalesce({c}, 0)", c) for c in SLOPE_COLUMNS],
        ],
        source,
    )


def _category_ranks() -> dict[str, str]:
    """Index of each category: by descending frequency, then by name."""
    return {
        f"ranked_{c}": f"""
    SELECT {c}, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS INTEGER) AS {c}_index
    FROM finished GROUP BY {c}"""
        for c in CATEGORICAL
    }


def _encoded() -> str:
    terms = [f"{c}_index" if c in CATEGORICAL else c for c in feature_columns()]
    joins = " ".join(f"JOIN ranked_{c} USING ({c})" for c in CATEGORICAL)
    indices = [f"{c}_index" for c in CATEGORICAL]
    total = " + ".join(f"CAST({t} AS DOUBLE)" for t in terms)
    columns = ["analytic_id", "register_date", *indices, f"{len(terms)} AS n_features", _r(total, "feature_sum")]
    return _select(columns, f"finished {joins}")


# --------------------------------------------------------------------------
# Statements: the tables and steps a query needs, then its SELECT.
# --------------------------------------------------------------------------


def _statement(steps: dict[str, str], final: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in steps.items()) + "\n" + final


def _usage_tables(months: list[str]) -> dict[str, str]:
    return {
        "topup_daily": TOPUP_DAILY,
        "usage_daily": USAGE_DAILY,
        "topup_month": _topup_month(months),
        "usage_month": _usage_month(months),
        "usage_monthly": USAGE_MONTHLY,
    }


def _profile_tables(months: list[str]) -> dict[str, str]:
    return {"customers": _customers(months), "profile": _profile(months)}


def _loan_tables() -> dict[str, str]:
    return {
        "customers": _customers([LABEL_MONTH, "1998-05-31"]),
        "monthly_orders": MONTHLY_ORDERS,
        "order_counts": ORDER_COUNTS,
        "counted": COUNTED,
        "loans": LOANS,
        "labelled": LABELLED,
        "single_labels": SINGLE_LABELS,
    }


def _feature_steps(training: bool) -> dict[str, str]:
    months = TRAINING if training else SCORING
    steps: dict[str, str] = {}
    if training:
        steps |= {k if k != "customers" else "borrowers": q for k, q in _loan_tables().items()}
        steps["counted"] = steps["counted"].replace("customers c", "borrowers c")
    steps |= _usage_tables(months) | _profile_tables(months) | {"survey": SURVEY, "validity": VALIDITY}
    steps |= _snapshot(months[0])
    steps["spine"] = TRAINING_SPINE if training else SCORING_SPINE
    steps["assembled"] = ASSEMBLED
    steps["lagged"] = _lagged("assembled")
    steps["eligible"] = _eligible("lagged")
    steps["clean"] = _clean(["bad_flag"] if training else [])
    steps["with_mean"] = WITH_MEAN
    steps["with_sd"] = WITH_SD
    steps["with_slope"] = _with_slope("with_sd")
    return steps


def _scored_steps(months: list[str]) -> dict[str, str]:
    return {
        "customers": _customers(months),
        "monthly_orders": MONTHLY_ORDERS,
        "order_counts": ORDER_COUNTS,
        "counted": COUNTED,
        "scored": SCORED,
    }


def _ntile(order: str, buckets: int, by: str = "") -> str:
    return f"CAST(ntile({buckets}) OVER ({by} ORDER BY {order}, {TIE}) AS INTEGER)"


_PROFILE_ALL = [
    "analytic_id", "activation_date", "ddate", "national_id", "crm_sub_id", "age", "credit_limit", "days_active",
    "service_month", "foreigner_flag", "gender", "charge_type", "mobile_status", "mnp_flag", "master_segment_id",
    "handset_launchprice", "handset_os", *REVENUE,
]
_PROFILE_DOUBLES = {"credit_limit", "handset_launchprice", *REVENUE}


def _profile_cols(columns: list[str], more_doubles: tuple[str, ...] = ()) -> list[str]:
    return [_r(c) if c in _PROFILE_DOUBLES or c in more_doubles else c for c in columns]


_SNAPSHOT_COLS = [c if c != "activation_date" else "register_date" for c in _PROFILE_ALL]
_ASSEMBLED_COLS = [
    *_profile_cols(["prof_month" if c == "ddate" else c for c in _SNAPSHOT_COLS]),
    *_usage(TOPUP),
    *_usage(USAGE),
    "survey_topup_cnt",
    _r("vald_res_10"),
]
_LAGGED_MEASURES = [lag_name(m, k) for k in (1, 2) for m in MEASURES]
_SPARK_TYPES = dict.fromkeys(_PROFILE_ALL, "string") | {
    "activation_date": "timestamp",
    "ddate": "date",
    "days_active": "bigint",
    "service_month": "bigint",
} | dict.fromkeys(_PROFILE_DOUBLES, "double")


def _table_profile() -> str:
    rows = [
        f"SELECT {i} AS position, '{c}' AS column_name, '{_SPARK_TYPES[c]}' AS data_type, count(*) AS n_rows, "
        f"{len(_PROFILE_ALL)} AS n_columns, count(*) - count({c}) AS n_null FROM profile"
        for i, c in enumerate(_PROFILE_ALL, start=1)
    ]
    return " UNION ALL ".join(rows)


_CURVE = {
    "histogram": """
    SELECT risk AS score, count(*) FILTER (WHERE bad = 1) AS events, count(*) FILTER (WHERE bad = 0) AS nonevents
    FROM scored WHERE bad IS NOT NULL GROUP BY risk"""
}
_AUC = f"""
    SELECT CAST(sum(events) AS BIGINT) AS n_events, CAST(sum(nonevents) AS BIGINT) AS n_nonevents,
           {_r("(SELECT sum(CASE WHEN p.risk > n.risk THEN 1.0 WHEN p.risk = n.risk THEN 0.5 ELSE 0.0 END)"
               " FROM scored p JOIN scored n ON p.bad = 1 AND n.bad = 0)"
               " / (sum(events) * CAST(sum(nonevents) AS DOUBLE))", "auc")}
    FROM histogram"""
_ROC = f"""
    SELECT {_r("score", "threshold")},
           CAST(sum(events) OVER w AS BIGINT) AS true_positives, CAST(sum(nonevents) OVER w AS BIGINT) AS false_positives,
           {_r("sum(events) OVER w / CAST(sum(events) OVER () AS DOUBLE)", "true_positive_rate")},
           {_r("sum(nonevents) OVER w / CAST(sum(nonevents) OVER () AS DOUBLE)", "false_positive_rate")}
    FROM histogram WINDOW w AS (ORDER BY score DESC)"""

_GAINS_STEPS = {
    "grouped": f'SELECT *, {_ntile("-risk", 16)} AS g FROM scored WHERE bad IS NOT NULL',
    "per_group": """
    SELECT g, CAST(count(*) AS DOUBLE) AS n, CAST(sum(bad) AS DOUBLE) AS e, min(risk) AS lower_threshold
    FROM grouped GROUP BY g""",
    "cumulated": """
    SELECT *, sum(n) OVER w AS cn, sum(e) OVER w AS ce, sum(n) OVER () AS tn, sum(e) OVER () AS te
    FROM per_group WINDOW w AS (ORDER BY g)""",
}
_GAINS = f"""
    SELECT g AS "group", {_r("cn / tn", "cumulative_data_fraction")}, {_r("lower_threshold")},
           {_r("(e / n) / (te / tn)", "lift")}, {_r("(ce / cn) / (te / tn)", "cumulative_lift")},
           {_r("e / n", "response_rate")}, {_r("ce / cn", "cumulative_response_rate")},
           {_r("e / te", "capture_rate")}, {_r("ce / te", "cumulative_capture_rate")},
           {_r("100 * ((e / n) / (te / tn) - 1)", "gain")},
           {_r("100 * ((ce / cn) / (te / tn) - 1)", "cumulative_gain")},
           {_r("ce / te - (cn - ce) / (tn - te)", "kolmogorov_smirnov")}
    FROM cumulated"""

_LIFT_STEPS = {
    "deciled": f'SELECT *, {_ntile("-score", 10, "PARTITION BY prof_date")} AS decile FROM scored',
    "per_decile": """
    SELECT prof_date, decile, count(*) AS no_subs, min(score) AS lower_treshold, count(bad) AS base,
           count(*) FILTER (WHERE bad IS NOT NULL AND used = 1) AS users, count(*) FILTER (WHERE bad = 1) AS bads,
           coalesce(sum(trx) FILTER (WHERE bad IS NOT NULL), 0) AS trx
    FROM deciled GROUP BY prof_date, decile""",
    "lift": """
    SELECT prof_date, decile, no_subs, lower_treshold,
           CAST(sum(no_subs) OVER w AS BIGINT) AS cum_no_subs, CAST(sum(users) OVER w AS BIGINT) AS cum_no_use,
           sum(trx) OVER w / CAST(NULLIF(sum(users) OVER w, 0) AS DOUBLE) AS cum_avg_trx,
           round(users / CAST(NULLIF(base, 0) AS DOUBLE), 5) AS use_prop,
           round(bads / CAST(NULLIF(base, 0) AS DOUBLE), 5) AS bad_prop,
           sum(users) OVER w / CAST(NULLIF(sum(base) OVER w, 0) AS DOUBLE) AS cum_use_prop,
           sum(bads) OVER w / CAST(NULLIF(sum(base) OVER w, 0) AS DOUBLE) AS cum_bad_prop,
           round(sum(bads) OVER m / CAST(sum(base) OVER m AS DOUBLE), 5)
             / NULLIF(sum(bads) OVER w / CAST(NULLIF(sum(base) OVER w, 0) AS DOUBLE), 0) AS lift_rate
    FROM per_decile
    WINDOW m AS (PARTITION BY prof_date), w AS (PARTITION BY prof_date ORDER BY decile)""",
}
_LIFT_COLS = [
    "decile",
    _r("cum_avg_trx"),
    "no_subs",
    "cum_no_subs",
    _r("lower_treshold"),
    _r("use_prop"),
    "cum_no_use",
    _r("cum_use_prop"),
    _r("bad_prop"),
    _r("cum_bad_prop"),
    _r("lift_rate"),
    "prof_date",
]
_PROFIT_STEPS = {
    "chosen": """
    SELECT *, CAST(2 AS DOUBLE) AS fee, CAST(20 AS DOUBLE) AS loan
    FROM lift JOIN (SELECT CAST(range AS DOUBLE) AS takeup FROM range(0, 101, 5)) ON TRUE""",
    "adjusted": """
    SELECT *, cum_use_prop / max(cum_use_prop) OVER (PARTITION BY prof_date, takeup, fee, loan) * takeup / 100
              AS take_adj FROM chosen""",
    "profit": """
    SELECT *, cum_no_subs * take_adj * cum_avg_trx * fee * (1 - cum_bad_prop) AS cum_fee,
           cum_no_subs * cum_bad_prop * take_adj * loan AS cum_loss,
           cum_no_subs * take_adj * cum_avg_trx * fee * (1 - cum_bad_prop)
             - cum_no_subs * cum_bad_prop * take_adj * loan AS p_l
    FROM adjusted""",
    "best": "SELECT * FROM profit QUALIFY p_l = max(p_l) OVER (PARTITION BY prof_date, takeup, fee, loan)",
}
_SCENARIO = ["prof_date", "takeup", "fee", "loan"]
_PROFIT_COLS = [*_LIFT_COLS, "takeup", "fee", "loan", *[_r(c) for c in ("take_adj", "cum_fee", "cum_loss", "p_l")]]


def _even(expression: str, digits: int) -> str:
    """Half-even rounding, decided on twelve decimal digits instead of on the binary value."""
    return f"CAST(round_even(CAST({expression} AS DECIMAL(30, 12)), {digits}) AS DOUBLE)"


def _short(expression: str, digits: int) -> str:
    return f"regexp_replace(CAST({_even(expression, digits)} AS VARCHAR), '\\.0$', '')"


_HEADLINE = _select(
    [
        *_SCENARIO,
        "decile",
        f"{_short('cum_no_subs / 1e6', 2)} || ' M' AS subs",
        f"{_short('cum_bad_prop * 100', 2)} || '%' AS risky",
        f"{_short('p_l / 1e6', 0)} || ' M' AS profit",
    ],
    "best",
)
_REPORT = _select(
    [
        *_SCENARIO,
        "decile",
        "cum_no_subs",
        f"{_even('cum_use_prop * 100', 2)} AS cum_use_prop",
        f"{_even('cum_avg_trx', 2)} AS cum_avg_trx",
        f"{_even('bad_prop * 100', 2)} AS bad_prop",
        f"{_even('cum_bad_prop * 100', 2)} AS cum_bad_prop",
        f"{_even('lift_rate', 0)} AS lift_rate",
        f"{_even('take_adj * 100', 0)} AS take_adj",
        f"{_even('cum_fee', 0)} AS cum_fee",
        f"{_even('-cum_loss', 0)} + 0.0 AS cum_loss",
        f"{_even('p_l', 0)} AS p_l",
    ],
    "profit",
)
_SERIES = " UNION ALL ".join(
    _select([*_SCENARIO, "decile", f"'{name}' AS series", _r(value, "value", SERIES_DIGITS)], "profit")
    for name, value in (
        ("lift_rate", "lift_rate"),
        ("risky_percent", "cum_bad_prop * 100"),
        ("profit_millions", "p_l / 1e6"),
    )
)


def _campaign(month: str) -> str:
    return _select(
        [
            "crm_sub_id",
            "analytic_id",
            "register_date",
            _r("score", "ea_score"),
            f"11 - {_ntile('score', 10)} AS ea_decile",
            f"101 - {_ntile('score', 100)} AS ea_percentile",
            "'Pre-paid' AS charge_type",
            f"DATE '{month}' AS prof_date",
        ],
        "scored",
    )


def _held_out() -> str:
    """Sixteen groups of the held-out rows: sizes by ntile, whatever the order."""
    return f"""
    SELECT g AS "group", {_r("sum(count(*)) OVER (ORDER BY g) / CAST(sum(count(*)) OVER () AS DOUBLE)", "cumulative_data_fraction")},
           {_r("sum(sum(bad_flag)) OVER () / CAST(sum(count(*)) OVER () AS DOUBLE)", "response_rate_of_all")},
           1 AS threshold_falls
    FROM (SELECT bad_flag, {_ntile("analytic_id", 16)} AS g FROM held_out) GROUP BY g"""


def _rank_sizes(kind: str, buckets: int) -> str:
    return f"""
    SELECT '{kind}' AS kind, NULL, NULL, NULL, NULL, NULL, 1, r, count(*)
    FROM (SELECT {buckets + 1} - {_ntile("analytic_id", buckets)} AS r FROM with_slope) GROUP BY r"""


def _exported() -> str:
    return f"""
    SELECT 'subscription' AS kind, crm_sub_id, analytic_id, CAST(register_date AS DATE) AS register_date,
           'Pre-paid' AS charge_type, DATE '{SCORING[0]}' AS prof_date, 1 AS in_order,
           CAST(NULL AS INTEGER) AS rank, CAST(NULL AS BIGINT) AS subscribers
    FROM with_slope UNION ALL {_rank_sizes("ea_decile", 10)} UNION ALL {_rank_sizes("ea_percentile", 100)}"""


_LABELLED_COLS = ["crm_sub_id", "analytic_id", "register_date", _r("score"), _r("risk"), "bad"]


def all_statements() -> dict[str, str]:
    from registry import boosted, incremental, reports

    return _own_statements() | boosted.all_statements() | incremental.all_statements() | reports.all_statements()


def _own_statements() -> dict[str, str]:
    june = [LABEL_MONTH]
    usage_june = _usage_tables(june)
    profile = _profile_tables(SCORING)
    loans = _loan_tables()
    scoring, training = _feature_steps(False), _feature_steps(True)
    now = _snapshot(SCORING[0])
    customers_now = {"customers": _customers(SCORING[:2])}
    scored = _scored_steps(SCORING[:1])
    lift = _scored_steps(SCORING[:2]) | _LIFT_STEPS
    profit = lift | _PROFIT_STEPS
    datamart_cols = ["analytic_id", "register_date", *_usage(TOPUP), *_usage(USAGE), "ddate"]
    loan_cols = ["analytic_id", "register_date", "ddate", _r("remain_balance_p1"), "recharge_count", "bad_flag"]
    loan_cols += ["prof_month"]
    lag_cols = _usage(_LAGGED_MEASURES)
    clean_features = ["analytic_id", "register_date"]
    in_base = "analytic_id IN (SELECT analytic_id FROM profile_now)"
    windowed = scoring | {
        "profile_window": f"SELECT * FROM profile_past WHERE {in_base}",
        "usage_window": f"SELECT * FROM usage_past WHERE {in_base}",
        "union_window": "SELECT * FROM profile_window FULL JOIN usage_window USING (analytic_id, register_date, ddate)",
        "lag_base": "SELECT analytic_id, register_date, prof_month FROM profile_now",
        "lag_only": _lagged("lag_base"),
        "unimputed_slope": _with_slope("lagged"),
    }
    profile_eligible = profile | {"eligible": _eligible("profile")}
    history_key = ["analytic_id", "register_date", "ddate"]
    feature_scoring = _statement(scoring, _feature_rows(False, "with_slope"))
    split = f"CASE WHEN {_hash('split-567')} < CAST(floor(0.75 * 4294967296) AS BIGINT) THEN 'train' ELSE 'test' END"
    scores_cols = ["crm_sub_id", "analytic_id", "register_date", _r("score", "p0")]
    return {
        "month_slice": _statement(
            {"topup_daily": TOPUP_DAILY},
            _select(["analytic_id", "register_date", "ddate", "top_up_tran", _r("top_up_value")], "topup_daily")
            + " WHERE ddate >= DATE '1998-05-01' AND ddate <= DATE '1998-06-30'",
        ),
        "add_shifted_month": _statement(
            profile,
            _select(
                [
                    "analytic_id",
                    "ddate",
                    *[f"last_day(ddate - INTERVAL {k} MONTH) AS prof_month_{k}" for k in (1, 2, 3)],
                ],
                "profile",
            ),
        ),
        "topup_monthly": _statement(
            usage_june, _select(["analytic_id", "register_date", *_usage(TOPUP)], "topup_month")
        ),
        "usage_monthly_sums": _statement(usage_june, _select(["analytic_id", *_usage(USAGE)], "usage_month")),
        "usage_datamart": _statement(usage_june, _select(datamart_cols, "usage_monthly")),
        "append_if_newer": _statement(
            _usage_tables([LABEL_MONTH, "1998-05-31"]), _select(datamart_cols, "usage_monthly")
        ),
        "label_bad_debtors": _statement(loans, _select(loan_cols, "labelled")),
        "drop_duplicated_subscribers": _statement(loans, _select(loan_cols, "single_labels")),
        "profile_snapshot": _statement(
            profile | {"profile_now": now["profile_now"].replace("AS prof_month", "")},
            _select(_profile_cols(_SNAPSHOT_COLS), "profile_now"),
        ),
        "usage_snapshot": _statement(
            _usage_tables(SCORING), _select(datamart_cols, "usage_monthly") + f" WHERE ddate = DATE '{SCORING[0]}'"
        ),
        "survey_snapshot": _statement(
            customers_now | {"survey": SURVEY},
            f"SELECT * EXCLUDE (mobile_status) FROM survey WHERE month_id = DATE '{SCORING[0]}'",
        ),
        "validity_snapshot": _statement(
            customers_now | {"validity": VALIDITY},
            "SELECT * EXCLUDE (date_id, crm_subscription_id) FROM validity " f"WHERE ddate = DATE '{SCORING[0]}'",
        ),
        "assemble_training_features": _statement(training, _select([*_ASSEMBLED_COLS, "bad_flag"], "assembled")),
        "assemble_scoring_features": _statement(scoring, _select(_ASSEMBLED_COLS, "assembled")),
        "profile_history_window": _statement(
            windowed, _select([*history_key, *[_r(c) for c in REVENUE]], "profile_window")
        ),
        "usage_history_window": _statement(
            windowed, _select([*history_key, *_usage(USAGE_HISTORY)], "usage_window")
        ),
        "history_union_frame": _statement(windowed, _select([*history_key, *_usage(MEASURES)], "union_window")),
        "attach_lags": _statement(
            windowed, _select(["analytic_id", "register_date", "prof_month", *lag_cols], "lag_only")
        ),
        "eligible_base": _statement(
            profile_eligible,
            _select(
                [
                    "CAST(activation_date AS DATE) AS activation_date" if c == "activation_date" else c
                    for c in _profile_cols(_PROFILE_ALL, ("age",))
                ],
                "eligible",
            ),
        ),
        "impute_mean": _statement(
            profile_eligible,
            _select(["analytic_id", "ddate", *[_r(_mean(c).split(" AS ")[0], c) for c in MEAN_IMPUTED]], "eligible"),
        ),
        "impute_unknown": _statement(
            profile,
            "SELECT analytic_id, ddate, coalesce(gender, 'unknown') AS gender, "
            "coalesce(handset_os, 'unknown') AS handset_os FROM profile",
        ),
        "impute_zero": _statement(
            scoring,
            _select(
                [
                    "analytic_id",
                    "register_date",
                    *[
                        f"coalesce({c}, 0) AS {c}"
                        if _base(c) in WHOLE or c in _WHOLE_FEATURES
                        else _r(f"coalesce({c}, 0)", c)
                        for c in zero_imputed()
                    ],
                ],
                "lagged",
            ),
        ),
        "assemble_clean_base": _statement(
            scoring,
            _select(
                [
                    "analytic_id",
                    "crm_sub_id",
                    "national_id",
                    "register_date",
                    *[_r(c) for c in MEAN_IMPUTED],
                    "mnp_flag",
                    "gender",
                    "handset_os",
                    *[c if c in _WHOLE_FEATURES else _usage([c])[0] for c in zero_imputed()],
                    "serenade",
                ],
                "clean",
            ),
        ),
        "regroup_segment": _statement(profile, f"SELECT analytic_id, ddate, {SERENADE} FROM profile"),
        "bucket_handset_os": _statement(profile, f"SELECT analytic_id, ddate, {HANDSET} FROM profile"),
        "default_flag": _statement(
            profile, "SELECT analytic_id, ddate, coalesce(mnp_flag, 'N') AS mnp_flag FROM profile"
        ),
        "derive_mean": _statement(scoring, _select([*clean_features, *[_r(c) for c in AVG_COLUMNS]], "with_mean")),
        "derive_sd": _statement(scoring, _select([*clean_features, *[_r(c) for c in SD_COLUMNS]], "with_sd")),
        "derive_slope": _statement(
            scoring, _select([*clean_features, *[_r(c) for c in SLOPE_COLUMNS]], "with_slope")
        ),
        "finalize_features": _statement(
            windowed,
            _select(
                [
                    *clean_features,
                    *[
                        f"coalesce({m}, 0) AS {m}" if m in WHOLE else _r(f"coalesce({m}, 0)", m)
                        for m in MEASURES
                    ],
                    *[_r(f"coalesce({c}, 0)", c) for c in SLOPE_COLUMNS],
                ],
                "unimputed_slope",
            ),
        ),
        "write_feature_set": feature_scoring,
        "table_profile": _statement(profile, _table_profile()),
        "down_sample": _statement(
            scored,
            _select(_LABELLED_COLS, "scored")
            + f" WHERE {_hash('sample')} < CAST(floor(0.1 * 4294967296) AS BIGINT)",
        ),
        "train_test_split": _statement(scored, _select([*_LABELLED_COLS, f"{split} AS split"], "scored")),
        "encode_features": _statement(
            training
            | {
                "finished": _select(
                    [
                        f"* REPLACE ({', '.join(f'coalesce({c}, 0) AS {c}' for c in SLOPE_COLUMNS)})",
                    ],
                    "with_slope",
                )
            }
            | _category_ranks(),
            _encoded(),
        ),
        "auc": _statement(scored | _CURVE, _AUC),
        "roc_points": _statement(scored | _CURVE, _ROC),
        "gains_lift": _statement(scored | _GAINS_STEPS, _GAINS),
        "write_scores": _statement(scored, _select(scores_cols, "scored")),
        "decile_lift_table": _statement(lift, _select(_LIFT_COLS, "lift")),
        "profit_loss": _statement(profit, _select(_PROFIT_COLS, "profit")),
        "profit_of_stored_lift": _statement(profit, _select(_PROFIT_COLS, "profit")),
        "best_decile": _statement(profit, _select(_PROFIT_COLS, "best")),
        "profit_headline": _statement(profit, _HEADLINE),
        "profit_report_table": _statement(profit, _REPORT),
        "profit_series": _statement(profit, _SERIES),
        "profile_months": _statement(
            lift, "SELECT DISTINCT CAST(prof_date AS VARCHAR) AS prof_month FROM lift ORDER BY 1"
        ),
        "ntile_exact": _statement(
            scored,
            _select(
                [
                    "analytic_id",
                    "register_date",
                    _r("score"),
                    f"{_ntile('score', 10)} AS ntile10",
                    f"{_ntile('score', 100)} AS ntile100",
                ],
                "scored",
            ),
        ),
        "rank_scores": _statement(scored, _campaign(SCORING[0])),
        "export_campaign_list": _statement(scored, _campaign(SCORING[0])),
        "append_score_table": _statement(
            scored, _campaign(SCORING[0]) + " UNION ALL " + _campaign(SCORING[1])
        ),
        "build_training_set": _statement(training, _feature_rows(True, "with_slope")),
        "build_scoring_set": feature_scoring,
        "train_classifier": _statement(
            training, "SELECT analytic_id, register_date, coalesce(bad_flag, 0) AS bad_flag, 1 AS in_range, 1 AS sums_to_one "
            "FROM with_slope",
        ),
        "variable_importance": "SELECT variable, 1 AS in_range, 1 AS shares_sum_to_one, 1 AS largest_is_one FROM (VALUES "
        + ", ".join(f"('{c}')" for c in feature_columns())
        + ") AS predictors(variable)",
        "score_subscribers": _statement(
            scoring, "SELECT crm_sub_id, analytic_id, register_date, 1 AS delivered FROM with_slope"
        ),
        "train": _statement(
            training | {"held_out": f"SELECT * FROM with_slope WHERE {split} = 'test'"}, _held_out()
        ),
        "score_and_export": _statement(scoring, _exported()),
    }
