"""Column names and table schemas shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Column names and order of the public data model.
# --------------------------------------------------------------------------

SUBSCRIPTION_KEY = ["analytic_id", "register_date"]

REVENUE = [
    "norms_net_revenue_avg_3mth_p0_p2",
    "norms_net_revenue_gprs",
    "norms_net_revenue_vas",
    "norms_net_revenue_voice",
]

TOPUP = [
    "sum_monthly_tran_topup",
    "mean_monthly_topup_tran",
    "sd_monthly_topup_tran",
    "min_monthly_topup_tran",
    "max_monthly_topup_tran",
    "sum_monthly_topup_value",
    "mean_monthly_topup_value",
    "sd_monthly_topup_value",
    "min_monthly_topup_value",
    "max_monthly_topup_value",
]

# Monthly usage column -> daily column it sums.
USAGE_SOURCES = {
    "sum_monthly_data_kb": "data_vol_kb",
    "sum_monthly_voice_out_minute": "voice_out_minute",
    "sum_monthly_voice_out_cnt": "voice_out_cnt",
    "sum_monthly_voice_in_minute": "voice_in_minute",
    "sum_monthly_voice_in_cnt": "voice_in_cnt",
    "sum_monthly_sms_in_cnt": "sms_in_cnt",
}
USAGE = list(USAGE_SOURCES)

PROFILE_COLUMNS = [
    "analytic_id",
    "national_id",
    "crm_sub_id",
    "register_date",
    "ddate",
    "age",
    "credit_limit",
    "days_active",
    "service_month",
    "foreigner_flag",
    "gender",
    "charge_type",
    "mobile_status",
    "mnp_flag",
    "master_segment_id",
    "handset_launchprice",
    "handset_os",
    *REVENUE,
]

# The monthly usage measures that get a history, and all measures that do.
USAGE_HISTORY = ["sum_monthly_tran_topup", "sum_monthly_topup_value", *USAGE]
MEASURES = [*REVENUE, *USAGE_HISTORY]

VALIDITY_FEATURES = ["vald_res_10"]

MEAN_IMPUTED = ["age", "handset_launchprice", "credit_limit"]
UNKNOWN_IMPUTED = ["gender", "handset_os"]

CATEGORICAL = ["mnp_flag", "gender", "handset_os", "serenade"]
NOT_PREDICTORS = ["analytic_id", "crm_sub_id", "bad_flag", "register_date"]

# Months between the label month and the profile month it is joined to.
LABEL_TO_PROFILE_MONTHS = 3

# --------------------------------------------------------------------------
# Names derived from the above.
# --------------------------------------------------------------------------


def lag_name(measure: str, lag: int) -> str:
    return f"{measure}_p{lag}"


LAG_COLUMNS = [lag_name(m, lag) for lag in (1, 2) for m in MEASURES]
AVG_COLUMNS = [f"avg_{m}" for m in MEASURES]
SD_COLUMNS = [f"sd_{m}" for m in MEASURES]
SLOPE_COLUMNS = [f"slope_{m}_p1" for m in MEASURES]


def zero_imputed(validity_features: list[str] | None = None) -> list[str]:
    """Columns whose missing values count as zero, in table order."""
    return [
        "days_active",
        "service_month",
        *REVENUE,
        *TOPUP,
        *USAGE,
        *(validity_features or VALIDITY_FEATURES),
        *LAG_COLUMNS,
    ]


def feature_columns(validity_features: list[str] | None = None) -> list[str]:
    """Predictors, in the order in which the feature tables hold them."""
    return [
        *MEAN_IMPUTED,
        "mnp_flag",
        *UNKNOWN_IMPUTED,
        "days_active",
        "service_month",
        *REVENUE,
        *TOPUP,
        *USAGE,
        *(validity_features or VALIDITY_FEATURES),
        "serenade",
        *AVG_COLUMNS,
        *SD_COLUMNS,
        *SLOPE_COLUMNS,
    ]


def feature_table_columns(training: bool, validity_features: list[str] | None = None) -> list[str]:
    label = ["bad_flag"] if training else []
    return ["analytic_id", "crm_sub_id", *label, "register_date", *feature_columns(validity_features)]


# --------------------------------------------------------------------------
# Schemas of the tables this package reads. Ids stay strings, so that leading
# zeros survive a round trip through text files.
# --------------------------------------------------------------------------


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in columns.items()])


_s, _d, _f, _l, _i, _ts = (
    T.StringType(),
    T.DateType(),
    T.DoubleType(),
    T.LongType(),
    T.IntegerType(),
    T.TimestampType(),
)

LOANS_SCHEMA = _struct(analytic_id=_s, register_date=_d, ddate=_d, remain_balance_p1=_f, recharge_count=_l)

PROFILE_SCHEMA = _struct(
    analytic_id=_s,
    activation_date=_ts,
    ddate=_d,
    national_id=_s,
    crm_sub_id=_s,
    age=_s,
    credit_limit=_f,
    days_active=_l,
    service_month=_l,
    foreigner_flag=_s,
    gender=_s,
    charge_type=_s,
    mobile_status=_s,
    mnp_flag=_s,
    master_segment_id=_s,
    handset_launchprice=_f,
    handset_os=_s,
    **{c: _f for c in REVENUE},
)

TOPUP_DAILY_SCHEMA = _struct(analytic_id=_s, register_date=_ts, ddate=_d, top_up_tran=_l, top_up_value=_f)

USAGE_DAILY_SCHEMA = _struct(
    analytic_id=_s,
    ddate=_d,
    data_vol_kb=_f,
    voice_out_minute=_f,
    voice_out_cnt=_l,
    voice_in_minute=_f,
    voice_in_cnt=_l,
    sms_in_cnt=_l,
)

_LONG_TOPUP = {"sum_monthly_tran_topup", "min_monthly_topup_tran", "max_monthly_topup_tran"}

USAGE_MONTHLY_SCHEMA = _struct(
    analytic_id=_s,
    register_date=_d,
    **{c: (_l if c in _LONG_TOPUP else _f) for c in TOPUP},
    **{c: (_l if c.endswith("_cnt") else _f) for c in USAGE},
    ddate=_d,
)

SCORES_SCHEMA = _struct(crm_sub_id=_s, analytic_id=_s, register_date=_d, p0=_f)

CAMPAIGN_SCHEMA = _struct(
    crm_sub_id=_s,
    analytic_id=_s,
    register_date=_d,
    ea_score=_f,
    ea_decile=_i,
    ea_percentile=_i,
    charge_type=_s,
    prof_date=_d,
)

LIFT_SCHEMA = _struct(
    decile=_i,
    cum_avg_trx=_f,
    no_subs=_l,
    cum_no_subs=_l,
    lower_treshold=_f,
    use_prop=_f,
    cum_no_use=_l,
    cum_use_prop=_f,
    bad_prop=_f,
    cum_bad_prop=_f,
    lift_rate=_f,
    prof_date=_d,
)
