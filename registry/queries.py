"""One query per operator over the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import views as v
from subscore.functions import hashing, months
from subscore.operators import (
    cleansing,
    datamart,
    derive,
    features,
    labels,
    metrics,
    model,
    profit,
    ranking,
)
from subscore.plans import jobs
from subscore.schemas import (
    AVG_COLUMNS,
    CAMPAIGN_SCHEMA,
    CATEGORICAL,
    MEAN_IMPUTED,
    MEASURES,
    SCORES_SCHEMA,
    SD_COLUMNS,
    SLOPE_COLUMNS,
    SUBSCRIPTION_KEY,
    zero_imputed,
)
from subscore.session import shared_folder
from subscore.sources import tables

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 4
SERIES_DIGITS = 9  # profit in millions is small in small data
# Production trees; the given tables have few labelled rows, so that all of them are used.
SETTINGS = model.ModelSettings(sample_fraction=1.0)


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles to a few digits, since the order of a sum moves the last ones."""
    return df.select(
        *[
            F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema
        ]
    )


# --- A: months and datamart -------------------------------------------------


def month_slice(spark, folder):
    sliced = months.month_slice(v.topup_daily(spark, folder), v.AS_OF, lag=1, months=2)
    return sliced.withColumn("register_date", F.to_date("register_date"))


def add_shifted_month(spark, folder):
    profile = v.profile(spark, folder, v.LABEL_MONTH).select("analytic_id", "ddate")
    for k in (1, 2, 3):
        profile = months.add_shifted_month(profile, k, target=f"prof_month_{k}")
    return profile


def topup_monthly(spark, folder):
    return datamart.topup_monthly(v.topup_daily(spark, folder), v.LABEL_MONTH)


def usage_monthly_sums(spark, folder):
    return datamart.usage_monthly_sums(v.usage_daily(spark, folder), v.LABEL_MONTH)


def usage_datamart(spark, folder):
    return datamart.usage_datamart(v.topup_daily(spark, folder), v.usage_daily(spark, folder), v.LABEL_MONTH)


def append_if_newer(spark, folder):
    """May, June, June again and then April: the table ends up with May and June."""
    path = f"{shared_folder(spark, 'append')}/usage_monthly"
    topup, usage = v.topup_daily(spark, folder, v.LABEL_MONTH, 3), v.usage_daily(spark, folder, v.LABEL_MONTH, 3)
    for lag in (2, 1, 1, 3):
        tables.append_if_newer(topup, usage, path, v.AS_OF, lag)
    return spark.read.parquet(path)


# --- B: labels --------------------------------------------------------------


def label_bad_debtors(spark, folder):
    return labels.label_bad_debtors(v.loans(spark, folder), v.AS_OF)


def drop_duplicated_subscribers(spark, folder):
    return labels.drop_duplicated_subscribers(label_bad_debtors(spark, folder))


# --- C: feature table -------------------------------------------------------


def profile_snapshot(spark, folder):
    return features.profile_snapshot(v.profile(spark, folder, v.SCORING_MONTH), v.SCORING_MONTH)


def usage_snapshot(spark, folder):
    return features.usage_snapshot(v.usage_monthly(spark, folder, v.SCORING_MONTH), v.SCORING_MONTH)


def survey_snapshot(spark, folder):
    return features.survey_snapshot(v.topup_survey(spark, folder, v.SCORING_MONTH, 2), v.SCORING_MONTH)


def validity_snapshot(spark, folder):
    return features.validity_snapshot(v.validity(spark, folder, v.SCORING_MONTH, 2), v.SCORING_MONTH)


def assemble_training_features(spark, folder):
    month = v.TRAINING_MONTH
    return features.assemble_training_features(
        drop_duplicated_subscribers(spark, folder),
        v.profile(spark, folder, month),
        v.usage_monthly(spark, folder, month),
        v.topup_survey(spark, folder, month),
        v.validity(spark, folder, month),
        month,
    )


def assemble_scoring_features(spark, folder):
    month = v.SCORING_MONTH
    return features.assemble_scoring_features(
        v.profile(spark, folder, month),
        v.usage_monthly(spark, folder, month),
        v.topup_survey(spark, folder, month),
        v.validity(spark, folder, month),
        month,
    )


def _histories(spark, folder):
    month = v.SCORING_MONTH
    profile, usage = v.profile(spark, folder, month), v.usage_monthly(spark, folder, month)
    spine = features.profile_spine(profile, month)
    return (
        spine,
        features.history_window(features.profile_history(profile, month), spine),
        features.history_window(features.usage_history(usage, month), spine),
    )


def profile_history_window(spark, folder):
    return _histories(spark, folder)[1]


def usage_history_window(spark, folder):
    return _histories(spark, folder)[2]


def history_union_frame(spark, folder):
    _, profile, usage = _histories(spark, folder)
    return features.history_union_frame(profile, usage)


def attach_lags(spark, folder):
    spine, profile, usage = _histories(spark, folder)
    base = spine.select(*SUBSCRIPTION_KEY, "prof_month")
    return features.attach_lags(base, features.history_union_frame(profile, usage), v.SCORING_MONTH)


# --- D: cleansing -----------------------------------------------------------


def _with_history(spark, folder):
    month = v.SCORING_MONTH
    t = v.monthly_tables(spark, folder, month)
    wide = features.assemble_scoring_features(t.profile, t.usage_monthly, t.topup_survey, t.validity, month)
    history = features.history_union_frame(
        features.profile_history(t.profile, month), features.usage_history(t.usage_monthly, month)
    )
    return features.attach_lags(wide, history, month)


def _eligible(spark, folder):
    return cleansing.eligible_base(v.profile(spark, folder, v.SCORING_MONTH))


def eligible_base(spark, folder):
    return _eligible(spark, folder).withColumn("activation_date", F.to_date("activation_date"))


def impute_mean(spark, folder):
    return cleansing.impute_mean(_eligible(spark, folder)).select("analytic_id", "ddate", *MEAN_IMPUTED)


def impute_unknown(spark, folder):
    return cleansing.impute_unknown(v.profile(spark, folder, v.SCORING_MONTH)).select(
        "analytic_id", "ddate", "gender", "handset_os"
    )


def impute_zero(spark, folder):
    return cleansing.impute_zero(_with_history(spark, folder)).select(*SUBSCRIPTION_KEY, *zero_imputed())


def assemble_clean_base(spark, folder):
    spine = jobs.profile_spine(v.profile(spark, folder, v.SCORING_MONTH), v.SCORING_MONTH)
    return cleansing.assemble_clean_base(_with_history(spark, folder), training=False, fit_on=spine)


def regroup_segment(spark, folder):
    profile = v.profile(spark, folder, v.SCORING_MONTH).select("analytic_id", "ddate", "master_segment_id")
    return cleansing.regroup_segment(profile)


def bucket_handset_os(spark, folder):
    profile = v.profile(spark, folder, v.SCORING_MONTH).select("analytic_id", "ddate", "handset_os")
    return cleansing.bucket_handset_os(profile)


def default_flag(spark, folder):
    profile = v.profile(spark, folder, v.SCORING_MONTH).select("analytic_id", "ddate", "mnp_flag")
    return cleansing.default_flag(profile)


# --- E: derived features ----------------------------------------------------


def derive_mean(spark, folder):
    return derive.derive_mean(assemble_clean_base(spark, folder)).select(*SUBSCRIPTION_KEY, *AVG_COLUMNS)


def derive_sd(spark, folder):
    with_mean = derive.derive_mean(assemble_clean_base(spark, folder))
    return derive.derive_sd(with_mean).select(*SUBSCRIPTION_KEY, *SD_COLUMNS)


def derive_slope(spark, folder):
    return derive.derive_slope(assemble_clean_base(spark, folder)).select(*SUBSCRIPTION_KEY, *SLOPE_COLUMNS)


def finalize_features(spark, folder):
    with_slope = derive.derive_slope(_with_history(spark, folder))
    return derive.finalize_features(with_slope).select(*SUBSCRIPTION_KEY, *MEASURES, *SLOPE_COLUMNS)


def write_feature_set(spark, folder):
    path = f"{shared_folder(spark, 'features')}/scoring_set"
    return tables.write_feature_set(build_scoring_set(spark, folder), path)


def table_profile(spark, folder):
    return tables.table_profile(v.profile(spark, folder, v.SCORING_MONTH))


# --- F: model ---------------------------------------------------------------


def _labelled(spark, folder):
    return v.scored_subscribers(spark, folder).select("crm_sub_id", *SUBSCRIPTION_KEY, "score", "risk", "bad")


def down_sample(spark, folder):
    return hashing.down_sample(_labelled(spark, folder), 0.1, SUBSCRIPTION_KEY)


def train_test_split(spark, folder):
    return hashing.with_split(_labelled(spark, folder), 0.75, SUBSCRIPTION_KEY)


def _training_table(spark, folder):
    path = f"{shared_folder(spark, 'training')}/training_set"
    return tables.write_feature_set(build_training_set(spark, folder), path)


def encode_features(spark, folder):
    """The category indices, and the sum of the vector in which they end up."""
    encoded = model.encode_features(_training_table(spark, folder))
    values = vector_to_array("features")
    return encoded.select(
        *SUBSCRIPTION_KEY,
        *[F.col(f"{c}_index").cast("int").alias(f"{c}_index") for c in CATEGORICAL],
        F.size(values).alias("n_features"),
        F.aggregate(values, F.lit(0.0), lambda total, x: total + x).alias("feature_sum"),
    )


_TRAINED: dict[tuple[str, str], str] = {}


def _trained(spark, folder):
    """Where the training job has put its model and reports: it runs once for an application and its tables."""
    run = (spark.sparkContext.applicationId, folder)
    if run not in _TRAINED:
        target = shared_folder(spark, "train")
        t = v.monthly_tables(spark, folder, v.TRAINING_MONTH)
        jobs.train_month(v.loans(spark, folder), t, v.AS_OF, target, SETTINGS)
        _TRAINED[run] = target
    return _TRAINED[run]


def _flag(condition):
    return F.coalesce(condition, F.lit(False)).cast("int")


def _delivered(score):
    """A chance in the digits in which scores are delivered."""
    return _flag(F.col(score).between(0, 1) & (F.col(score) == F.round(score, model.SCORE_DIGITS)))


def train_classifier(spark, folder):
    """Each training row, and whether the two chances that the model gives it are chances and add up to one."""
    target = _trained(spark, folder)
    predicted = model.predict(model.load_model(f"{target}/model"), spark.read.parquet(f"{target}/training_set"))
    return predicted.select(
        *SUBSCRIPTION_KEY,
        "bad_flag",
        _flag(F.col("p0").between(0, 1) & F.col("p1").between(0, 1)).alias("in_range"),
        _flag(F.abs(F.col("p0") + F.col("p1") - 1) < 1e-12).alias("sums_to_one"),
    )


def auc(spark, folder):
    return metrics.auc(_labelled(spark, folder), "risk", "bad")


def roc_points(spark, folder):
    return metrics.roc_points(_labelled(spark, folder), "risk", "bad")


def variable_importance(spark, folder):
    """Each predictor once, and whether shares add up to one and the largest scaled one is one."""
    predictors = Window.partitionBy()
    return model.variable_importance(model.load_model(f"{_trained(spark, folder)}/model")).select(
        "variable",
        _flag((F.col("relative_importance") >= 0) & F.col("scaled_importance").between(0, 1)).alias("in_range"),
        _flag(F.abs(F.sum("percentage").over(predictors) - 1) < 1e-9).alias("shares_sum_to_one"),
        _flag(F.max("scaled_importance").over(predictors) == 1).alias("largest_is_one"),
    )


def gains_lift(spark, folder):
    return metrics.gains_lift(_labelled(spark, folder), "risk", "bad")


def score_subscribers(spark, folder):
    """Each scored subscription, and whether its score is a chance of four digits."""
    fitted = model.load_model(f"{_trained(spark, folder)}/model")
    scores = model.score_subscribers(build_scoring_set(spark, folder), fitted)
    return scores.select("crm_sub_id", *SUBSCRIPTION_KEY, _delivered("p0").alias("delivered"))


def _scores(spark, folder):
    return v.scored_subscribers(spark, folder).withColumnRenamed("score", "p0").select(*SCORES_SCHEMA.fieldNames())


def write_scores(spark, folder):
    return tables.write_scores(_scores(spark, folder), f"{shared_folder(spark, 'scores')}/scores", text=True)


# --- G: lift and profit -----------------------------------------------------


def decile_lift_table(spark, folder):
    path = f"{shared_folder(spark, 'scored')}/scored"
    scored = tables.write_feature_set(v.scored_subscribers(spark, folder, months=2), path)
    ranked = ranking.ntile_exact(scored, "score", {"decile": 10}, by=["prof_date"], descending=True)
    return metrics.decile_lift_table(ranked)


def profit_loss(spark, folder):
    return profit.profit_loss(profit.with_scenarios(decile_lift_table(spark, folder)))


def profit_of_stored_lift(spark, folder):
    """Profit as the dashboard starts: from a lift table that was written as text."""
    path = f"{shared_folder(spark, 'lift')}/total_lift_tbl"
    tables.write_report(decile_lift_table(spark, folder), path)
    return profit.profit_loss(profit.with_scenarios(tables.read_lift_table(spark, path)))


def best_decile(spark, folder):
    return profit.best_decile(profit_loss(spark, folder))


def profit_headline(spark, folder):
    return profit.profit_headline(best_decile(spark, folder))


def profit_report_table(spark, folder):
    return profit.profit_report_table(profit_loss(spark, folder))


def profit_series(spark, folder):
    return profit.profit_series(profit_loss(spark, folder))


def profile_months(spark, folder):
    return profit.profile_months(decile_lift_table(spark, folder))


# --- H: ranks and lists -----------------------------------------------------


def ntile_exact(spark, folder):
    scored = _labelled(spark, folder).select(*SUBSCRIPTION_KEY, "score")
    return ranking.ntile_exact(scored, "score", {"ntile10": 10, "ntile100": 100})


def rank_scores(spark, folder):
    return ranking.rank_scores(_scores(spark, folder), v.SCORING_MONTH)


def export_campaign_list(spark, folder):
    target = tables.export_campaign_list(rank_scores(spark, folder), shared_folder(spark, "campaign"), v.AS_OF)
    return tables.read_campaign_list(spark, target)


def append_score_table(spark, folder):
    """Two months, the second of them written twice."""
    path = f"{shared_folder(spark, 'scoretable')}/score_table"
    for lag in (2, 1, 1):
        month = months.month_end(v.AS_OF, lag)
        tables.append_score_table(ranking.rank_scores(_scores(spark, folder), month), path, month)
    return tables.read_table(spark, path, CAMPAIGN_SCHEMA)


# --- I: jobs ----------------------------------------------------------------


def build_training_set(spark, folder):
    t = v.monthly_tables(spark, folder, v.TRAINING_MONTH)
    return jobs.build_training_set(v.loans(spark, folder), t, v.AS_OF)


def build_scoring_set(spark, folder):
    return jobs.build_scoring_set(v.monthly_tables(spark, folder, v.SCORING_MONTH), v.AS_OF)


def train(spark, folder):
    """The gains report: group sizes, the rate of all groups, and whether thresholds fall."""
    gains = spark.read.option("header", True).csv(f"{_trained(spark, folder)}/gains").select(
        F.col("group").cast("int").alias("group"),
        *[F.col(c).cast("double").alias(c) for c in ("cumulative_data_fraction", "lower_threshold", "cumulative_response_rate")],
    )
    groups = Window.orderBy("group")
    last = F.max_by("cumulative_response_rate", "group").over(Window.partitionBy())
    before = F.lag("lower_threshold").over(groups)
    return gains.select(
        "group",
        "cumulative_data_fraction",
        last.alias("response_rate_of_all"),
        _flag(before.isNull() | (F.col("lower_threshold") <= before)).alias("threshold_falls"),
    )


def _rank_sizes(campaign, rank):
    """Subscribers per rank, and whether none of them scores less than anyone of the next rank."""
    per_rank = campaign.groupBy(F.col(rank).alias("rank")).agg(
        F.count(F.lit(1)).alias("subscribers"), F.min("ea_score").alias("low"), F.max("ea_score").alias("top")
    )
    following = F.lead("top").over(Window.orderBy("rank"))
    return per_rank.select(
        F.lit(rank).alias("kind"),
        "rank",
        "subscribers",
        _flag(following.isNull() | (F.col("low") >= following)).alias("in_order"),
    )


def score_and_export(spark, folder):
    """The list's subscriptions and whether their scores are delivered as promised; sizes and order of the ranks."""
    target = shared_folder(spark, "score")
    usage_table = f"{target}/usage_monthly"
    topup, usage = v.topup_daily(spark, folder, v.SCORING_MONTH, 3), v.usage_daily(spark, folder, v.SCORING_MONTH, 3)
    for lag in (3, 2):
        tables.append_if_newer(topup, usage, usage_table, v.AS_OF, lag)
    campaign = jobs.score_month(
        topup,
        usage,
        usage_table,
        v.profile(spark, folder, v.SCORING_MONTH),
        v.topup_survey(spark, folder, v.SCORING_MONTH),
        v.validity(spark, folder, v.SCORING_MONTH),
        f"{_trained(spark, folder)}/model",
        v.AS_OF,
        target,
    )
    listed = campaign.select(
        F.lit("subscription").alias("kind"),
        "crm_sub_id",
        *SUBSCRIPTION_KEY,
        "charge_type",
        "prof_date",
        _delivered("ea_score").alias("in_order"),
    )
    ranks = _rank_sizes(campaign, "ea_decile").unionByName(_rank_sizes(campaign, "ea_percentile"))
    return listed.unionByName(ranks, allowMissingColumns=True)


_QUERIES: list[Query] = [
    month_slice,
    add_shifted_month,
    topup_monthly,
    usage_monthly_sums,
    usage_datamart,
    append_if_newer,
    label_bad_debtors,
    drop_duplicated_subscribers,
    profile_snapshot,
    usage_snapshot,
    survey_snapshot,
    validity_snapshot,
    assemble_training_features,
    assemble_scoring_features,
    profile_history_window,
    usage_history_window,
    history_union_frame,
    attach_lags,
    eligible_base,
    impute_mean,
    impute_unknown,
    impute_zero,
    assemble_clean_base,
    regroup_segment,
    bucket_handset_os,
    default_flag,
    derive_mean,
    derive_sd,
    derive_slope,
    finalize_features,
    write_feature_set,
    table_profile,
    down_sample,
    train_test_split,
    encode_features,
    train_classifier,
    auc,
    roc_points,
    variable_importance,
    gains_lift,
    score_subscribers,
    write_scores,
    decile_lift_table,
    profit_loss,
    profit_of_stored_lift,
    best_decile,
    profit_headline,
    profit_report_table,
    profit_series,
    profile_months,
    ntile_exact,
    rank_scores,
    export_campaign_list,
    append_score_table,
    build_training_set,
    train,
    build_scoring_set,
    score_and_export,
]


def _rounding(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        digits = SERIES_DIGITS if query is profit_series else DIGITS
        return rounded(query(spark, folder), digits)

    return run


def all_queries() -> dict[str, Query]:
    from registry import boosted, incremental, reports

    more = boosted.all_queries() | incremental.all_queries() | reports.all_queries()
    return {q.__name__: _rounding(q) for q in [*_QUERIES, *more.values()]}
