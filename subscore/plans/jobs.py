"""The four monthly jobs: training set, training, scoring set, scores and list."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from datetime import date
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscore.functions.hashing import down_sample, train_test_split
from subscore.functions.months import month_end
from subscore.operators.boosting import (
    BoostedTrees,
    BoostSettings,
    boosted_importance,
    save_boosted,
    staged_measures,
    stopping_point,
    train_boosted,
)
from subscore.operators.cleansing import assemble_clean_base
from subscore.operators.derive import derive_features
from subscore.operators.features import (
    attach_lags,
    attach_snapshots,
    duplicated_keys,
    label_spine_with_profile,
    profile_history,
    profile_snapshot,
    profile_spine,
    survey_snapshot,
    unique_keys,
    usage_by,
    usage_history,
    usage_snapshot,
    validity_snapshot,
)
from subscore.operators.labels import drop_duplicated_subscribers, label_bad_debtors
from subscore.operators.metrics import auc, gains_lift, roc_points
from subscore.operators.model import (
    LABEL,
    ModelSettings,
    load_model,
    predict,
    save_model,
    score_subscribers,
    train_classifier,
    variable_importance,
)
from subscore.operators.ranking import rank_scores
from subscore.schemas import LABEL_TO_PROFILE_MONTHS, REVENUE, SUBSCRIPTION_KEY, USAGE_HISTORY
from subscore.sources.tables import (
    append_if_newer,
    append_score_table,
    export_campaign_list,
    read_table,
    write_feature_set,
    write_report,
    write_scores,
)


@dataclass(frozen=True)
class MonthlyTables:
    """The monthly tables from which features are built.

    Each holds one row per subscription and month. A repeated key would repeat
    feature rows; ``check_keys`` makes that an error.
    """

    profile: DataFrame
    usage_monthly: DataFrame
    topup_survey: DataFrame
    validity: DataFrame


def check_keys(tables: MonthlyTables, month: date) -> None:
    """Fail if a subscription repeats in a table of ``month`` or in its history.

    Reads and shuffles keys only, all tables in one job.
    """
    profile, usage = tables.profile, tables.usage_monthly
    read = {
        "profile": profile_snapshot(profile, month).withColumnRenamed("ddate", "month"),
        "usage_monthly": usage_snapshot(usage, month).withColumnRenamed("ddate", "month"),
        "topup_survey": survey_snapshot(tables.topup_survey, month).withColumnRenamed("month_id", "month"),
        "validity": validity_snapshot(tables.validity, month).withColumnRenamed("ddate", "month"),
        "profile history": profile_history(profile, month).withColumnRenamed("ddate", "month"),
        "usage_monthly history": usage_history(usage, month).withColumnRenamed("ddate", "month"),
    }
    known = F.col("analytic_id").isNotNull() & F.col("register_date").isNotNull()
    key = [*SUBSCRIPTION_KEY, "month"]
    repeated = [
        duplicated_keys(df.filter(known), key).select(F.lit(name).alias("name"), "month") for name, df in read.items()
    ]
    found = reduce(DataFrame.unionByName, repeated).first()
    if found:
        raise ValueError(f"{found['name']} repeats a subscription in {found['month']}")


def _features(
    spine: DataFrame,
    tables: MonthlyTables,
    month: date,
    training: bool,
    validity_features: list[str] | None,
    means: Mapping[str, float] | None,
    usage_key: str,
) -> DataFrame:
    """Everything from the spine to the finished features as one lazy plan.

    The imputed means depend on profile columns only, so they are fitted on
    the spine before the other joins. History is pivoted per source, which
    needs no outer join of the two. A subscription that repeats makes the plan fail
    when it is run.
    """
    usage = usage_by(usage_key, tables.usage_monthly, tables.profile)
    wide = attach_snapshots(spine, usage, tables.topup_survey, tables.validity, month)
    wide = attach_lags(wide, profile_history(tables.profile, month), month, REVENUE)
    wide = unique_keys(attach_lags(wide, usage_history(usage, month), month, USAGE_HISTORY))
    return derive_features(assemble_clean_base(wide, training, validity_features, means, fit_on=spine))


def build_training_set(
    loans: DataFrame,
    tables: MonthlyTables,
    as_of: date,
    lag: int = 0,
    validity_features: list[str] | None = None,
    usage_key: str = "subscription",
) -> DataFrame:
    """Labelled feature table of the label month one month before ``as_of``."""
    label_lag = lag + 1
    labels = drop_duplicated_subscribers(label_bad_debtors(loans, as_of, label_lag), keep_unknown=False)
    month = month_end(as_of, label_lag + LABEL_TO_PROFILE_MONTHS)
    spine = label_spine_with_profile(labels, tables.profile, month)
    return _features(spine, tables, month, True, validity_features, None, usage_key)


def build_scoring_set(
    tables: MonthlyTables,
    as_of: date,
    lag: int = 0,
    validity_features: list[str] | None = None,
    means: Mapping[str, float] | None = None,
    usage_key: str = "subscription",
) -> DataFrame:
    """Feature table of the last full month before ``as_of``.

    Means are fitted on the scored subscribers unless ``means`` gives those of
    the training set.
    """
    month = month_end(as_of, lag + 1)
    return _features(profile_spine(tables.profile, month), tables, month, False, validity_features, means, usage_key)


@dataclass(frozen=True)
class TrainingResult:
    model: BoostedTrees
    auc: DataFrame
    roc: DataFrame
    importance: DataFrame
    gains: DataFrame


def train(training_set: DataFrame, folder: str, settings: ModelSettings = ModelSettings()) -> TrainingResult:
    """Sample, split, fit, and measure on the part held out.

    ``training_set`` should be a written table, as the fit reads it several
    times. The model and the scores of the part held out are written below
    ``folder``: all measures read those scores, so the model is applied once.
    """
    sample = down_sample(training_set, settings.sample_fraction, SUBSCRIPTION_KEY)
    train_rows, test_rows = train_test_split(sample, settings.train_ratio, SUBSCRIPTION_KEY)
    model = train_classifier(train_rows, settings)
    save_model(model, f"{folder}/model")
    tested = write_feature_set(
        predict(model, test_rows).select(*SUBSCRIPTION_KEY, LABEL, "p0", "p1"), f"{folder}/held_out_scores"
    )
    return TrainingResult(
        model=model,
        auc=auc(tested, "p1", LABEL),
        roc=roc_points(tested, "p1", LABEL),
        importance=variable_importance(model),
        gains=gains_lift(tested, "p1", LABEL),
    )


@dataclass(frozen=True)
class BoostingResult:
    model: BoostedTrees
    measures: DataFrame
    auc: DataFrame
    roc: DataFrame
    importance: DataFrame
    gains: DataFrame


def train_second_order(
    training_set: DataFrame, folder: str, settings: BoostSettings = BoostSettings(), every: int = 10, patience: int = 0
) -> BoostingResult:
    """As ``train``, with second-order trees that are measured on the part held out after each ``every`` trees.

    With a ``patience`` the model is cut at the first measured stage that ends so many
    stages without a lower log loss; else all trees stay. The measures of all stages
    are written below ``folder``, where ``score_and_export`` finds the model.
    """
    sample = down_sample(training_set, settings.sample_fraction, SUBSCRIPTION_KEY)
    train_rows, test_rows = train_test_split(sample, settings.train_ratio, SUBSCRIPTION_KEY)
    model = train_boosted(train_rows, settings)
    measures = write_feature_set(staged_measures(model, test_rows, every), f"{folder}/measures")
    if patience:
        model = model.prefix(stopping_point(measures, patience) or len(model.trees))
    save_boosted(model, training_set.sparkSession, f"{folder}/model")
    tested = write_feature_set(
        predict(model, test_rows).select(*SUBSCRIPTION_KEY, LABEL, "p0", "p1"), f"{folder}/held_out_scores"
    )
    return BoostingResult(
        model=model,
        measures=measures,
        auc=auc(tested, "p1", LABEL),
        roc=roc_points(tested, "p1", LABEL),
        importance=boosted_importance(model),
        gains=gains_lift(tested, "p1", LABEL),
    )


def train_month(
    loans: DataFrame,
    tables: MonthlyTables,
    as_of: date,
    folder: str,
    settings: ModelSettings = ModelSettings(),
    lag: int = 0,
    training_table: str | None = None,
    check: bool = True,
) -> TrainingResult:
    """The whole training job: key check, features, model, reports.

    Replaces the training table (``training_table``, else a folder), and the
    model and reports below ``folder``.
    """
    if check:
        check_keys(tables, month_end(as_of, lag + 1 + LABEL_TO_PROFILE_MONTHS))
    features = build_training_set(loans, tables, as_of, lag)
    training_set = write_feature_set(features, training_table or f"{folder}/training_set")
    result = train(training_set, folder, settings)
    write_report(result.importance, f"{folder}/importance")
    write_report(result.gains, f"{folder}/gains")
    write_report(result.roc, f"{folder}/roc")
    write_report(result.auc, f"{folder}/auc")
    spark = loans.sparkSession
    names = [(i, name) for i, name in enumerate(settings.features, start=1)]
    write_report(spark.createDataFrame(names, "position int, predictor string"), f"{folder}/predictors")
    values = {"profile_month": month_end(as_of, lag + 1 + LABEL_TO_PROFILE_MONTHS)}
    values |= {f.name: getattr(settings, f.name) for f in fields(settings) if f.name != "features"}
    parameters = spark.createDataFrame([(k, str(v)) for k, v in values.items()], "parameter string, value string")
    write_report(parameters, f"{folder}/parameters")
    return result


def score_and_export(
    scoring_set: DataFrame,
    model: PipelineModel | BoostedTrees | str,
    as_of: date,
    folder: str,
    lag: int = 0,
    score_table: str | None = None,
) -> DataFrame:
    """Score, rank, and write the score parts, the score table and the campaign list.

    Ranking reads the scores twice, hence from the written parts: the model is
    applied once. Returns the scored month of the score table.
    """
    if isinstance(model, str):
        model = load_model(model)
    scores = write_scores(score_subscribers(scoring_set, model), f"{folder}/scores")
    month = month_end(as_of, lag + 1)
    table = append_score_table(rank_scores(scores, month), score_table or f"{folder}/score_table", month)
    campaign = table.filter(F.col("prof_date") == F.lit(month))
    export_campaign_list(campaign, f"{folder}/campaign", as_of)
    return campaign


def score_month(
    topup_daily: DataFrame,
    usage_daily: DataFrame,
    usage_table: str,
    profile: DataFrame,
    topup_survey: DataFrame,
    validity: DataFrame,
    model: PipelineModel | BoostedTrees | str,
    as_of: date,
    folder: str,
    lag: int = 0,
    scoring_table: str | None = None,
    score_table: str | None = None,
    usage_buckets: int = 0,
    check: bool = True,
) -> DataFrame:
    """The whole scoring job: extend the datamart, check keys, build features, score, export."""
    append_if_newer(topup_daily, usage_daily, usage_table, as_of, lag + 1, usage_buckets)
    usage = read_table(topup_daily.sparkSession, usage_table)
    tables = MonthlyTables(profile, usage, topup_survey, validity)
    if check:
        check_keys(tables, month_end(as_of, lag + 1))
    features = build_scoring_set(tables, as_of, lag)
    written = write_feature_set(features, scoring_table or f"{folder}/scoring_set")
    return score_and_export(written, model, as_of, folder, lag, score_table)
