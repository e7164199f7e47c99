from __future__ import annotations

import os
from datetime import date, datetime

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from registry import queries, views
from subscore.operators import model, ranking
from subscore.operators.datamart import usage_datamart
from subscore.plans import jobs
from subscore.schemas import (
    CAMPAIGN_SCHEMA,
    SCORES_SCHEMA,
    TOPUP_DAILY_SCHEMA,
    USAGE_DAILY_SCHEMA,
    feature_columns,
    feature_table_columns,
)
from subscore.session import shared_folder
from subscore.sources import tables
from tests.conftest import rows

R = datetime(2015, 1, 1)
SETTINGS = model.ModelSettings(sample_fraction=1.0, trees=5, rate=0.1, depth=3)


def _daily(spark):
    days = [date(2019, m, 15) for m in (4, 5, 6)]
    topup = spark.createDataFrame([("a", R, d, 1, 10.0) for d in days], TOPUP_DAILY_SCHEMA)
    usage = spark.createDataFrame([("b", d, 1.0, 2.0, 3, 4.0, 5, 6) for d in days], USAGE_DAILY_SCHEMA)
    return topup, usage


@pytest.mark.parametrize("kind", ["folder", "catalog"])
def test_months_are_added_only_if_newer(spark, tmp_path, kind):
    target = str(tmp_path / "usage") if kind == "folder" else "usage_agg"
    topup, usage = _daily(spark)
    as_of = date(2019, 7, 15)
    assert tables.latest_month(spark, target) is None
    added = [tables.append_if_newer(topup, usage, target, as_of, lag) for lag in (2, 2, 1, 3, 1)]
    assert added == [True, False, True, False, False]
    spark.catalog.clearCache()
    if kind == "catalog":
        spark.catalog.refreshTable(target)
    stored = tables.read_table(spark, target)
    expected = usage_datamart(topup, usage, date(2019, 5, 31)).unionByName(
        usage_datamart(topup, usage, date(2019, 6, 30))
    )
    assert rows(stored.select(*expected.columns)) == rows(expected)
    assert tables.latest_month(spark, target) == date(2019, 6, 30)


def test_bucketed_datamart_is_joined_without_a_shuffle(spark, data_folder):
    topup, usage = (f(spark, data_folder, views.SCORING_MONTH, 3) for f in (views.topup_daily, views.usage_daily))
    for lag in (3, 2, 1):
        assert tables.append_if_newer(topup, usage, "usage_bucketed", views.AS_OF, lag, buckets=4)
    assert not tables.append_if_newer(topup, usage, "usage_bucketed", views.AS_OF, 1, buckets=4)
    stored = spark.table("usage_bucketed")
    computed = views.usage_monthly(spark, data_folder, views.SCORING_MONTH)
    assert rows(queries.rounded(stored.select(*computed.columns))) == rows(queries.rounded(computed))
    t = views.monthly_tables(spark, data_folder, views.SCORING_MONTH)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = jobs.build_scoring_set(
            jobs.MonthlyTables(t.profile, stored, t.topup_survey, t.validity), views.AS_OF
        )
        plan = wide._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Spine, survey, validity and revenue history are exchanged; usage is not.
    assert plan.count("Exchange hashpartitioning") == 4
    assert plan.count("Bucketed: true") == 2
    assert rows(queries.rounded(wide)) == rows(queries.rounded(queries.build_scoring_set(spark, data_folder)))


def test_only_catalog_tables_are_bucketed(spark, tmp_path):
    topup, usage = _daily(spark)
    with pytest.raises(ValueError, match="catalog"):
        tables.append_if_newer(topup, usage, str(tmp_path / "t"), date(2019, 7, 15), buckets=4)


def test_other_analysis_errors_are_not_an_empty_table(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "t"))
    with pytest.raises(Exception, match="ddate"):
        tables.latest_month(spark, str(tmp_path / "t"))


def test_feature_set_is_replaced(spark, tmp_path):
    path = str(tmp_path / "set")
    for n in (5, 3):
        written = tables.write_feature_set(spark.range(n), path)
    assert written.count() == 3
    assert tables.write_feature_set(spark.range(2), "feature_set").count() == 2
    assert tables.write_feature_set(spark.range(4), "feature_set").count() == 4


def _scores(spark):
    return spark.createDataFrame(
        [(f"00{i}", f"0{i}", date(2015, 1, 1), i / 1000) for i in range(100)], SCORES_SCHEMA
    )


@pytest.mark.parametrize("text", [False, True])
def test_scores_keep_leading_zeros(spark, tmp_path, text):
    scores = _scores(spark)
    assert rows(tables.write_scores(scores, str(tmp_path / "scores"), text)) == rows(scores)


def test_campaign_list_file_set(spark, tmp_path):
    campaign = ranking.rank_scores(_scores(spark), date(2019, 6, 30))
    target = tables.export_campaign_list(campaign, str(tmp_path), date(2019, 7, 15))
    assert os.path.basename(target) == "EA_pre_201907_SCORE.txt"
    assert rows(tables.read_campaign_list(spark, target)) == rows(campaign)
    part = next(p for p in os.listdir(target) if p.startswith("part-"))
    with open(os.path.join(target, part)) as lines:
        assert lines.readline().strip() == "|".join(CAMPAIGN_SCHEMA.fieldNames())


@pytest.mark.parametrize("kind", ["folder", "catalog"])
def test_score_table_months(spark, tmp_path, kind):
    target = str(tmp_path / "scores") if kind == "folder" else "score_output"
    for month in (date(2019, 5, 31), date(2019, 6, 30), date(2019, 6, 30)):
        stored = tables.append_score_table(ranking.rank_scores(_scores(spark), month), target, month)
    counts = {r.prof_date: r["count"] for r in stored.groupBy("prof_date").count().collect()}
    assert counts == {date(2019, 5, 31): 100, date(2019, 6, 30): 100}


def test_table_profile(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, None)], "`x.y` string, n int")
    assert rows(tables.table_profile(df)) == [(1, "x.y", "string", 3, 2, 2), (2, "n", "int", 3, 2, 1)]
    assert tables.preview(df, 2).count() == 2


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark, "x") != shared_folder(spark, "x")
    assert spark.sparkContext.getCheckpointDir().startswith("file:" + spark.conf.get("spark.checkpoint.dir"))


@pytest.fixture(scope="module")
def trained(spark, data_folder, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("train"))
    result = jobs.train_month(
        views.loans(spark, data_folder),
        views.monthly_tables(spark, data_folder, views.TRAINING_MONTH),
        views.AS_OF,
        folder,
        SETTINGS,
    )
    return result, folder


def test_feature_sets_have_the_declared_columns(spark, data_folder):
    assert queries.build_training_set(spark, data_folder).columns == feature_table_columns(True)
    assert queries.build_scoring_set(spark, data_folder).columns == feature_table_columns(False)


def test_features_are_complete_and_lags_arrive(spark, data_folder):
    df = queries.build_scoring_set(spark, data_folder)
    nulls = df.select([F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    assert sum(nulls) == 0
    assert df.filter("slope_norms_net_revenue_gprs_p1 <> 0").count() > 0
    assert df.filter("sd_sum_monthly_data_kb > 0").count() > 0


def test_means_of_another_population(spark, data_folder):
    t = views.monthly_tables(spark, data_folder, views.SCORING_MONTH)
    means = {"age": -5.0, "handset_launchprice": -6.0, "credit_limit": -7.0}
    df = jobs.build_scoring_set(t, views.AS_OF, means=means)
    assert df.filter("age = -5 OR handset_launchprice = -6 OR credit_limit = -7").count() > 0
    assert df.count() == queries.build_scoring_set(spark, data_folder).count()


def test_encoded_features(spark, data_folder):
    encoded = model.encode_features(queries.build_training_set(spark, data_folder))
    sizes = encoded.select(F.size(vector_to_array("features")).alias("n")).distinct().collect()
    assert [r.n for r in sizes] == [len(feature_columns())]


def test_model_learns_and_repeats(spark, data_folder):
    rows_ = tables.write_feature_set(
        queries.build_training_set(spark, data_folder).withColumn(
            "bad_flag", (F.col("norms_net_revenue_voice") > 500).cast("int")
        ),
        f"{shared_folder(spark, 'learn')}/rows",
    )
    first, second = (model.predict(model.train_classifier(rows_, SETTINGS), rows_) for _ in range(2))
    assert rows(first.select("analytic_id", "p0")) == rows(second.select("analytic_id", "p0"))
    from subscore.operators.metrics import auc

    assert auc(first, "p1", "bad_flag").first().auc > 0.9
    assert first.filter("p0 < 0 OR p0 > 1").count() == 0
    delivered = model.score_subscribers(rows_, model.train_classifier(rows_, SETTINGS))
    assert delivered.filter("p0 < 0 OR p0 > 1 OR p0 <> round(p0, 4)").count() == 0


def test_training_job_reports(spark, trained):
    result, folder = trained
    importance = result.importance.collect()
    assert [r.variable for r in importance] != []
    assert {r.variable for r in importance} == set(feature_columns())
    assert sum(r.percentage for r in importance) == pytest.approx(1.0)
    assert importance[0].scaled_importance == 1.0
    assert result.gains.count() == 16
    for report in ("importance", "gains", "roc", "auc", "predictors"):
        assert spark.read.option("header", True).csv(f"{folder}/{report}").count() > 0
    parameters = dict(rows(spark.read.option("header", True).csv(f"{folder}/parameters")))
    assert parameters["profile_month"] == str(views.TRAINING_MONTH)
    assert (parameters["trees"], parameters["seed"]) == ("5", "567")


def test_scoring_job(spark, data_folder, trained, tmp_path):
    _, trained_folder = trained
    folder = str(tmp_path / "out")
    topup, usage = (f(spark, data_folder, views.SCORING_MONTH, 3) for f in (views.topup_daily, views.usage_daily))
    for lag in (3, 2):
        tables.append_if_newer(topup, usage, f"{folder}/usage", views.AS_OF, lag)
    inputs = [f(spark, data_folder, views.SCORING_MONTH) for f in (views.profile, views.topup_survey, views.validity)]
    for _ in range(2):  # a second run must end in the same state
        campaign = jobs.score_month(
            topup, usage, f"{folder}/usage", *inputs, f"{trained_folder}/model", views.AS_OF, folder
        )
    n = queries.build_scoring_set(spark, data_folder).count()
    assert campaign.count() == n
    assert tables.latest_month(spark, f"{folder}/usage") == views.SCORING_MONTH
    # The features built from the stored datamart equal those built in one plan.
    stored = spark.read.parquet(f"{folder}/scoring_set")
    direct = queries.build_scoring_set(spark, data_folder)
    assert rows(queries.rounded(stored)) == rows(queries.rounded(direct))
    listed = tables.read_campaign_list(spark, tables.campaign_folder(f"{folder}/campaign", views.AS_OF))
    assert rows(listed) == rows(campaign)
    sizes = [r["count"] for r in campaign.groupBy("ea_decile").count().collect()]
    assert max(sizes) - min(sizes) <= 1
    ordered = campaign.groupBy("ea_decile").agg(F.max("ea_score").alias("top"), F.min("ea_score").alias("low"))
    by_decile = {r.ea_decile: r for r in ordered.collect()}
    assert all(by_decile[d].low >= by_decile[d + 1].top for d in range(1, 10))
