from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from subscore.operators import metrics, profit
from subscore.schemas import LIFT_SCHEMA
from subscore.sources.tables import read_lift_table, write_report
from tests.conftest import rows

MAY, JUNE = date(2019, 5, 31), date(2019, 6, 30)


def _subscribers(spark):
    """Ten deciles of 100 in two months; worse deciles use and owe more."""
    return spark.range(2000).select(
        F.when(F.col("id") % 2 == 0, F.lit(MAY)).otherwise(F.lit(JUNE)).alias("prof_date"),
        (F.floor(F.col("id") / 2) % 10 + 1).cast("int").alias("decile"),
        (1 - (F.floor(F.col("id") / 2) % 10) / 20 - F.floor(F.col("id") / 20) / 100000).alias("score"),
        F.floor(F.col("id") / 20).alias("k"),
    ).select(
        "prof_date",
        "decile",
        "score",
        F.when(F.col("k") < 95, (F.col("k") < F.col("decile")).cast("int")).alias("bad"),
        (F.col("k") < 30 + 5 * F.col("decile")).cast("int").alias("used"),
        F.when(F.col("k") < 30 + 5 * F.col("decile"), 2).otherwise(0).alias("trx"),
    )


def test_lift_table_identities(spark):
    lift = metrics.decile_lift_table(_subscribers(spark))
    assert lift.columns == LIFT_SCHEMA.fieldNames()
    table = lift.filter(F.col("prof_date") == F.lit(MAY)).orderBy("decile").collect()
    assert [r.no_subs for r in table] == [100] * 10
    assert [r.cum_no_subs for r in table] == [100 * d for d in range(1, 11)]
    assert table[0].bad_prop == round(1 / 95, 5)
    assert table[0].use_prop == round(35 / 95, 5)
    assert table[9].cum_bad_prop == pytest.approx(55 / 950)
    assert table[9].lift_rate == pytest.approx(1.0, abs=1e-4)
    assert table[0].lift_rate == pytest.approx(round(55 / 950, 5) / (1 / 95))
    assert all(r.cum_avg_trx == 2.0 for r in table)
    thresholds = [r.lower_treshold for r in table]
    assert thresholds == sorted(thresholds, reverse=True)


def test_lift_table_of_a_month_without_labels(spark):
    unlabelled = _subscribers(spark).withColumn("bad", F.lit(None).cast("int"))
    row = metrics.decile_lift_table(unlabelled).first()
    assert row.no_subs == 100
    assert (row.bad_prop, row.cum_bad_prop, row.lift_rate, row.cum_avg_trx) == (None, None, None, None)


def test_profit_of_a_known_row(spark):
    lift = metrics.decile_lift_table(_subscribers(spark))
    by_decile = {
        (r.prof_date, r.decile): r
        for r in profit.profit_loss(profit.with_scenarios(lift, takeup=[20], fee=[2], loan=[20])).collect()
    }
    last = by_decile[MAY, 10]
    assert last.take_adj == pytest.approx(0.2)
    assert last.cum_fee == pytest.approx(1000 * 0.2 * 2 * 2 * (1 - 55 / 950))
    assert last.cum_loss == pytest.approx(1000 * 55 / 950 * 0.2 * 20)
    assert last.p_l == pytest.approx(last.cum_fee - last.cum_loss)


# Published lift rows (month, decile, cum_no_subs, cum_avg_trx,
# cum_use_prop, cum_bad_prop) and the profit of decile 9 at the default scenario.
PUBLISHED = [
    (date(2019, 2, 28), 8, 14538574, 2.2839204070976464, 0.735590284821852, 0.02774127691985697),
    (date(2019, 2, 28), 9, 16363056, 2.308170178970848, 0.7469492805566215, 0.03659231996384765),
    (date(2019, 2, 28), 10, 18213881, 2.294538216045456, 0.7685518739117992, 0.07719901470190989),
    (date(2019, 3, 31), 8, 14592589, 2.3097960862666747, 0.7132467237823192, 0.05206016988252503),
    (date(2019, 3, 31), 9, 16421523, 2.33662509091089, 0.7253197740555148, 0.06308415376044456),
    (date(2019, 3, 31), 10, 18279464, 2.326369742612364, 0.7466419690304079, 0.09978802874005668),
    (date(2019, 4, 30), 8, 14555477, 5.193013713896047, 0.7010812687756541, 0.03321227239932988),
    (date(2019, 4, 30), 9, 16404546, 5.217954475443239, 0.7049785534237396, 0.04248280451918337),
    (date(2019, 4, 30), 10, 18279463, 5.153364107357685, 0.7238979892514574, 0.07874023789322823),
    (date(2019, 5, 31), 8, 14899866, 5.1738436638019465, 0.7585684502400509, 0.027758780771802268),
    (date(2019, 5, 31), 9, 16740273, 5.1919218469141235, 0.7661347050410443, 0.036091614065231654),
    (date(2019, 5, 31), 10, 18653460, 5.102388376759305, 0.7843681306747914, 0.0736465738069704),
]
PUBLISHED_PROFIT = {
    date(2019, 2, 28): 11817835.65,
    date(2019, 3, 31): 9944061.02,
    date(2019, 4, 30): 29213057.24,
    date(2019, 5, 31): 30371376.65,
}


def test_published_months(spark):
    columns = "prof_date date, decile int, cum_no_subs long, cum_avg_trx double, cum_use_prop double, cum_bad_prop double"
    lift = spark.createDataFrame(PUBLISHED, columns)
    defaults = profit.with_scenarios(lift, [profit.DEFAULT_TAKEUP])
    best = profit.best_decile(profit.profit_loss(defaults))
    assert {r.prof_date: (r.decile, round(r.p_l, 2)) for r in best.collect()} == {
        month: (9, value) for month, value in PUBLISHED_PROFIT.items()
    }
    shown = profit.profit_headline(best).filter(F.col("prof_date") == F.lit(date(2019, 2, 28))).first()
    assert (shown.subs, shown.risky, shown.profit) == ("16.36 M", "3.66%", "12 M")


def test_lift_table_survives_text(spark, tmp_path):
    lift = metrics.decile_lift_table(_subscribers(spark))
    write_report(lift, str(tmp_path / "lift"))
    assert rows(read_lift_table(spark, str(tmp_path / "lift"))) == rows(lift)


def test_default_scenarios_and_ties(spark):
    scenarios = profit.with_scenarios(metrics.decile_lift_table(_subscribers(spark)))
    assert scenarios.count() == 2 * 10 * 21
    best = profit.best_decile(profit.profit_loss(scenarios))
    per_scenario = {tuple(r[:2]): r[2] for r in best.groupBy("prof_date", "takeup").count().collect()}
    assert per_scenario[MAY, 0.0] == 10
    assert per_scenario[MAY, 20.0] == 1


def test_display_rounding_is_half_even(spark):
    columns = "prof_date date, takeup double, fee double, loan double, decile int, cum_no_subs long, cum_bad_prop double, p_l double"
    best = spark.createDataFrame(
        [
            (MAY, 20.0, 2.0, 20.0, 9, 16363056, 0.0366, 11817835.65),
            (MAY, 20.0, 2.0, 20.0, 8, 2000000, 0.00125, -2500000.0),
            (MAY, 20.0, 2.0, 20.0, 7, 0, 0.0, 3500000.0),
        ],
        columns,
    )
    got = {r.decile: (r.subs, r.risky, r.profit) for r in profit.profit_headline(best).collect()}
    assert got[9] == ("16.36 M", "3.66%", "12 M")
    assert got[8] == ("2 M", "0.12%", "-2 M")
    assert got[7] == ("0 M", "0%", "4 M")


def test_report_and_series(spark):
    losses = profit.profit_loss(profit.with_scenarios(metrics.decile_lift_table(_subscribers(spark)), takeup=[20]))
    report = profit.profit_report_table(losses)
    assert report.columns == [*profit.SCENARIO, *profit.REPORT_COLUMNS]
    row = report.filter((F.col("decile") == 10) & (F.col("prof_date") == F.lit(MAY))).first()
    assert row.cum_loss == -round(1000 * 55 / 950 * 0.2 * 20)
    assert row.take_adj == 20
    assert row.cum_bad_prop == round(5500 / 950, 2)
    series = profit.profit_series(losses)
    assert series.count() == 3 * losses.count()
    assert {r.series for r in series.select("series").distinct().collect()} == {
        "lift_rate",
        "risky_percent",
        "profit_millions",
    }


def test_report_of_one_month(spark):
    lift = metrics.decile_lift_table(_subscribers(spark))
    report = profit.profit_report(lift.filter(F.col("prof_date") == F.lit(JUNE)), takeup=[35], fee=[3], loan=[50])
    assert rows(report.months) == [("2019-06-30",)]
    assert report.table.count() == 10
    assert report.series.count() == 30
    (headline,) = report.headline.collect()
    assert (headline.prof_date, headline.takeup, headline.fee, headline.loan) == (JUNE, 35.0, 3.0, 50.0)
    best = max(report.table.collect(), key=lambda r: r.p_l)
    assert headline.decile == best.decile


def test_months_are_sorted_text(spark):
    months = profit.profile_months(metrics.decile_lift_table(_subscribers(spark)))
    assert [r.prof_month for r in months.collect()] == ["2019-05-31", "2019-06-30"]
    assert rows(months) == [("2019-05-31",), ("2019-06-30",)]
