"""The subscriber tables, derived from the customer, orders and lineitem tables.

A customer is a subscriber, an order a top-up, an order line a usage record.
Columns without a counterpart are functions of the customer key, so that the
SQL in ``oracle.py`` can state the same table.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from subscore.functions.months import month_begin, month_end
from subscore.operators.datamart import usage_datamart
from subscore.plans.jobs import MonthlyTables
from subscore.schemas import SUBSCRIPTION_KEY
from subscore.session import shared_folder

AS_OF = date(1998, 7, 15)
LABEL_MONTH = month_end(AS_OF, 1)
TRAINING_MONTH = month_end(AS_OF, 4)
SCORING_MONTH = month_end(AS_OF, 1)


# Schemas by path: inferring one starts a job, and a query reads a table many times.
_SCHEMAS: dict[str, StructType] = {}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _within(column: str, month: date | None, months: int) -> Column:
    """Range test on the raw timestamp, which the Parquet scan can use."""
    if month is None:
        return F.lit(True)
    return (F.col(column) >= F.lit(month_begin(month, months - 1))) & (
        F.col(column) < F.lit(month + timedelta(days=1))
    )


def _registered(custkey: str) -> Column:
    return F.date_add(F.lit(date(1990, 1, 1)), ((F.col(custkey) * 7919) % 3000).cast("int"))


def _month_ends(last: date, months: int) -> Column:
    return F.explode(F.array(*[F.lit(month_end(last, k)) for k in range(months)]))


def topup_daily(spark: SparkSession, folder: str, month: date | None = None, months: int = 1) -> DataFrame:
    second = F.when(F.col("o_orderpriority") == "1-URGENT", 365).otherwise(0)
    return (
        _table(spark, folder, "orders")
        .filter(_within("o_orderdate", month, months))
        .select(
            F.col("o_custkey").cast("string").alias("analytic_id"),
            F.date_add(_registered("o_custkey"), second).cast("timestamp").alias("register_date"),
            F.to_date("o_orderdate").alias("ddate"),
            (1 + F.col("o_orderkey") % 3).alias("top_up_tran"),
            F.col("o_totalprice").alias("top_up_value"),
        )
    )


def usage_daily(spark: SparkSession, folder: str, month: date | None = None, months: int = 1) -> DataFrame:
    owners = _table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return (
        _table(spark, folder, "lineitem")
        .filter(_within("l_shipdate", month, months))
        .join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_custkey").cast("string").alias("analytic_id"),
            F.to_date("l_shipdate").alias("ddate"),
            F.col("l_extendedprice").alias("data_vol_kb"),
            F.col("l_quantity").alias("voice_out_minute"),
            F.col("l_linenumber").cast("long").alias("voice_out_cnt"),
            (F.col("l_quantity") * F.col("l_discount")).alias("voice_in_minute"),
            (F.col("l_linenumber") % 3).cast("long").alias("voice_in_cnt"),
            (F.col("l_linenumber") % 2).cast("long").alias("sms_in_cnt"),
        )
    )


def usage_monthly(spark: SparkSession, folder: str, month: date, months: int = 3) -> DataFrame:
    return usage_datamart(
        topup_daily(spark, folder, month, months), usage_daily(spark, folder, month, months), month, months
    )


def stored_usage_monthly(spark: SparkSession, folder: str, month: date, months: int = 3) -> DataFrame:
    """The datamart as the jobs find it: a table by month, from one pass over the daily facts."""
    mart = usage_monthly(spark, folder, month, months)
    path = f"{shared_folder(spark, 'usage')}/usage_monthly"
    mart.write.partitionBy("ddate").parquet(path)
    return spark.read.schema(mart.schema).parquet(path)


def _customers(spark: SparkSession, folder: str, month: date, months: int) -> DataFrame:
    return _table(spark, folder, "customer").select(
        "*",
        F.col("c_custkey").cast("string").alias("analytic_id"),
        _registered("c_custkey").alias("register_date"),
        _month_ends(month, months).alias("ddate"),
    )


def profile(spark: SparkSession, folder: str, month: date, months: int = 3) -> DataFrame:
    key, balance = F.col("c_custkey"), F.abs("c_acctbal")
    number = F.month("ddate")
    age = F.when(key % 97 == 0, "n/a").when(key % 11 != 0, (key % 60 + 15).cast("string"))
    segment = (
        F.when(F.col("c_nationkey") == 1, "Prospect Platinum")
        .when(F.col("c_nationkey") == 2, "Prospect Emerald")
        .when(F.col("c_nationkey") == 3, "NA")
        .when(F.col("c_nationkey") == 4, "Prospect Plat Plus")
        .when(F.col("c_mktsegment") == "MACHINERY", "Prospect Gold")
        .when(F.col("c_mktsegment") == "BUILDING", "Platinum Plus")
        .when(F.col("c_mktsegment") == "AUTOMOBILE", "Standard")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "Gold")
    )
    systems = F.array(*[F.lit(s) for s in ("Android", "iOS", "Proprietary", "Unknown", None, "Symbian")])
    quiet = (key % 5 == 0) & number.isin(1, 2, 4, 5)
    return (
        _customers(spark, folder, month, months)
        .filter(F.col("register_date") <= F.col("ddate"))
        .select(
            "analytic_id",
            F.col("register_date").cast("timestamp").alias("activation_date"),
            "ddate",
            F.concat(F.lit("N"), "analytic_id").alias("national_id"),
            F.concat(F.lit("C"), "analytic_id").alias("crm_sub_id"),
            age.alias("age"),
            F.when(key % 7 != 0, (key % 50 * 100).cast("double")).alias("credit_limit"),
            (key % 31).alias("days_active"),
            (
                (F.year("ddate") - F.year("register_date")) * 12 + F.month("ddate") - F.month("register_date")
            )
            .cast("long")
            .alias("service_month"),
            F.when(F.col("c_nationkey") == 0, "Y").otherwise("N").alias("foreigner_flag"),
            F.when(key % 3 == 0, "M").when(key % 3 == 1, "F").alias("gender"),
            F.when(key % 10 == 0, "Post-paid").otherwise("Pre-paid").alias("charge_type"),
            F.when(key % 13 == 0, "SP").otherwise("SA").alias("mobile_status"),
            F.when(key % 4 == 1, "Y").when(key % 4 > 1, "N").alias("mnp_flag"),
            segment.alias("master_segment_id"),
            F.when(key % 9 != 0, key % 200 * F.lit(50.0)).alias("handset_launchprice"),
            F.get(systems, (key % 6).cast("int")).alias("handset_os"),
            (balance * number / F.lit(20.0)).alias("norms_net_revenue_avg_3mth_p0_p2"),
            (balance * (number % 4 + 1) / F.lit(50.0)).alias("norms_net_revenue_gprs"),
            F.when(key % 8 != 0, balance / F.lit(10.0)).alias("norms_net_revenue_vas"),
            F.when(quiet, 0.0).otherwise(balance * (key % 3) / F.lit(4.0)).alias("norms_net_revenue_voice"),
        )
    )


def _monthly_orders(spark: SparkSession, folder: str, month: date, months: int) -> DataFrame:
    return (
        _table(spark, folder, "orders")
        .filter(_within("o_orderdate", month, months))
        .select("o_custkey", F.last_day("o_orderdate").alias("order_month"), "o_orderpriority")
    )


def _with_order_count(customers: DataFrame, orders: DataFrame) -> DataFrame:
    counts = orders.groupBy("o_custkey", "order_month").agg(F.count(F.lit(1)).alias("n_orders"))
    same = (F.col("c_custkey") == F.col("o_custkey")) & (F.col("ddate") == F.col("order_month"))
    return customers.join(counts, same, "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))


def loans(spark: SparkSession, folder: str, month: date = LABEL_MONTH, months: int = 2) -> DataFrame:
    """A row per customer and month, and one more for each urgent order of the month."""
    orders = _monthly_orders(spark, folder, month, months)
    base = _with_order_count(_customers(spark, folder, month, months), orders)
    urgent = orders.filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").alias("u_custkey"), F.col("order_month").alias("u_month")
    )
    again = base.join(urgent, (F.col("c_custkey") == F.col("u_custkey")) & (F.col("ddate") == F.col("u_month")))
    return (
        base.unionByName(again.select(*base.columns))
        .select(
            F.when(F.col("c_acctbal") <= 9900, F.col("analytic_id")).alias("analytic_id"),
            "register_date",
            "ddate",
            F.when(F.col("c_nationkey") != 24, F.col("c_acctbal")).alias("remain_balance_p1"),
            F.col("n_orders").alias("recharge_count"),
        )
    )


def topup_survey(spark: SparkSession, folder: str, month: date, months: int = 1) -> DataFrame:
    return _customers(spark, folder, month, months).select(
        "analytic_id",
        F.col("register_date").cast("timestamp").alias("register_date"),
        F.col("ddate").alias("month_id"),
        F.lit("SA").alias("mobile_status"),
        (F.col("c_custkey") % 5).alias("survey_topup_cnt"),
    )


def validity(spark: SparkSession, folder: str, month: date, months: int = 1) -> DataFrame:
    return _customers(spark, folder, month, months).select(
        "analytic_id",
        F.col("register_date").cast("timestamp").alias("register_date"),
        "ddate",
        F.date_format("ddate", "yyyyMMdd").alias("date_id"),
        F.concat(F.lit("C"), "analytic_id").alias("crm_subscription_id"),
        F.when(F.col("c_custkey") % 12 != 0, (F.col("c_custkey") % 10).cast("double")).alias("vald_res_10"),
    )


def monthly_tables(spark: SparkSession, folder: str, month: date) -> MonthlyTables:
    return MonthlyTables(
        profile=profile(spark, folder, month),
        usage_monthly=stored_usage_monthly(spark, folder, month),
        topup_survey=topup_survey(spark, folder, month),
        validity=validity(spark, folder, month),
    )


def scored_subscribers(spark: SparkSession, folder: str, months: int = 1) -> DataFrame:
    """Subscribers with a score of many ties, the score's complement, and what they did.

    The label is missing for the richest customers.
    """
    customers = _customers(spark, folder, SCORING_MONTH, months)
    orders = _monthly_orders(spark, folder, SCORING_MONTH, months)
    divisor = F.when(F.col("ddate") == F.lit(SCORING_MONTH), 60).otherwise(55)
    step = F.floor((F.col("c_acctbal") + 1000) / divisor)
    risky = (F.col("c_acctbal") < 0) | ((F.col("c_nationkey") < 5) & (F.col("c_acctbal") < 5000))
    return _with_order_count(customers, orders).select(
        F.concat(F.lit("C"), "analytic_id").alias("crm_sub_id"),
        *SUBSCRIPTION_KEY,
        F.col("ddate").alias("prof_date"),
        (step / 200).alias("score"),
        ((200 - step) / 200).alias("risk"),
        F.when(F.col("c_acctbal") <= 9900, F.when(risky, 1).otherwise(0)).alias("bad"),
        F.when(F.col("n_orders") > 0, 1).otherwise(0).alias("used"),
        F.col("n_orders").alias("trx"),
    )
