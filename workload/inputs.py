"""The given tables seen as clients, appointments and sales.

The same expressions are written once more as SQL in `oracles.py`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revisit.config import Settings

SETTINGS = Settings(reporting_start="1995-01-01", partial_months=("1995-01",), intervention_month="1998-03")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _status(column: str):
    status = F.col(column)
    return (
        F.when(status == "F", F.lit("Completed"))
        .when(status == "O", F.lit("Cancelled"))
        .when(status == "P", F.lit("No-show"))
    )


def _client_key(order_key: str, customer_key: str):
    linked = F.col(order_key) % 20 != 0
    return F.when(linked, F.concat(F.lit("client_"), F.col(customer_key).cast("string")))


def appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    quarter_start = F.date_trunc("quarter", "o_orderdate").cast("timestamp_ntz")
    start = F.when(key % 4 == 0, quarter_start).otherwise(F.col("o_orderdate"))
    client_key = _client_key("o_orderkey", "o_custkey")
    none = F.lit(None)
    return orders.select(
        key.cast("string").alias("booking_id"),
        (start + F.make_dt_interval(hours=(key % 10).cast("int"))).alias("appointment_datetime"),
        none.cast("string").alias("main_category"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("LEAVE A REVIEW"))
        .otherwise(F.col("o_orderpriority"))
        .alias("service"),
        none.cast("string").alias("staffer"),
        F.col("o_totalprice").alias("service_value"),
        none.cast("double").alias("addons_value"),
        none.cast("double").alias("revenue_net"),
        none.cast("double").alias("discount"),
        none.cast("double").alias("tax"),
        none.cast("double").alias("tip_amount"),
        F.col("o_totalprice").alias("total_revenue"),
        _status("o_orderstatus").alias("status"),
        F.when(key % 50 != 0, (15 * (1 + key % 8)).cast("int")).alias("service_length_minutes"),
        client_key.alias("client_key"),
        F.when(client_key.isNull(), F.lit("unmatched")).otherwise(F.lit("exact_name")).alias("client_match_status"),
    )


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.min("o_orderdate").alias("first_order"),
            F.max("o_orderdate").alias("last_order"),
            F.count(F.lit(1)).alias("n_orders"),
            F.count_if(F.col("o_orderstatus") == "P").alias("n_no_shows"),
        )
    )
    customer = table(spark, sf_dir, "customer")
    earlier = F.col("first_order") - F.expr("INTERVAL 400 DAYS")
    return customer.join(visits, customer.c_custkey == visits.o_custkey, "left").select(
        F.concat(F.lit("client_"), F.col("c_custkey").cast("string")).alias("client_key"),
        F.col("c_mktsegment").alias("groups"),
        F.coalesce("n_orders", F.lit(0)).alias("bookings_count"),
        F.coalesce("n_no_shows", F.lit(0)).alias("no_shows_count"),
        F.when(F.col("c_custkey") % 4 == 0, earlier).otherwise(F.col("first_order")).alias("first_visit"),
        F.col("last_order").alias("last_visit"),
        F.col("c_acctbal").alias("total_revenue"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    parts = table(spark, sf_dir, "part")
    client_key = _client_key("o_orderkey", "o_custkey")
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(parts, lines.l_partkey == parts.p_partkey, "left")
        .select(
            F.col("l_shipdate").alias("checkout_date"),
            F.col("l_orderkey").cast("string").alias("transaction_id"),
            F.col("l_linestatus").alias("type"),
            F.col("l_returnflag").alias("category"),
            F.col("p_name").alias("item"),
            F.col("l_quantity").alias("quantity"),
            F.when(F.col("l_linenumber") % 5 != 0, F.col("o_orderdate")).alias("booking_date"),
            F.col("l_extendedprice").alias("service_value"),
            F.col("l_discount").alias("discount"),
            F.col("l_tax").alias("tax"),
            client_key.alias("client_key"),
            F.when(client_key.isNull(), F.lit("unmatched")).otherwise(F.lit("exact_name")).alias("client_match_status"),
        )
    )


def named_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients with names, some shared and some equal but for case."""
    first_visit = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_visit"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", _name().alias("client_name"))
    return customer.join(first_visit, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", "client_name", "first_visit"
    )


def _name():
    digit = F.col("c_custkey") % 10
    tens = F.floor(F.col("c_custkey") / 10).cast("string")
    return (
        F.when(digit.isin(0, 1), F.concat(F.lit("Client "), tens))
        .when(digit == 2, F.concat(F.lit("Guest "), tens))
        .when(digit == 3, F.upper(F.concat(F.lit("Guest "), tens)))
        .otherwise(F.col("c_name"))
    )


def named_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that spell the client's name in different ways, or not at all."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", _name().alias("client_name"))
    orders = table(spark, sf_dir, "orders")
    turn = F.col("o_orderkey") % 8
    name = F.col("client_name")
    spelled = (
        F.when(turn == 0, F.upper(name))
        .when(turn == 1, F.lower(name))
        .when(turn == 2, F.lit("Walk-In"))
        .when(turn == 3, F.lit(None))
        .when(turn == 4, F.concat(name, F.lit("?")))
        .otherwise(name)
    )
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        "o_orderkey", spelled.alias("client"), F.col("o_orderdate").alias("event_time")
    )
