"""Order history: one feature row per order, built from order, line and customer tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.scoring import rule_score
from orderlens.functions.text import first_rule
from orderlens.operators.ordering import running_totals

# Market segment -> product category, order priority -> payment method.
CATEGORY_OF_SEGMENT = {
    "BUILDING": "Apparel",
    "AUTOMOBILE": "Electronics",
    "FURNITURE": "Home",
    "MACHINERY": "Footwear",
    "HOUSEHOLD": "Beauty",
}
PAYMENT_OF_PRIORITY = {
    "1-URGENT": "COD",
    "2-HIGH": "Prepaid_Card",
    "3-MEDIUM": "Prepaid_UPI",
    "4-NOT SPECIFIED": "Wallet",
    "5-LOW": "COD",
}


def line_summary(lineitem: DataFrame) -> DataFrame:
    """One row per order. Integer sums only, so the result does not depend on row order."""
    return lineitem.groupBy("l_orderkey").agg(
        F.count("*").alias("n_lines"),
        F.sum((F.col("l_returnflag") == "R").cast("bigint")).alias("n_returned_lines"),
        F.sum(F.round(F.col("l_discount") * 100).cast("bigint")).alias("discount_points"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        F.max("l_shipdate").alias("last_ship"))


def labelled_orders(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One row per order with its line summary and the label.

    An order counts as returned when at least half of its lines were.
    """
    base = orders.select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    ).join(line_summary(lineitem), F.col("o_orderkey") == F.col("l_orderkey"), "left").drop(
        "l_orderkey")
    return base.withColumn(
        "returned",
        F.coalesce((2 * F.col("n_returned_lines") >= F.col("n_lines")).cast("int"), F.lit(0)))


def order_features(labelled: DataFrame, customer: DataFrame) -> DataFrame:
    """The order table of the feature contract, from labelled orders.

    History columns look strictly before the order, so no label leaks into them. The input
    is read twice (see ``running_totals``); stage it when it comes from a large join.
    """
    shopper = customer.select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal")
    history = running_totals(
        labelled, ["o_custkey"], ["o_orderdate", "o_orderkey"],
        F.to_date("o_orderdate"),
        {"num_previous_orders": F.lit(1), "num_previous_returns": F.col("returned")},
        firsts={"first_order": F.col("o_orderdate")}, side=shopper)
    order_day = F.to_date("o_orderdate")
    lag_days = F.abs(F.date_diff(F.to_date("last_ship"), order_day))
    n = F.col("n_lines")
    # 100 * average discount to one decimal, half up, in whole numbers.
    discount = F.floor((20 * F.col("discount_points") + n) / (2 * n)) / F.lit(10.0)
    segment, priority = F.col("c_mktsegment"), F.col("o_orderpriority")
    return history.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        first_rule([(segment == k, v) for k, v in CATEGORY_OF_SEGMENT.items()],
                   F.lit(None).cast("string")).alias("product_category"),
        F.round(F.col("o_totalprice") / 10).alias("price_inr"),
        F.coalesce(discount, F.lit(0.0)).alias("discount_pct"),
        first_rule([(priority == k, v) for k, v in PAYMENT_OF_PRIORITY.items()],
                   F.lit(None).cast("string")).alias("payment_method"),
        F.date_diff(order_day, F.to_date("first_order")).cast("bigint")
        .alias("customer_tenure_days"),
        "num_previous_orders", "num_previous_returns",
        (F.round(F.abs("c_acctbal") * 2) / F.lit(10.0)).alias("delivery_distance_km"),
        F.greatest(F.lit(1), F.least(F.lit(21), F.coalesce(
            1 + F.floor(lag_days / 120), F.lit(1)))).cast("bigint").alias("delivery_days"),
        F.dayofweek(order_day).isin(1, 7).cast("int").alias("is_weekend_order"),
        (1 + F.col("quantity") % 5).cast("double").alias("rating_given"),
        "returned")


def scored(features: DataFrame) -> DataFrame:
    """Order rows with the rule score attached; every metric operator takes this frame."""
    return features.withColumn("score", rule_score())
