"""Score, threshold-grid and risk-band expressions. All are plain columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens import constants as C


def guarded_ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 where whole is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def rule_score(prefix: str = "", **override: Column) -> Column:
    """Closed-form return probability, rounded to 6 dp so that equal orders tie exactly.

    ``override`` replaces single feature columns, which is how permutation importance
    asks "what would the score be with this feature taken from another order".
    """
    terms = rule_terms(prefix, **override)
    log_odds = reduce(lambda x, y: x + y, terms.values(), F.lit(C.RULE_INTERCEPT))
    return round_fast(sigmoid(log_odds), RULE_DIGITS)


RULE_DIGITS = 6


def rule_terms(prefix: str = "", **override: Column) -> dict[str, Column]:
    """What is added to the intercept, in this order, by the feature it comes from; the ratio of
    returns to orders stands under the returns."""
    def col(name: str) -> Column:
        return override[name] if name in override else F.col(prefix + name)

    ratio = guarded_ratio(col("num_previous_returns"), col("num_previous_orders"))
    return {
        "num_previous_returns": C.RULE_PREV_RETURN_RATIO * ratio,
        "product_category":
            C.RULE_FIT_RISK * col("product_category").isin(C.FIT_RISK_CATEGORIES).cast("double"),
        "discount_pct": C.RULE_DISCOUNT * (col("discount_pct") - 20) / 10,
        "payment_method": C.RULE_COD * (col("payment_method") == "COD").cast("double"),
        "delivery_days": C.RULE_DELIVERY * (col("delivery_days") - 4.5) / 2,
        "price_inr": C.RULE_PRICE * (col("price_inr") / C.RULE_PRICE_SCALE),
        "is_weekend_order": C.RULE_WEEKEND * col("is_weekend_order"),
        "customer_tenure_days": -(C.RULE_TENURE * F.tanh(col("customer_tenure_days") / 500)),
    }


def round_fast(x: Column, digits: int) -> Column:
    """Half-up rounding of a non-negative double in plain arithmetic.

    F.round goes through a big decimal per row, which dominates a score that is evaluated
    once per row, feature and repeat.
    """
    scale = float(10 ** digits)
    return F.floor(x * scale + 0.5) / F.lit(scale)


RULE_INPUTS = [
    "price_inr", "discount_pct", "customer_tenure_days", "num_previous_orders",
    "num_previous_returns", "delivery_days", "is_weekend_order", "product_category",
    "payment_method",
]


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def grid_value(index: Column) -> Column:
    """Threshold number ``index`` of the grid, the same double as the literal 0.10, 0.12, .."""
    return (C.GRID_FIRST_PERCENT + C.GRID_STEP_PERCENT * index) / F.lit(100.0)


def grid_index(score: Column) -> Column:
    """Index of the highest threshold <= score, -1 below the grid.

    Arithmetic guess, then one comparison each way against the exact grid values, so the
    inclusive comparison is exact without testing 41 thresholds per row.
    """
    guess = F.greatest(F.lit(-1), F.least(
        F.lit(C.GRID_POINTS - 1),
        F.floor((score * 100 - C.GRID_FIRST_PERCENT) / C.GRID_STEP_PERCENT).cast("int")))
    fixed = (
        F.when((guess >= 0) & (grid_value(guess) > score), guess - 1)
        .when((guess < C.GRID_POINTS - 1) & (grid_value(guess + 1) <= score), guess + 1)
        .otherwise(guess))
    return fixed.cast("int")


def flagged(score: Column, threshold: float | Column) -> Column:
    """1 where the score reaches the threshold (inclusive)."""
    return (score >= threshold).cast("int")


def risk_bucket(score: Column, threshold: Column | float) -> Column:
    """Low / Medium / High against the threshold, on the unrounded score."""
    return (
        F.when(score < threshold, "Low")
        .when(score < threshold + F.lit(C.BUCKET_WIDTH), "Medium")
        .otherwise("High"))


def decision_confidence(probability: Column) -> Column:
    return F.greatest(probability, 1 - probability)


def precision(tp: Column, fp: Column) -> Column:
    return guarded_ratio(tp, tp + fp)


def recall(tp: Column, fn: Column) -> Column:
    return guarded_ratio(tp, tp + fn)


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    """F1 from counts; equal to the harmonic mean of precision and recall, 0 when tp is 0."""
    return guarded_ratio(2 * tp, 2 * tp + fp + fn)


def risk_verdict(bucket: Column) -> Column:
    expr = F.lit("Risk band unavailable.")
    for name, text in C.RISK_VERDICTS.items():
        expr = F.when(bucket == name, text).otherwise(expr)
    return expr


def risk_actions(bucket: Column) -> Column:
    """At most five follow-up actions for one scored order."""
    cod = F.col("payment_method") == "COD"
    fit = F.col("product_category").isin(C.FIT_RISK_CATEGORIES)
    discount = F.coalesce(F.col("discount_pct"), F.lit(0.0))
    days = F.coalesce(F.col("delivery_days"), F.lit(0))
    high, medium = bucket == "High", bucket == "Medium"
    low = ~(high | medium)
    tips = [
        F.when(high & cod, C.ACTION_PREPAID_ONLY),
        F.when(high, C.ACTION_QUALITY_CHECK),
        F.when(high & fit, C.ACTION_SIZE_GUIDE),
        F.when(high & (discount >= 40), F.format_string(C.ACTION_DISCOUNT, discount)),
        F.when(high & (days >= 7), C.ACTION_EXPEDITE),
        F.when(medium, C.ACTION_CHECK_IN),
        F.when(medium & fit, C.ACTION_OFFER_GUIDE),
        F.when(medium & cod, C.ACTION_PREPAID_NUDGE),
        F.when(low, C.ACTION_STANDARD),
        F.when(low, C.ACTION_FAST_TRACK),
    ]
    return F.slice(F.array_compact(F.array(*tips)), 1, 5)


def original_feature(name: Column) -> Column:
    """Model column back to its source column: num__x -> x, cat__x_LEVEL -> x."""
    stripped = F.regexp_replace(name, "^(?:num|cat)__", "")
    expr = stripped
    for cat in C.CATEGORICAL_FEATURES:
        expr = F.when(stripped.startswith(cat + "_"), cat).otherwise(expr)
    return expr
