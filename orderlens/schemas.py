"""Explicit schemas and the feature contract."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from orderlens import constants as C


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns feed a model. The id and the label are never features."""

    id: str = "order_id"
    label: str = C.TARGET
    numeric: list[str] = field(default_factory=lambda: list(C.NUMERIC_FEATURES))
    categorical: list[str] = field(default_factory=lambda: list(C.CATEGORICAL_FEATURES))

    @property
    def features(self) -> list[str]:
        return self.numeric + self.categorical

    def project(self, df: DataFrame, *extra: str) -> DataFrame:
        """Feature columns only (plus named extras), so the scan reads nothing else."""
        return df.select(*extra, *self.features)


ORDERS = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("product_category", T.StringType()),
    T.StructField("price_inr", T.DoubleType()),
    T.StructField("discount_pct", T.DoubleType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("customer_tenure_days", T.LongType()),
    T.StructField("num_previous_orders", T.LongType()),
    T.StructField("num_previous_returns", T.LongType()),
    T.StructField("delivery_distance_km", T.DoubleType()),
    T.StructField("delivery_days", T.LongType()),
    T.StructField("is_weekend_order", T.IntegerType()),
    T.StructField("rating_given", T.DoubleType()),
    T.StructField("returned", T.IntegerType()),
])

CATALOG = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("subcategory", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("return_window", T.IntegerType()),
    T.StructField("exchange_available", T.BooleanType()),
    T.StructField("cod_available", T.BooleanType()),
    T.StructField("delivery_sla", T.StringType()),
    T.StructField("non_returnable", T.BooleanType()),
    T.StructField("warranty", T.StringType()),
    T.StructField("description", T.StringType()),
])

DOCUMENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
])

ANSWER = T.StructType([
    T.StructField("answer", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
])
