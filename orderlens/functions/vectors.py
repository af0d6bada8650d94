"""Vector columns: dot product, norm, cosine, softmax, standardisation, top entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    pairs = F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y)
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def softmax(v: Column) -> Column:
    shifted = F.transform(as_doubles(v), lambda x: F.exp(x - F.array_max(as_doubles(v))))
    return F.transform(
        shifted, lambda x: x / F.aggregate(shifted, F.lit(0.0), lambda acc, y: acc + y))


def argmax(v: Column) -> Column:
    """Zero-based position of the largest entry, the first one on a tie."""
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def width_of(df: DataFrame, vector: str) -> int:
    """Number of dimensions, taken from the data; vectors of different widths raise."""
    sizes = df.where(F.col(vector).isNotNull()).agg(
        F.min(F.size(vector)).alias("least"), F.max(F.size(vector)).alias("most")).first()
    if sizes["least"] != sizes["most"]:
        raise ValueError(f"{vector}: {sizes['least']} to {sizes['most']} dimensions")
    return sizes["most"] or 0


def standardise(v: Column, mean: Column, std: Column) -> Column:
    """Elementwise (x - mean) / std; a constant dimension becomes 0. Widths must agree."""
    same = F.assert_true(F.size(v) == F.size(mean), F.lit("vector and statistics differ in width"))
    checked = F.when(same.isNull(), as_doubles(v))
    centred = F.zip_with(checked, mean, lambda x, m: x - m)
    return F.zip_with(centred, std, lambda x, s: F.coalesce(F.try_divide(x, s), F.lit(0.0)))


def top_entries(probabilities: Column, k: int = 3) -> Column:
    """The k largest entries as structs (probability, index), best first."""
    indexed = F.transform(
        as_doubles(probabilities), lambda p, i: F.struct((-p).alias("neg"), i.alias("index")))
    return F.transform(
        F.slice(F.array_sort(indexed), 1, k),
        lambda e: F.struct((-e["neg"]).alias("probability"), e["index"].alias("index")))
