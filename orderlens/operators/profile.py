"""Profiling: rate tables, headline rates, missingness by group, quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens import constants as C
from orderlens.functions.scoring import guarded_ratio
from orderlens.session import bounded_rows


def rate_tables(df: DataFrame, by: list[str], label: str = C.TARGET) -> DataFrame:
    """Rate tables of several columns from one scan: count the cube once, then fold it."""
    cube = df.groupBy(*by).agg(
        F.count("*").alias("orders"), F.sum(F.col(label)).cast("bigint").alias("returns"))
    levels = F.array(*[
        F.struct(F.lit(c).alias("dimension"), F.col(c).alias("level")) for c in by])
    return (
        cube.select(F.explode(levels).alias("g"), "orders", "returns")
        .groupBy("g.dimension", "g.level")
        .agg(F.sum("orders").alias("orders"), F.sum("returns").alias("returns"))
        .withColumn("return_rate", F.round(guarded_ratio(F.col("returns"), F.col("orders")), 6)))


def headline(df: DataFrame, label: str = C.TARGET, nullable: str = "rating_given") -> DataFrame:
    """Row count, column count, label mean and missing fraction as one row."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.round(F.avg(label), 6).alias("return_rate"),
        F.round(F.avg(F.col(nullable).isNull().cast("int")), 6).alias("missing_rate"))


def levels_of(df: DataFrame, column: str, limit: int) -> list:
    """The non-NULL levels of a column of few levels, sorted; more than ``limit`` raise."""
    found = bounded_rows(distinct_levels(df, column), limit, f"levels of {column}")
    return sorted(r[column] for r in found if r[column] is not None)


def missingness_by_group(df: DataFrame, columns: list[str], groups: dict[str, Column],
                         min_gap: float = 0.05) -> DataFrame:
    """Missing rate inside and outside each observed group, for every (column, group) pair.

    One aggregate over the data for all pairs. A gap of at least ``min_gap`` on an observed
    group is called MAR: the missingness depends on something we can see.
    """
    counts = []
    for g, inside in groups.items():
        flag = F.coalesce(inside, F.lit(False))
        counts += [F.sum(flag.cast("bigint")).alias(f"n|{g}")]
        counts += [F.sum((flag & F.col(c).isNull()).cast("bigint")).alias(f"m|{g}|{c}")
                   for c in columns]
    counts += [F.count("*").alias("n")]
    counts += [F.sum(F.col(c).isNull().cast("bigint")).alias(f"m|{c}") for c in columns]
    one = df.agg(*counts)
    pairs = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.lit(g).alias("group_name"),
            F.col(f"`n|{g}`").alias("n_in"), (F.col("n") - F.col(f"`n|{g}`")).alias("n_out"),
            F.col(f"`m|{g}|{c}`").alias("missing_in"),
            (F.col(f"`m|{c}`") - F.col(f"`m|{g}|{c}`")).alias("missing_out"))
        for c in columns for g in groups])
    rate_in = guarded_ratio(F.col("missing_in"), F.col("n_in"))
    rate_out = guarded_ratio(F.col("missing_out"), F.col("n_out"))
    return one.select(F.inline(pairs)).select(
        "*",
        F.round(rate_in, 6).alias("rate_in"), F.round(rate_out, 6).alias("rate_out"),
        F.round((rate_in - rate_out) * 100, 4).alias("gap_pp"),
        F.round(F.try_divide(rate_in, rate_out), 6).alias("ratio"),
        F.when(F.abs(rate_in - rate_out) >= min_gap, "MAR").otherwise("no dependence seen")
        .alias("verdict"))


def quality_checks(df: DataFrame, checks: dict[str, tuple[Column, Column, Column]]) -> DataFrame:
    """Range checks from one aggregate row.

    ``checks`` maps a name to (aggregate, low, high); the result has one row per check with
    the measured value and whether it lies in the range.
    """
    names = list(checks)
    one = df.agg(*[checks[n][0].cast("double").alias(f"v{i}") for i, n in enumerate(names)])
    rows = F.array(*[
        F.struct(
            F.lit(n).alias("check_name"),
            F.round(F.col(f"v{i}"), 6).alias("measured"),
            F.coalesce(F.col(f"v{i}").between(checks[n][1], checks[n][2]), F.lit(False))
            .cast("int").alias("passed"))
        for i, n in enumerate(names)])
    return one.select(F.inline(rows))


def distinct_levels(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def binned_scores(df: DataFrame, bucket: str, score: str, bins: int = 20) -> DataFrame:
    """Score histogram per risk bucket; the top edge belongs to the last bin."""
    index = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(bucket, index.alias("bin")).agg(F.count("*").alias("n"))
