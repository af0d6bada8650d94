"""Confusion matrix family, all from one (actual, predicted) count table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.functions import scoring as S
from orderlens.session import bounded_rows


def pair_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """The only pass over the predictions."""
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n"))


MAX_CLASSES = 10_000


def all_classes(pairs: DataFrame, classes: list | None = None) -> list:
    """The named classes and every other one the pairs hold, so that no pair is lost."""
    seen = pairs.select(F.explode(F.array("actual", "predicted")).alias("c")).distinct()
    found = {r["c"] for r in bounded_rows(seen, MAX_CLASSES, "classes")}
    extra = sorted(c for c in found - set(classes or []) if c is not None)
    return [*(classes or []), *extra, *([None] if None in found else [])]


def confusion_cells(pairs: DataFrame, classes: list | None = None) -> DataFrame:
    """All k x k cells in long form, zero cells included."""
    spark = pairs.sparkSession
    classes = all_classes(pairs, classes)
    kind = pairs.schema["actual"].dataType.simpleString()
    grid = spark.createDataFrame(
        [(t, p) for t in classes for p in classes], f"actual {kind}, predicted {kind}")
    met = pairs.select(F.col("actual").alias("_a"), F.col("predicted").alias("_p"), "n")
    on = F.col("actual").eqNullSafe(F.col("_a")) & F.col("predicted").eqNullSafe(F.col("_p"))
    return grid.join(met, on, "left").select(
        "actual", "predicted", F.coalesce("n", F.lit(0)).alias("n"))


def confusion_matrix(pairs: DataFrame, classes: list | None = None) -> DataFrame:
    """One row per actual class, one column per predicted class."""
    classes = all_classes(pairs, classes)
    return confusion_cells(pairs, classes).groupBy("actual").pivot(
        "predicted", classes).agg(F.sum("n")).select(
        "actual", *[F.col(str(c)).alias(f"pred_{c}") for c in classes])


def per_class_metrics(pairs: DataFrame, classes: list | None = None) -> DataFrame:
    """Precision, recall, F1 and support of every class, zero where undefined."""
    cells = confusion_cells(pairs, classes)
    both = F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("support"),
                 F.lit(0).cast("bigint").alias("called"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n"))
                 .otherwise(F.lit(0)).alias("tp")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("support"),
                 F.col("n").alias("called"), F.lit(0).cast("bigint").alias("tp")))
    sums = cells.select(F.inline(both)).groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("called").alias("called"),
        F.sum("tp").alias("tp"))
    tp = F.col("tp")
    return sums.select(
        "class",
        F.round(S.guarded_ratio(tp, F.col("called")), 6).alias("precision"),
        F.round(S.guarded_ratio(tp, F.col("support")), 6).alias("recall"),
        F.round(S.guarded_ratio(2 * tp, F.col("called") + F.col("support")), 6).alias("f1"),
        "support")


def classification_report(pairs: DataFrame, classes: list | None = None) -> DataFrame:
    """Accuracy, macro and support-weighted averages."""
    per = per_class_metrics(pairs, classes)
    acc = pairs.agg(S.guarded_ratio(
        F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)),
        F.sum("n")).alias("a"))

    def weighted(c: str):
        return S.guarded_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))

    row = per.agg(
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
        *[weighted(c).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")],
        F.sum("support").alias("support"))
    return row.select(
        F.round(acc.scalar(), 6).alias("accuracy"),
        *[F.round(c, 5).alias(c) for c in row.columns if c != "support"], "support")


def confusion_pairs(pairs: DataFrame, top: int = 6) -> DataFrame:
    """Largest directed confusions; ties go to the smaller (actual, predicted)."""
    return (
        pairs.where((F.col("actual") != F.col("predicted")) & (F.col("n") > 0))
        .orderBy(F.desc("n"), "actual", "predicted").limit(top))


def undirected_pairs(pairs: DataFrame, top: int = 3) -> DataFrame:
    """Both directions of a confusion added up."""
    wrong = pairs.where(F.col("actual") != F.col("predicted"))
    return (
        wrong.groupBy(
            F.least("actual", "predicted").alias("class_a"),
            F.greatest("actual", "predicted").alias("class_b"))
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "class_a", "class_b").limit(top))


def agreement(df: DataFrame, actual: str, predicted: str, name: str = "agrees") -> DataFrame:
    return df.withColumn(name, F.col(predicted).eqNullSafe(F.col(actual)).cast("int"))


def first_per_class(df: DataFrame, label: str, order: str, k: int = 1) -> DataFrame:
    """First k rows per class in the given order; pruned map-side before the shuffle."""
    ranked = df.withColumn(
        "position", F.row_number().over(W.partitionBy(label).orderBy(order)))
    return ranked.where(F.col("position") <= k)
