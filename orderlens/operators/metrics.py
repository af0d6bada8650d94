"""Threshold sweeps, AUC, subgroup analysis and accuracy from one scored frame.

Everything is derived from a small count table (threshold step x group), so the cost is one
pass over the scores with map-side aggregation, not one pass per threshold or per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens import constants as C
from orderlens.functions import scoring as S
from orderlens.operators.ordering import BEFORE, exact_positions

SMALL_TIE = 1_000_000


def score_cube(df: DataFrame, dims: list[str] | None = None, score: str = "score",
               label: str = C.TARGET) -> DataFrame:
    """Counts per (dims, grid step): the only pass over the scored rows."""
    return df.groupBy(*(dims or []), S.grid_index(F.col(score)).alias("step")).agg(
        F.count("*").alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos"))


def _partition(by: list[str]):
    return W.partitionBy(*by) if by else W.partitionBy(F.lit(0))


def sweep(cube: DataFrame, by: list[str] | None = None) -> DataFrame:
    """All 41 thresholds with confusion counts, per group of the cube.

    ``by`` must be a subset of the cube's dimensions; the others are folded away first.
    """
    by = by or []
    folded = cube.groupBy(*by, "step").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    # At most 42 entries per group (41 steps and the rows below the grid), so a group fits
    # in one row and the cumulative counts need neither a window nor a join.
    groups = folded.groupBy(*by).agg(
        F.sum("n").alias("n_all"), F.sum("pos").alias("pos_all"),
        F.collect_list(F.struct("step", "n", "pos")).alias("_e"))
    steps = groups.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(C.GRID_POINTS - 1))))

    def reaching(name: str) -> Column:
        kept = F.filter("_e", lambda e: e["step"] >= F.col("step"))
        return F.aggregate(kept, F.lit(0).cast("bigint"), lambda acc, e: acc + e[name])

    counted = steps.select(
        *by, "step", "n_all", "pos_all", reaching("n").alias("n_flagged"),
        reaching("pos").alias("tp"))
    tp, fp = F.col("tp"), F.col("n_flagged") - F.col("tp")
    fn = F.col("pos_all") - F.col("tp")
    tn = F.col("n_all") - F.col("pos_all") - fp
    return counted.select(
        *by, S.grid_value(F.col("step")).alias("threshold"),
        F.round(S.precision(tp, fp), 6).alias("precision"),
        F.round(S.recall(tp, fn), 6).alias("recall"),
        F.round(S.f1(tp, fp, fn), 6).alias("f1"),
        "n_flagged", "tp", fp.alias("fp"), fn.alias("fn"), tn.alias("tn"),
        F.round(S.guarded_ratio(tp + tn, F.col("n_all")), 6).alias("accuracy"))


def best_threshold(swept: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Row of maximum F1 per group; the lowest threshold wins ties."""
    fields = [c for c in swept.columns if c not in (by or [])]
    return (
        swept.groupBy(*(by or []))
        .agg(F.max_by(F.struct(*fields), F.struct("f1", -F.col("threshold"))).alias("b"))
        .select(*(by or []), "b.*"))


def sweep_delta(swept: DataFrame, low: float, high: float) -> DataFrame:
    """Change from threshold ``low`` to ``high`` in percentage points."""
    def at(t: float, name: str) -> Column:
        return F.max(F.when(F.col("threshold") == t, F.col(name)))

    return swept.agg(*[
        F.round((at(high, m) - at(low, m)) * 100, 4).alias(f"{m}_delta_pp")
        for m in ("precision", "recall", "f1", "accuracy")])


def every_nth(swept: DataFrame, n: int = 2) -> DataFrame:
    """Systematic sample of an ordered report table, first row included."""
    ranked = swept.withColumn(
        "_r", F.row_number().over(W.partitionBy(F.lit(0)).orderBy("threshold")))
    return ranked.where((F.col("_r") - 1) % n == 0).drop("_r")


def class1_metrics(df: DataFrame, predicted: str, label: str = C.TARGET) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1, zero where undefined."""
    y, p = F.col(label), F.col(predicted)
    counts = df.agg(
        F.count("*").alias("n"),
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "n", "tp", "fp", "fn", "tn",
        F.round(S.guarded_ratio(tp + tn, F.col("n")), 6).alias("accuracy"),
        F.round(S.precision(tp, fp), 6).alias("precision"),
        F.round(S.recall(tp, fn), 6).alias("recall"),
        F.round(S.f1(tp, fp, fn), 6).alias("f1"))


def roc_auc(df: DataFrame, by: list[str] | None = None, score: str = "score",
            label: str = C.TARGET) -> DataFrame:
    """Exact ROC-AUC with average ranks for ties, for scores in [0, 1].

    Equal scores are counted together first, so a value that a third of the rows share is
    one row. The pair count is then built over three levels (score, 2**-20 wide cells,
    2**-10 wide cells): each level adds, for the negatives before a cell, positives inside
    it. Only the last window has one group, and that group has at most 1025 rows. Pair
    counts are whole numbers in doubles: exact to 2**53 pairs, and to 15 digits beyond.
    """
    by = by or []
    y, s = F.col(label), F.col(score)
    distinct = df.groupBy(*by, s.alias("_s")).agg(
        F.sum(y.cast("bigint")).alias("pos"), F.sum((1 - y).cast("bigint")).alias("neg"))
    cells = distinct.select(
        *by, "_s", "pos", "neg",
        F.floor(F.col("_s") * 1024).alias("_c1"), F.floor(F.col("_s") * 1048576).alias("_c2"))

    def below(window) -> Column:
        return F.coalesce(F.sum("neg").over(window.rowsBetween(*BEFORE)), F.lit(0))

    # Twice the pairs won: 2 * (negatives below) + (negatives tied), for every positive.
    pos = F.col("pos").cast("double")
    fine = cells.withColumn("won", pos * (2 * below(
        W.partitionBy(*by, "_c1", "_c2").orderBy("_s")) + F.col("neg")))
    for outer, order in ((["_c1"], "_c2"), ([], "_c1")):
        level = fine.groupBy(*by, *outer, order).agg(
            F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("won").alias("inner"))
        window = _partition([*by, *outer]).orderBy(order)
        fine = level.withColumn("won", F.col("inner") + pos * 2 * below(window))
    return _auc_of(fine, by)


def auc_of_cells(cells: DataFrame, by: list[str]) -> DataFrame:
    """AUC from counts per cell of the score: ``cell`` (in the order of the scores), pos, neg and
    inner, twice the pairs won inside the cell. For few cells in a group."""
    below = F.coalesce(F.sum("neg").over(
        _partition(by).orderBy("cell").rowsBetween(*BEFORE)), F.lit(0))
    return _auc_of(cells.withColumn(
        "won", F.col("inner") + F.col("pos").cast("double") * 2 * below), by)


def _auc_of(won: DataFrame, by: list[str]) -> DataFrame:
    total = won.groupBy(*by).agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
        F.sum("won").alias("won"))
    pairs = 2.0 * F.col("positives").cast("double") * F.col("negatives").cast("double")
    return total.select(
        *by, "positives", "negatives", F.round(F.try_divide("won", pairs), 6).alias("auc"))


def subgroup_metrics(cube: DataFrame, dims: list[str], threshold: float) -> DataFrame:
    """Confusion counts and metrics per level of every dimension, at one threshold.

    The threshold must lie on the grid; both dimensions come from the same cube.
    """
    hit = S.grid_value(F.col("step")) >= threshold
    levels = F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(d).alias("subgroup")) for d in dims])
    table = (
        cube.select(F.explode(levels).alias("g"), "step", "n", "pos")
        .groupBy("g.dimension", "g.subgroup")
        .agg(
            F.sum("n").alias("n_test"), F.sum("pos").alias("actual_returns"),
            F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("flagged"),
            F.coalesce(F.sum(F.when(hit, F.col("pos"))), F.lit(0)).alias("tp")))
    tp = F.col("tp")
    fp, fn = F.col("flagged") - tp, F.col("actual_returns") - tp
    return table.select(
        "dimension", "subgroup", "n_test", "actual_returns", "flagged", "tp",
        fp.alias("fp"), fn.alias("fn"),
        F.round(S.precision(tp, fp), 6).alias("precision"),
        F.round(S.recall(tp, fn), 6).alias("recall"),
        F.round(S.f1(tp, fp, fn), 6).alias("f1"))


def subgroup_thresholds(cube: DataFrame, dims: list[str], threshold: float,
                        min_support: int = C.MIN_SUPPORT) -> DataFrame:
    """Recall gap of every well-supported subgroup, its own best threshold, and what moving
    there would recover. ``weakest`` marks the largest gap."""
    global_rows = cube.groupBy("step").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    hit = S.grid_value(F.col("step")) >= threshold
    overall = global_rows.agg(
        S.guarded_ratio(F.coalesce(F.sum(F.when(hit, F.col("pos"))), F.lit(0)), F.sum("pos"))
        .alias("r"))
    levels = F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(d).alias("subgroup")) for d in dims])
    long = cube.select(
        F.explode(levels).alias("g"), "step", "n", "pos").select("g.*", "step", "n", "pos")
    own = best_threshold(sweep(long, ["dimension", "subgroup"]), ["dimension", "subgroup"])
    table = subgroup_metrics(cube, dims, threshold).where(F.col("n_test") >= min_support)
    joined = table.join(
        own.select("dimension", "subgroup", F.col("threshold").alias("local_threshold"),
                   F.col("n_flagged").alias("local_flagged"), F.col("tp").alias("local_tp"),
                   F.col("f1").alias("local_f1"), F.col("recall").alias("local_recall")),
        ["dimension", "subgroup"])
    gap = overall.scalar() - S.recall(F.col("tp"), F.col("fn"))
    ranked = joined.withColumn("gap", gap).withColumn(
        "_r", F.row_number().over(
            W.partitionBy(F.lit(0)).orderBy(F.desc("gap"), "dimension", "subgroup")))
    return ranked.select(
        "dimension", "subgroup", "n_test", "actual_returns", "flagged", "tp", "recall",
        F.round("gap", 6).alias("recall_gap"),
        (F.col("gap") >= C.MATERIAL_GAP).cast("int").alias("material"),
        (F.col("_r") == 1).cast("int").alias("weakest"),
        "local_threshold", "local_f1", "local_recall", "local_flagged",
        (F.col("local_flagged") - F.col("flagged")).alias("extra_flagged"),
        (F.col("local_tp") - F.col("tp")).alias("recovered"))


def quantile_rows(df: DataFrame, identifier: str, score: str = "score") -> DataFrame:
    """The rows at sorted positions 0, n/4, n/2, 3n/4 and n-1 by (score, id)."""
    spots = [("min", lambda n: 0), ("q1", lambda n: n // 4), ("median", lambda n: n // 2),
             ("q3", lambda n: 3 * n // 4), ("max", lambda n: n - 1)]
    found = exact_positions(df, {score: [f for _, f in spots]})[score]
    picks, small = [], []
    for (name, _), (value, offset, ties) in zip(spots, found):
        if ties > SMALL_TIE:
            tied = df.where(F.col(score) == value)
            (ident, _, _), = exact_positions(tied, {identifier: [offset]})[identifier]
            picks.append((name, int(ident), float(value)))
        else:
            small.append((name, float(value), offset + 1))
    table = df.sparkSession.createDataFrame(
        picks, f"pick string, {identifier} bigint, {score} double")
    if not small:
        return table
    wanted = df.sparkSession.createDataFrame(
        small, f"pick string, {score} double, _r int")
    tied = df.where(F.col(score).isin(sorted({v for _, v, _ in small})))
    ranked = tied.select(identifier, score, F.row_number().over(
        W.partitionBy(score).orderBy(identifier)).alias("_r"))
    return table.unionByName(ranked.join(F.broadcast(wanted), [score, "_r"]).select(
        "pick", identifier, score))


def compare_results(fresh: DataFrame, stored: DataFrame, key: list[str], value: str,
                    tolerance: float = 1e-9) -> DataFrame:
    """Recomputed against stored values, matched on the key; a missing side never agrees."""
    a = fresh.select(*key, F.col(value).alias("fresh"))
    b = stored.select(*key, F.col(value).alias("stored"))
    agrees = F.abs(F.col("fresh") - F.col("stored")) <= tolerance
    return a.join(b, key, "full").withColumn(
        "agrees", F.coalesce(agrees, F.lit(False)).cast("int"))


def fold_summary(folds: DataFrame, setting: list[str], metric: str = "auc") -> DataFrame:
    """Mean and population standard deviation over folds, per setting."""
    return folds.groupBy(*setting).agg(
        F.round(F.avg(metric), 6).alias(f"mean_{metric}"),
        F.round(F.stddev_pop(metric), 6).alias(f"std_{metric}"))
