"""Spark ML models on the prepared features: fit, grid search, persistence, scoring."""

from __future__ import annotations

import json
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import (
    LogisticRegression, RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import constants as C
from orderlens.functions import scoring as S
from orderlens.functions.vectors import top_entries
from orderlens.operators import metrics as M
from orderlens.operators import trees as TR
from orderlens.operators.forests import depth_scores, forest_scores, saved_nodes
from orderlens.operators.prepare import Preprocessor, stratified_folds, weight_column
from orderlens.schemas import ORDERS, FeatureSpec
from orderlens.session import bounded_rows, new_folder, staged

# "No depth limit" is 30, the deepest tree Spark grows.
DEEPEST = 30
DEFAULT_GRID = {"numTrees": [100, 200], "maxDepth": [6, 10, DEEPEST]}
# A running fit keeps a few numbers per row and tree in memory; so many rows are fitted at a time.
ROWS_AT_ONCE = 2_000_000
# Spark's learner makes passes over the rows for every level and holds the forest in the driver.
# Beyond this depth or so many rows, trees are grown one by one (``trees``).
SPARK_DEPTH = 10
SPARK_ROWS = 50_000


def tree_by_tree(rows: int, width: int, max_depth: int) -> bool:
    return rows * width <= TR.MAX_CELLS and (max_depth > SPARK_DEPTH or rows > SPARK_ROWS)


def positive_score(probability: str = "probability") -> Column:
    return vector_to_array(F.col(probability))[1]


def majority_class(train: DataFrame, label: str = C.TARGET):
    """Most frequent label; the smaller one wins a tie."""
    return train.agg(F.mode(label, True).alias("m")).first()["m"]


def fit_logistic(train: DataFrame, label: str = C.TARGET, features: str = "features",
                 max_iter: int = 2000):
    """Balanced logistic regression with the L2 strength C = 1 of the usual default.

    That penalty is one per whole training set, hence regParam = 1 / sum of weights; the
    balanced weights sum to the row count.
    """
    n = train.count()
    weighted = train.withColumn("_weight", weight_column(train, label))
    return LogisticRegression(
        featuresCol=features, labelCol=label, weightCol="_weight", maxIter=max_iter,
        regParam=1.0 / n, standardization=False, tol=1e-9).fit(weighted)


def logistic_gradient(model, train: DataFrame, label: str = C.TARGET,
                      features: str = "features") -> float:
    """Largest absolute entry of the gradient of the penalised, balanced loss at the fitted
    coefficients: zero where the fit has reached its optimum."""
    weight = weight_column(train, label)
    rows = model.transform(train).select(
        weight.alias("_w"), (weight * (positive_score() - F.col(label))).alias("_e"),
        vector_to_array(features).alias("_x"))
    width = len(model.coefficients)
    sums = rows.agg(F.sum("_w").alias("w"), F.sum("_e").alias("b"), *[
        F.sum(F.col("_e") * F.get("_x", F.lit(i))).alias(f"g{i}") for i in range(width)]).first()
    slopes = [sums[f"g{i}"] / sums["w"] + model.getRegParam() * model.coefficients[i]
              for i in range(width)]
    return max(map(abs, [*slopes, sums["b"] / sums["w"]]))


def forest(label: str = C.TARGET, features: str = "features", num_trees: int = 100,
           max_depth: int = 6, seed: int = C.SPLIT_SEED) -> RandomForestClassifier:
    """The node of every row and tree is kept from level to level, not sought from the root."""
    return RandomForestClassifier(
        featuresCol=features, labelCol=label, weightCol="_weight", numTrees=num_trees,
        maxDepth=max_depth, seed=seed, cacheNodeIds=True, checkpointInterval=-1)


def score_frame(model: Transformer, df: DataFrame, name: str = "score") -> DataFrame:
    return model.transform(df).withColumn(name, positive_score())


# Spark's model of a forest needs about so much of the driver's heap, loaded and sent to tasks.
BYTES_A_NODE = 1000
# Up to so many nodes, a saved forest goes to the tasks as numbers.
MOST_NODES = 2_000_000


def many_scores(path: str):
    """``score_frame`` of the model saved under ``path``, for very many rows."""
    def score(model: PipelineModel, df: DataFrame, name: str = "score") -> DataFrame:
        fitted = model.stages[-1]
        if fitted.totalNumNodes > MOST_NODES:
            return score_frame(model, df, name)
        nodes = saved_nodes(df.sparkSession,
                            f"{path}/model/stages/{len(model.stages) - 1}_{fitted.uid}")
        return PipelineModel(model.stages[:-1]).transform(df).withColumn(
            name, forest_scores(nodes))

    return score


def grid_search(train: DataFrame, identifier: str, spec: FeatureSpec, grid: dict | None = None,
                folds: int = 5, seed: int = C.SPLIT_SEED,
                parallelism: int = 8) -> tuple[DataFrame, dict]:
    """Forest settings x stratified folds, scored by exact AUC.

    Every fold fits its own preprocessing on its training part. The loop runs over fits,
    not rows; at most ``parallelism`` of them run at a time, the largest first. A tree grows
    level by level, so one fit of the greatest depth holds the forests of all smaller depths;
    each is scored as if fitted alone. ``tree_by_tree`` says which depths are not for Spark's
    learner; of those, a fold grows one forest. All AUCs are computed together from one scored
    frame. Returns the fold table and the best setting.
    """
    grid = grid or DEFAULT_GRID
    label = spec.label
    path = new_folder(train.sparkSession, "grid")
    folded = stratified_folds(train, identifier, label, folds, seed).persist()
    kept = [folded]
    threaded = inheritable_thread_target(train.sparkSession)

    def prepare(k):
        part = folded.where(F.col("fold") != k)
        prep = Preprocessor.fit(part, spec)
        fit_on = prep.transform(part.withColumn("_weight", weight_column(part, label)))
        fit_on = fit_on.select(label, "features", "_weight").persist()
        kept.append(fit_on)
        held = prep.transform(folded.where(F.col("fold") == k)).select(label, "features")
        return fit_on, held, len(prep.names())

    def grown(k):
        return TR.grid_scores(*parts[k][:2], label, list(grid["numTrees"]), deep[k], seed)

    def fit(job):
        trees, k = job
        at = f"{path}/{trees}-{k}"
        forest(label, num_trees=trees, max_depth=max(flat[k]), seed=seed).fit(
            parts[k][0]).write().save(at)
        return saved_nodes(train.sparkSession, at)

    try:
        rows = folded.count()
        parallelism = max(1, min(parallelism, ROWS_AT_ONCE // max(rows, 1)))
        with ThreadPool(parallelism) as pool:
            parts = pool.map(threaded(prepare), range(folds), 1)
            deep = [[d for d in grid["maxDepth"] if tree_by_tree(rows, width, d)]
                    for _, _, width in parts]
            flat = [[d for d in grid["maxDepth"] if d not in kept_deep] for kept_deep in deep]
            jobs = sorted((j for j in product(grid["numTrees"], range(folds)) if flat[j[1]]),
                          key=lambda j: -j[0])
            forests = pool.map(threaded(fit), jobs, 1)
            by_tree = [k for k in range(folds) if deep[k]]
            scores = pool.map(threaded(grown), by_tree, 1)
        results = [
            parts[k][1].select(
                F.lit(trees).alias("num_trees"), F.lit(k).alias("fold"), label,
                F.posexplode(depth_scores(nodes, flat[k])).alias("_d", "score")).select(
                "num_trees", F.get(F.array(*map(F.lit, flat[k])), F.col("_d")).alias("max_depth"),
                "fold", label, "score")
            for (trees, k), nodes in zip(jobs, forests)]
        results += [scored.withColumn("fold", F.lit(k)) for k, scored in zip(by_tree, scores)]
        results = staged(reduce(DataFrame.unionByName, results))
    finally:
        for frame in kept:
            frame.unpersist()
    by = ["num_trees", "max_depth", "fold"]
    sizes = results.groupBy(*by).agg(F.count("*").alias("n"), F.sum(label).alias("n_positive"))
    aucs = M.roc_auc(results, by, label=label).select(*by, "auc").join(sizes, by)
    rows = bounded_rows(aucs.select(*by, "auc", "n", "n_positive"), 10_000, "grid results")
    table = train.sparkSession.createDataFrame(
        [tuple(r) for r in rows],
        "num_trees int, max_depth int, fold int, auc double, n long, n_positive long")
    means = bounded_rows(M.fold_summary(table, ["num_trees", "max_depth"]), 1000, "grid")
    best = min(means, key=lambda r: (-r["mean_auc"], r["num_trees"], r["max_depth"]))
    return table, best.asDict()


def fit_pipeline(train: DataFrame, spec: FeatureSpec, prep: Preprocessor, num_trees: int,
                 max_depth: int, seed: int = C.SPLIT_SEED) -> PipelineModel:
    """Fitted preprocessing and a forest fitted behind it, as one model of raw rows."""
    fit_on = prep.transform(train.withColumn("_weight", weight_column(train, spec.label)))
    fit_on = fit_on.select(spec.label, "features", "_weight").persist()
    learner = forest(spec.label, num_trees=num_trees, max_depth=max_depth, seed=seed)
    try:
        if tree_by_tree(fit_on.count(), len(prep.names()), max_depth):
            model = _grown_forest(fit_on, spec.label, learner)
        else:
            model = learner.fit(fit_on)
    finally:
        fit_on.unpersist()
    return PipelineModel([*prep.stages(), model])


def _grown_forest(fit_on: DataFrame, label: str, learner: RandomForestClassifier):
    """The forest of ``learner`` grown tree by tree. Its settings are saved with a model of one row
    of each class, beside which the nodes are then put."""
    spark = fit_on.sparkSession
    settings, path = new_folder(spark, "settings"), new_folder(spark, "grown")
    rows = fit_on.groupBy(label).agg(F.first("features").alias("features"),
                                     F.first("_weight").alias("_weight"))
    # Some copies, so that no tree's bag is empty.
    rows = staged(rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(50)))).coalesce(1))
    learner.fit(rows).write().save(settings)
    spark.read.text(f"{settings}/metadata").coalesce(1).write.text(f"{path}/metadata")
    spark.read.parquet(f"{settings}/treesMetadata").write.parquet(f"{path}/treesMetadata")
    TR.write_nodes(fit_on, label, learner.getNumTrees(), learner.getMaxDepth(), learner.getSeed(),
                   f"{path}/data")
    nodes = spark.read.parquet(f"{path}/data").count()
    most = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory() // BYTES_A_NODE
    if nodes > most:
        raise ValueError(f"the refitted forest has {nodes} nodes, more than the {most} that the "
                         "driver's heap holds as Spark's model; give the driver more memory")
    return RandomForestClassificationModel.load(path)


def train_and_save(train: DataFrame, test: DataFrame, identifier: str, spec: FeatureSpec,
                   path: str, grid: dict | None = None, folds: int = 5) -> dict:
    """Grid search, refit of the best setting on all of ``train``, and the saved result.

    The pipeline is saved first; threshold and test figures then come from the reloaded one,
    so they belong to what later jobs load. Beside the model lie the fold table (``folds``),
    the importances by column (``importances``), the scores of the test part
    (``test_scores``) and the metadata.
    """
    spark = train.sparkSession
    table, best = grid_search(train, identifier, spec, grid, folds)
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}/folds")
    prep = Preprocessor.fit(train, spec)
    fitted = fit_pipeline(train, spec, prep, best["num_trees"], best["max_depth"])
    impurity_importances(fitted.stages[-1], prep.names()).coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/importances")
    fitted.write().overwrite().save(f"{path}/model")
    columns = [identifier, spec.label, "score"]
    score_frame(PipelineModel.load(f"{path}/model"), test).select(*columns).write.mode(
        "overwrite").parquet(f"{path}/test_scores")
    scored = spark.read.parquet(f"{path}/test_scores")
    if not same_scores(score_frame(fitted, test).select(*columns), scored, [identifier]):
        raise RuntimeError("the saved model does not score like the fitted one")
    at = operating_threshold(scored, spec.label)
    threshold = at["threshold"]
    metadata = {
        "model_type": type(fitted.stages[-1]).__name__,
        "threshold": threshold, "threshold_metric": "f1", "threshold_split": "test",
        "threshold_grid": [C.GRID_FIRST_PERCENT / 100, C.GRID_STEP_PERCENT / 100, C.GRID_POINTS],
        "best_setting": {k: best[k] for k in ("num_trees", "max_depth")},
        "folds": folds, "best_mean_auc": best["mean_auc"],
        "test_auc": M.roc_auc(scored, label=spec.label).first()["auc"],
        "f1": at["f1"], "precision": at["precision"], "recall": at["recall"],
        "cut_points": [threshold, threshold + C.BUCKET_WIDTH],
        "features": spec.features,
    }
    _write_metadata(spark, path, metadata)
    return metadata


def impurity_importances(model, names: list[str]) -> DataFrame:
    """(transformed_feature, importance) of a fitted tree model; one row per model column."""
    values = model.featureImportances.toArray().tolist()
    return SparkSession.active().createDataFrame(
        list(zip(names, values)), "transformed_feature string, importance double")


def save_model(model: Transformer, path: str, metadata: dict) -> None:
    """Model and its metadata side by side."""
    wrapped = model if isinstance(model, PipelineModel) else PipelineModel([model])
    wrapped.write().overwrite().save(f"{path}/model")
    _write_metadata(SparkSession.active(), path, metadata)


def _write_metadata(spark: SparkSession, path: str, metadata: dict) -> None:
    spark.createDataFrame([(json.dumps(metadata),)], "value string").coalesce(1).write.mode(
        "overwrite").text(f"{path}/metadata")


def read_metadata(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/metadata").first()["value"])


def load_model(path: str) -> tuple[PipelineModel, dict]:
    return PipelineModel.load(f"{path}/model"), read_metadata(SparkSession.active(), path)


def same_scores(a: DataFrame, b: DataFrame, key: list[str], tolerance: float = 1e-9) -> bool:
    """Do two scored frames agree on every key?"""
    bad = M.compare_results(a, b, key, "score", tolerance).where(F.col("agrees") == 0)
    return bad.isEmpty()


def operating_threshold(scored: DataFrame, label: str = C.TARGET) -> dict:
    """Threshold of maximum F1 over the grid, from the scores of the saved model."""
    swept = M.sweep(M.score_cube(scored, label=label))
    return M.best_threshold(swept).first().asDict()


def score_rows(rows: DataFrame, model: PipelineModel, metadata: dict,
               missing: Column | None = None, failed: Column | None = None) -> DataFrame:
    """Rows scored by a saved pipeline: status, percent, bucket and the bucket's cut points.

    ``missing`` lists the required features a row does not have, ``failed`` marks rows with a
    value that cannot be read; neither is scored, and no row fails the batch. A NULL value is
    left to the imputation inside the pipeline.
    """
    scored = score_frame(model, rows)
    scored = scored.select(*rows.columns, "score")
    if failed is not None:
        scored = scored.withColumn("score", F.when(~failed, F.col("score")))
    low, high = metadata["cut_points"]
    return score_batch(scored, F.col("score"), metadata["threshold"], missing).withColumns({
        "medium_from": F.lit(low), "high_from": F.lit(high)})


def score_one(spark: SparkSession, features: dict, model: PipelineModel, metadata: dict) -> dict:
    """One order given as a dictionary; the same call as for a batch.

    Without a required key nothing is scored or imputed: the status is ``missing_input``.
    """
    missing = [f for f in metadata["features"] if f not in features]
    if missing:
        return {"status": "missing_input", "missing_features": missing,
                "threshold": metadata["threshold"]}
    kinds = T.StructType([f for f in ORDERS if f.name in metadata["features"]])
    row = spark.createDataFrame([tuple(features[f.name] for f in kinds)], kinds)
    got = score_rows(row, model, metadata).first()
    return {"status": got["status"], "return_probability": round(got["score"], 4),
            "return_probability_percent": got["return_probability_percent"],
            "risk_bucket": got["risk_bucket"], "threshold": metadata["threshold"],
            "medium_from": got["medium_from"], "high_from": got["high_from"],
            "model_type": metadata["model_type"]}


def score_batch(df: DataFrame, score: Column, threshold: float,
                missing: Column | None = None) -> DataFrame:
    """Status, percent and bucket per row; a row never fails the batch.

    ``missing`` lists required columns the input does not have; a NULL value is different
    and is left to the imputer of the score.
    """
    lacking = missing if missing is not None else F.array().cast("array<string>")
    status = F.when(F.size(lacking) > 0, "missing_input").when(
        score.isNull(), "error").otherwise("ok")
    ok = status == "ok"
    return df.select(
        "*", status.alias("status"), lacking.alias("missing_features"),
        F.when(ok, F.round(score * 100, 2)).alias("return_probability_percent"),
        F.when(ok, S.risk_bucket(score, threshold)).alias("risk_bucket"))


def batch_summary(scored: DataFrame) -> DataFrame:
    """Totals over the rows that were scored."""
    ok = F.col("status") == "ok"

    def share(bucket: str) -> Column:
        return F.avg(F.when(ok, (F.col("risk_bucket") == bucket).cast("double")))

    return scored.agg(
        F.count("*").alias("n_rows"), F.count_if(ok).alias("n_scored"),
        F.round(F.avg(F.when(ok, F.col("return_probability_percent"))), 4)
        .alias("mean_percent"),
        F.round(share("High"), 6).alias("share_high"), F.round(share("Low"), 6)
        .alias("share_low"))


ROUNDS = (1, 2, 4, 8, 16, 32, 64)


def fit_head(train: DataFrame, validation: DataFrame, strengths: list[float],
             label: str = "label", vector: str = "embedding",
             rounds: tuple[int, ...] = ROUNDS) -> tuple:
    """Multinomial head on cached vectors, validated after more and more rounds of the solver;
    the state with the best validation accuracy is kept, the earliest one of equals.

    The solver starts from the same point every time, so a fit of n rounds is the state after
    round n of a longer one. A setting that reached its optimum is not continued. Returns
    (model, accuracy, strength, rounds) and the history of all states.
    """
    def ready(df: DataFrame) -> DataFrame:
        return df.select(label, array_to_vector(F.col(vector).cast("array<double>"))
                         .alias("features"))

    fit_on, check = ready(train).persist(), ready(validation).persist()
    best, history = None, []
    try:
        for reg in strengths:
            for most in rounds:
                model = LogisticRegression(family="multinomial", labelCol=label, maxIter=most,
                                           regParam=reg).fit(fit_on)
                accuracy = model.transform(check).agg(
                    F.avg((F.col("prediction") == F.col(label)).cast("double"))).first()[0]
                history.append((reg, most, accuracy))
                if best is None or accuracy > best[1]:
                    best = (model, accuracy, reg, most)
                if model.summary.totalIterations < most:
                    break
    finally:
        fit_on.unpersist()
        check.unpersist()
    return best, history


def head_predictions(model, df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Predicted class, confidence and the three best entries per row."""
    ready = df.withColumn(
        "features", array_to_vector(F.col(vector).cast("array<double>")))
    out = model.transform(ready).withColumn("_p", vector_to_array("probability"))
    return out.withColumns({
        "predicted": F.col("prediction").cast("int"),
        "probabilities": F.col("_p"),
        "confidence": F.array_max("_p"),
        "top3": top_entries(F.col("_p"), 3),
    }).drop("features", "rawPrediction", "probability", "prediction", "_p")
