"""Forests grown tree by tree against Spark's learner and against a plain search of splits."""

import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from orderlens.operators import forests as FO
from orderlens.operators import importance as I
from orderlens.operators import metrics as M
from orderlens.operators import models as ML
from orderlens.operators import prepare as P
from orderlens.operators import trees as TR
from orderlens.plans import models as PM
from orderlens.schemas import FeatureSpec

SPEC = FeatureSpec("id", "y", ["a", "c"], ["b"])


@pytest.fixture(scope="module")
def raw(spark):
    rnd = random.Random(8)
    rows = [(i, rnd.gauss(0, 1), rnd.choice("xyz"), float(rnd.randint(0, 5))) for i in range(1500)]
    rows = [(*r, int(r[1] + (r[2] == "x") * r[3] + rnd.gauss(0, 1) > 1)) for r in rows]
    return spark.createDataFrame(rows, "id long, a double, b string, c double, y int").persist()


def ready(prep, df):
    return prep.transform(df.withColumn("_weight", P.weight_column(df, "y"))).select(
        "id", "y", "features", "_weight")


def test_registered_search_has_every_setting_of_the_reference():
    assert PM.GRID == {"numTrees": [100, 200], "maxDepth": [6, 10, 30]}


def test_search_without_depth_limit_scores_every_setting(spark, raw, monkeypatch):
    made, plain = [], ML.forest
    monkeypatch.setattr(ML, "forest", lambda *a, **k: made.append(k["max_depth"]) or plain(*a, **k))
    table, _ = ML.grid_search(raw, "id", SPEC, {"numTrees": [4, 8], "maxDepth": [3, 30]}, 2)
    assert made == [3] * 4  # the deep forests were not fitted by Spark's learner
    rows = table.collect()
    assert len(rows) == 2 * 2 * 2 and all(0.7 < r["auc"] < 1 for r in rows)
    assert {(r["num_trees"], r["max_depth"]) for r in rows} == {(4, 3), (8, 3), (4, 30), (8, 30)}
    assert sum(r["n"] for r in rows) == 4 * 1500


def test_every_setting_is_near_a_fit_by_spark(spark, raw):
    train, held = raw.where("id % 3 > 0"), raw.where("id % 3 = 0")
    prep = P.Preprocessor.fit(train, SPEC)
    fit_on, check = ready(prep, train), prep.transform(held).select("y", "features")
    got = TR.grid_scores(fit_on, check, "y", [30, 60], [3, 12], 5)
    aucs = {(r["num_trees"], r["max_depth"]): r["auc"] for r in M.roc_auc(
        got, ["num_trees", "max_depth"], label="y").collect()}
    assert len(aucs) == 4 and got.count() == 4 * held.count()
    for (trees, depth), auc in aucs.items():
        alone = ML.forest("y", num_trees=trees, max_depth=depth, seed=5).fit(fit_on)
        want = M.roc_auc(ML.score_frame(alone, check), label="y").first()["auc"]
        assert auc == pytest.approx(want, abs=0.015)
    # Neither other partitions nor a smaller search change a forest.
    again = TR.grid_scores(fit_on.repartition(5, "id"), check, "y", [30], [12], 5)
    assert M.roc_auc(again, label="y").first()["auc"] == pytest.approx(aucs[30, 12], abs=1e-9)


@pytest.mark.parametrize("depth", [0, 2, 30])
def test_saved_forest_scores_and_weighs_as_grown(spark, raw, tmp_path, monkeypatch, depth):
    monkeypatch.setattr(ML, "SPARK_ROWS", 0)
    prep = P.Preprocessor.fit(raw, SPEC)
    model = ML.fit_pipeline(raw, SPEC, prep, 7, depth, 5)
    fitted = model.stages[-1]
    assert (fitted.getNumTrees, fitted.getMaxDepth(), fitted.numFeatures) == (7, depth, 5)
    fit_on = ready(prep, raw)
    grown = TR.grid_scores(fit_on, fit_on, "y", [7], [depth], 5)
    scored = ML.score_frame(model, raw).select("id", "y", "score")
    got, want = (sorted((r["y"], round(r["score"], 9)) for r in df.collect())
                 for df in (scored, grown))
    assert got == want
    # The scores for many rows are those of the model.
    ML.save_model(model, str(tmp_path), {})
    fast = ML.many_scores(str(tmp_path))(PipelineModel.load(f"{tmp_path}/model"), raw)
    assert ML.same_scores(fast.select("id", "y", "score"), scored, ["id"])
    weights = I.impurity_by_source(ML.impurity_importances(fitted, prep.names())).collect()
    if depth:
        assert sum(r["impurity_importance"] for r in weights) == pytest.approx(1, abs=1e-5)


def test_many_scores_of_a_fit_by_spark(spark, raw, tmp_path):
    raw = raw.withColumn("a", F.when(F.col("id") % 7 == 0, F.lit(float("nan"))).otherwise(
        F.col("a")))
    vectors = raw.select("id", "y", array_to_vector(F.array("a", "c")).alias("features"),
                         F.lit(1.0).alias("_weight"))
    model = ML.forest("y", num_trees=6, max_depth=6).fit(vectors.where("id % 7 > 0"))
    model.write().save(str(tmp_path / "m"))
    nodes = FO.saved_nodes(spark, str(tmp_path / "m"))
    got = vectors.select("id", FO.forest_scores(nodes).alias("score"))
    assert ML.same_scores(got, ML.score_frame(model, vectors).select("id", "score"), ["id"])


def test_every_split_is_the_best_one():
    rnd = np.random.default_rng(2)
    cells = rnd.integers(0, 6, (3, 400)).astype(np.uint8)
    label = (cells[0] + rnd.integers(0, 5, 400) > 5).astype(np.uint8)
    weights = (0.7, 2.5)
    # One feature, so that every node tries it.
    tree = TR.grow(TR.Rows(cells[:1], label), weights, 1, 0, 3)
    bag = np.random.default_rng([1, 0]).poisson(1.0, 400)

    def impurity(rows):
        a, b = ((bag[rows] * (label[rows] == y)).sum() * weights[y] for y in (0, 1))
        return (1 - (a * a + b * b) / (a + b) ** 2 if a + b else 0.0), a + b

    def visit(node, rows):
        assert tree.ones[node] == bag[rows][label[rows] == 1].sum()
        assert tree.zeros[node] == bag[rows][label[rows] == 0].sum()
        if tree.left[node] < 0:
            return 1
        gains = []
        for cut in range(5):
            left = cells[0][rows] <= cut
            (i, n), (il, nl), (ir, nr) = (impurity(rows[k]) for k in (left | True, left, ~left))
            gains.append(i - (nl * il + nr * ir) / n)
        assert tree.gain[node] == pytest.approx(max(gains))
        left = cells[0][rows] <= tree.cut[node]
        return visit(tree.left[node], rows[left]) + visit(tree.left[node] + 1, rows[~left])

    assert visit(0, np.arange(400)) > 3


def test_cut_points_follow_the_weight():
    x = np.arange(1000.0)
    ones = (x >= 500).astype(np.int64)
    few = TR._cuts(np.array([3.0, 1.0, 2.0]), np.ones(3), np.ones(3), (1.0, 1.0))
    assert few.tolist() == [1.5, 2.5]
    even = TR._cuts(x, 1 - ones, ones, (1.0, 1.0))
    assert len(even) == 31 and np.allclose(np.diff(even), 31.25, atol=1)
    heavy = TR._cuts(x, 1 - ones, ones, (1.0, 9.0))
    assert (heavy > 500).sum() == pytest.approx(0.9 * 32, abs=2)


def test_a_forest_beyond_the_heap_is_a_plain_error(raw, monkeypatch):
    monkeypatch.setattr(ML, "SPARK_ROWS", 0)
    monkeypatch.setattr(ML, "BYTES_A_NODE", 2**60)
    with pytest.raises(ValueError, match="give the driver more memory"):
        ML.fit_pipeline(raw, SPEC, P.Preprocessor.fit(raw, SPEC), 2, 2, 5)
