"""One deep forest against the forests of smaller depth that it holds."""

import random

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from orderlens.operators import forests as FO
from orderlens.operators import models as ML
from orderlens.operators import prepare as P
from orderlens.schemas import FeatureSpec


@pytest.fixture(scope="module")
def points(spark):
    rnd = random.Random(3)
    rows = [(i, *(x := [rnd.gauss(0, 1), float(rnd.randint(0, 4)), rnd.random()]),
             int(x[0] + x[2] * x[1] + rnd.gauss(0, 1) > 1), 1.0 + i % 3) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y int, _weight double")
    return df.withColumn("features", array_to_vector(F.array("a", "b", "c"))).repartition(4, "id") \
        .persist()


def test_every_depth_scores_like_a_fit_of_its_own(spark, points, tmp_path):
    depths = [5, 0, 2, 8]
    deep = ML.forest("y", num_trees=7, max_depth=8, seed=5).fit(points)
    deep.write().save(str(tmp_path / "deep"))
    nodes = FO.saved_nodes(spark, str(tmp_path / "deep"))
    got = {r["id"]: r["s"] for r in points.select(
        "id", FO.depth_scores(nodes, depths).alias("s")).collect()}
    for place, depth in enumerate(depths):
        alone = ML.forest("y", num_trees=7, max_depth=depth, seed=5).fit(points)
        want = ML.score_frame(alone, points).select("id", "score").collect()
        assert len(want) == 900
        assert all(got[r["id"]][place] == pytest.approx(r["score"], abs=1e-9) for r in want)


def test_search_fits_each_fold_and_tree_count_once(spark, monkeypatch):
    rnd = random.Random(4)
    rows = [(i, float(a := rnd.randint(0, 9)), rnd.choice("xyz"), int(a + rnd.gauss(0, 3) > 5))
            for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b string, y int")
    spec, grid = FeatureSpec("id", "y", ["a"], ["b"]), {"numTrees": [3, 6], "maxDepth": [1, 4]}
    made, plain = [], ML.forest
    monkeypatch.setattr(ML, "forest", lambda *a, **k: made.append(k) or plain(*a, **k))
    table, best = ML.grid_search(df, "id", spec, grid, 3)
    assert len(made) == 2 * 3  # before: once per depth as well
    assert all(k["max_depth"] == 4 for k in made)
    got = {(r["num_trees"], r["max_depth"], r["fold"]): r for r in table.collect()}
    assert len(got) == 2 * 2 * 3
    folded = P.stratified_folds(df, "id", "y", 3)
    for trees, depth, k in [(3, 1, 0), (6, 4, 2), (6, 1, 1)]:
        part, held = folded.where(F.col("fold") != k), folded.where(F.col("fold") == k)
        prep = P.Preprocessor.fit(part, spec)
        fit_on = prep.transform(part.withColumn("_weight", P.weight_column(part, "y")))
        scored = ML.score_frame(plain("y", num_trees=trees, max_depth=depth).fit(fit_on),
                                prep.transform(held))
        assert got[trees, depth, k]["auc"] == pytest.approx(
            ML.M.roc_auc(scored, label="y").first()["auc"], abs=1e-6)
        assert got[trees, depth, k]["n"] == held.count()
