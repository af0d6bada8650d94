"""Models that score raw rows: saved preprocessing, search and refit, batch and single scoring."""

import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from orderlens import constants as C
from orderlens.operators import models as ML
from orderlens.operators import prepare as P
from orderlens.schemas import ORDERS, FeatureSpec
from orderlens.sources import readers as IN

SPEC = FeatureSpec()
NAMES = [f.name for f in ORDERS]


def orders(spark, n, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        cod = rnd.random() < 0.4
        rows.append((
            i, rnd.choice(C.PRODUCT_CATEGORIES), float(rnd.randint(100, 5000)),
            rnd.randint(0, 75) * 1.0, "COD" if cod else "Prepaid_UPI", rnd.randint(1, 2500),
            rnd.randint(0, 20), rnd.randint(0, 3), rnd.random() * 2000, rnd.randint(1, 21),
            rnd.randint(0, 1), rnd.choice([None, 1.0, 3.0, 5.0]),
            int(rnd.random() < (0.6 if cod else 0.1))))
    return spark.createDataFrame(rows, ORDERS)


@pytest.fixture(scope="module")
def saved(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("forest"))
    parts = P.stratified_split(orders(spark, 500), "order_id", "returned").persist()
    train, test = (parts.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    meta = ML.train_and_save(train, test, "order_id", SPEC, path,
                             {"numTrees": [5, 10], "maxDepth": [2, 4]}, 5)
    yield path, meta, train, test
    parts.unpersist()


def test_saved_columns_equal_the_preprocessing(spark, tmp_path):
    odd = ["it's", 'a "b"', "back\\slash", "new\nline", "ünï 🙂", "", "50%", "a.b`c", "plain"]
    rows = [(i, odd[i % len(odd)], [1.5, None, 2.0, float(i), 1e-17][i % 5], None, i % 2)
            for i in range(60)] + [(99, None, None, None, 1), (98, "unseen later", 3.0, None, 0)]
    kinds = "id bigint, level string, x double, empty double, y int"
    df = spark.createDataFrame(rows, kinds)
    spec = FeatureSpec("id", "y", ["x"], ["level"])
    prep = P.Preprocessor.fit(df.where("id < 98"), spec)
    pipe = PipelineModel(prep.stages())
    pipe.write().overwrite().save(str(tmp_path / "prep"))
    again = PipelineModel.load(str(tmp_path / "prep")).transform(df)
    want = prep.transform(df).select("id", vector_to_array("features").alias("f"))
    got = again.select("id", vector_to_array("features").alias("f"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert len(got.first()["f"]) == 1 + len(odd)


def test_search_refit_and_metadata(spark, saved):
    path, meta, train, test = saved
    folds = spark.read.parquet(f"{path}/folds").collect()
    assert len(folds) == 4 * 5
    assert all(sum(r["n"] for r in folds if (r["num_trees"], r["max_depth"]) == s) == train.count()
               for s in ((5, 2), (5, 4), (10, 2), (10, 4)))
    means = {}
    for r in folds:
        means.setdefault((r["num_trees"], r["max_depth"]), []).append(r["auc"])
    best = max(sum(v) / 5 for v in means.values())
    chosen = meta["best_setting"]["num_trees"], meta["best_setting"]["max_depth"]
    assert sum(means[chosen]) / 5 == pytest.approx(best, abs=1e-6)
    model, stored = ML.load_model(path)
    assert stored == meta and meta["features"] == SPEC.features
    assert (model.stages[-1].getNumTrees, model.stages[-1].getMaxDepth()) == chosen
    assert meta["test_auc"] > 0.6 and 0.1 <= meta["threshold"] <= 0.9
    again = ML.score_frame(model, test).select("order_id", "score")
    assert ML.same_scores(again, spark.read.parquet(f"{path}/test_scores"), ["order_id"])
    top = spark.read.parquet(f"{path}/importances").orderBy(F.desc("importance")).first()
    assert top["transformed_feature"].startswith("cat__payment_method")


def test_one_order_scores_as_in_a_batch(spark, saved):
    path, meta, _, test = saved
    model, _ = ML.load_model(path)
    batch = {r["order_id"]: r for r in ML.score_rows(test, model, meta).collect()}
    for row in test.limit(3).collect():
        one = ML.score_one(spark, {f: row[f] for f in SPEC.features}, model, meta)
        many = batch[row["order_id"]]
        assert one["status"] == many["status"] == "ok"
        assert one["return_probability"] == round(many["score"], 4)
        assert one["risk_bucket"] == many["risk_bucket"]
        assert one["high_from"] == pytest.approx(meta["threshold"] + 0.15)
    lacking = ML.score_one(spark, {"price_inr": 10.0}, model, meta)
    assert lacking["status"] == "missing_input"
    assert lacking["missing_features"] == [f for f in SPEC.features if f != "price_inr"]


def test_upload_with_good_and_bad_rows(spark, saved, tmp_path):
    path, meta, *_ = saved
    model, _ = ML.load_model(path)
    full = {f: "1" for f in SPEC.features} | {"product_category": "Home", "payment_method": "COD"}
    rows = [(1, full), (2, {k: v for k, v in full.items() if k != "price_inr"}),
            (3, full | {"price_inr": "a lot"}), (4, full | {"rating_given": None}),
            (5, full | {"rating_given": "NaN", "extra": "x"}), (6, {}), (7, None),
            (8, full | {"delivery_days": " "})]
    where = str(tmp_path / "upload")
    spark.createDataFrame(rows, "order_id bigint, features map<string,string>").write.option(
        "ignoreNullFields", False).json(where)
    read = IN.batch_json(spark, where).withColumnRenamed("missing_features", "lacking")
    got = {r["order_id"]: r for r in ML.score_rows(
        read, model, meta, F.col("lacking"), F.size("bad_features") > 0).collect()}
    assert {k: r["status"] for k, r in got.items()} == {
        1: "ok", 2: "missing_input", 3: "error", 4: "ok", 5: "ok", 6: "missing_input",
        7: "missing_input", 8: "error"}
    assert got[2]["missing_features"] == ["price_inr"] and got[3]["bad_features"] == ["price_inr"]
    assert got[6]["missing_features"] == SPEC.features
    assert all((r["risk_bucket"] is None) == (r["status"] != "ok") for r in got.values())
    assert got[4]["score"] == got[5]["score"]  # both are imputed
