"""Wide, rare and odd inputs: nothing is lost, nothing changes with size."""

import math
import random

import pytest
from pyspark.sql import functions as F

from orderlens.functions import text as T
from orderlens.functions import vectors as V
from orderlens.operators import confusion as K
from orderlens.operators import importance as I
from orderlens.operators import metrics as M
from orderlens.operators import ordering as O
from orderlens.operators import pipeline as PL
from orderlens.operators import prepare as P
from orderlens.operators import retrieval as R
from orderlens.sources import readers as IN


def test_vectors_of_eighty_dimensions(spark):
    rows = [(i, [float(i * d % 7) for d in range(80)]) for i in range(5)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    assert V.width_of(df, "v") == 80
    ones = F.array(*[F.lit(1.0)] * 80)
    z = df.select("id", V.standardise(F.col("v"), ones, ones).alias("z")).collect()
    assert all(r["z"] == [x - 1.0 for x in rows[r["id"]][1]] for r in z)
    with pytest.raises(Exception, match="width"):
        df.select(V.standardise(F.col("v"), F.array(F.lit(1.0)), F.array(F.lit(1.0)))).collect()
    mixed = df.unionByName(spark.createDataFrame([(9, [1.0])], df.schema))
    with pytest.raises(ValueError, match="dimensions"):
        V.width_of(mixed, "v")


def test_twelve_labels_and_a_missing_one(spark):
    rows = [(i % 12, (i * 5) % 13) for i in range(120)] + [(None, 3), (4, None)]
    df = spark.createDataFrame(rows, "a int, p int")
    pairs = K.pair_counts(df, "a", "p")
    per = {r["class"]: r for r in K.per_class_metrics(pairs).collect()}
    assert set(per) == {*range(13), None}
    assert sum(r["support"] for r in per.values()) == len(rows)
    report = K.classification_report(pairs).first()
    right = sum(a == p for a, p in rows)
    assert report["support"] == len(rows)
    assert report["accuracy"] == pytest.approx(right / len(rows), abs=1e-6)
    assert report["weighted_recall"] == pytest.approx(right / len(rows), abs=1e-5)
    named = K.confusion_matrix(pairs.where("actual is not null")
                               .where("predicted is not null"), [0, 1]).collect()
    assert len(named) == 13 and len(named[0]) == 14


@pytest.mark.parametrize("number", [7, 12_345_678, 999_999_999_999])
def test_order_ids_of_any_width(spark, number):
    df = spark.createDataFrame([(f"check order {number} please",), (f"score #{number}",)], "t string")
    assert {r[0] for r in df.select(T.order_id(F.col("t"))).collect()} == {number}


def test_positions_with_nan_ties_and_large_ids(spark, monkeypatch):
    rnd = random.Random(3)
    values = [rnd.choice([1.0, 2.0, rnd.random() * 3]) for _ in range(3000)]
    ids = [2 ** 53 + 2 * i + 1 for i in range(3000)]
    rows = list(zip(ids, values)) + [(None, math.nan), (None, None)]
    df = spark.createDataFrame(rows, "id long, x double")
    for inside in (5, 10_000):
        monkeypatch.setattr(O, "INSIDE", inside)
        spots = [0, 1, 1500, 2400, 2999, 3000]
        got = O.exact_positions(df, {"x": spots, "id": spots}, accuracy=200)
        ordered = sorted(values)
        assert got["x"][-1] is None and got["id"][-1] is None
        assert [g[0] for g in got["x"][:-1]] == [ordered[s] for s in spots[:-1]]
        assert [g[0] for g in got["id"][:-1]] == [ids[s] for s in spots[:-1]]
        assert all(ordered[s - g[1]] == g[0] for s, g in zip(spots, got["x"][:-1]))


def test_quantile_picks_keep_large_ids(spark, monkeypatch):
    monkeypatch.setattr(M, "SMALL_TIE", 2)
    rows = [(2 ** 53 + 2 * i + 1, 0.5) for i in range(9)]
    df = spark.createDataFrame(rows, "id long, score double")
    got = {r["pick"]: r["id"] for r in M.quantile_rows(df, "id").collect()}
    assert got == {"min": rows[0][0], "q1": rows[2][0], "median": rows[4][0], "q3": rows[6][0],
                   "max": rows[8][0]}


def test_a_null_class_is_split_too(spark):
    rows = [(i, None if i % 3 == 0 else i % 3) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, label int")
    out = P.stratified_split(df, "id", "label").groupBy("label", "split").count().collect()
    assert {(r["label"], r["split"]): r["count"] for r in out} == {
        (c, s): n for c in (None, 1, 2) for s, n in (("test", 6), ("train", 24))}


def test_texts_without_tokens_have_a_row_either_way(spark):
    rows = spark.createDataFrame([(1, "red shoes"), (2, ""), (3, "?!")], "k int, t string")
    tokens = R.token_rows(rows, ["k"], "t")
    idfs = R.idf_table(R.document_frequency(tokens))
    sides = [R.term_vectors(tokens, idfs, ["k"], 1.0, limit) for limit in (0, 1000)]
    found = [{r["k"]: sorted(zip(r["terms"], (round(w, 9) for w in r["weights"])))
              for r in side.collect()} for side in sides]
    assert found[0] == found[1] and set(found[0]) == {1, 2, 3}


def test_a_hot_key_without_a_row_is_spread(spark):
    facts = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 77, id) key")
    dim = spark.range(1, 2000).selectExpr("id key", "id * 2 v").where("key <> 77")
    out = O.skewed_lookup(facts, dim, "key")
    assert out.count() == 3000
    assert out.where("v is not null and v <> key * 2").isEmpty()
    assert out.where("key = 77 and v is not null").isEmpty()
    known = O.hot_keys(facts, "key").collect()
    assert 77 in {r["key"] for r in known}


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    from pyspark.sql import types as S

    schema = S.StructType([S.StructField("id", S.LongType()), S.StructField("price", S.DoubleType()),
                           S.StructField("note", S.StringType())])
    path = tmp_path / "a.csv"
    path.write_text('note,price,id\n"two\nlines, ""quoted""",1.5,7\nx,,8\ny,bad,9\n')
    rows = {r["id"]: r for r in IN.orders_csv(spark, str(path), schema).collect()}
    assert rows[7]["price"] == 1.5 and rows[7]["note"] == 'two\nlines, "quoted"'
    assert rows[8]["price"] is None and rows[9]["price"] is None
    with pytest.raises(ValueError, match="no column other"):
        IN.orders_csv(spark, str(path), schema.add("other", "string"))


def test_surplus_cells_are_reported(spark, tmp_path):
    from pyspark.sql import types as S

    schema = S.StructType([S.StructField("id", S.LongType()), S.StructField("price", S.DoubleType())])
    path = tmp_path / "b.csv"
    path.write_text("id,price\n1,2.5\n2,3.5,9\n3\n")
    rows = {r["id"]: r for r in IN.batch_csv(spark, str(path), schema).collect()}
    assert rows[1]["corrupt_record"] is None and rows[2]["corrupt_record"] == "2,3.5,9"
    assert rows[3]["corrupt_record"] == "3"


def test_every_row_is_a_donor_once(spark):
    df = spark.range(50).selectExpr("id", "id * 2 as x")
    out = I.with_donor(df, "id", ["x"], 3).collect()
    for r in range(3):
        mine = [(o["id"], o["donor"]["x"]) for o in out if o["repeat"] == r]
        assert sorted(d for _, d in mine) == [2 * i for i in range(50)]
        assert all(d != 2 * i for i, d in mine)
    assert I.with_donor(df.limit(1), "id", ["x"], 2).count() == 2


def test_product_questions_in_a_conversation(spark):
    docs = spark.createDataFrame(
        [(1, "Footwear window", "Shoes can be returned within ten days.")],
        "doc_id bigint, title string, text string")
    chunks = R.chunks(docs).select("doc_id", "pos", "chunk_text")
    items = [(i, f"Runner {i}", "Sports", "Footwear", 900.0 + i, 5 + i, True, i % 2 == 0, i == 3, "x")
             for i in range(1, 8)]
    catalog = spark.createDataFrame(items, (
        "product_id long, product_name string, subcategory string, category string, price double, "
        "return_window int, exchange_available boolean, cod_available boolean, "
        "non_returnable boolean, description string"))
    rows = catalog.selectExpr("product_id doc_id", "0 pos", "product_name chunk_text")
    knowledge = PL.Knowledge(
        R.LexicalIndex.build(chunks), chunks, docs.select("doc_id", "title"), catalog,
        R.LexicalIndex.build(rows).kept())
    asked = spark.createDataFrame(
        [(1, "Which footwear products support cash on delivery?", "product_lookup"),
         (2, "Runner 5", "product_lookup"), (3, "nothing like this", "product_lookup"),
         (4, "Which footwear products support cash on delivery?", "policy")],
        "query_id long, text string, fine_intent string")
    got = {r["query_id"]: r["_offer"] for r in knowledge.offers(asked).collect()}
    assert set(got) == {1, 2}
    assert got[1]["n"] == 3 and got[1]["title"] == "Runner 2" and got[1]["score"] == 1.0
    assert "Runner 5" in got[2]["answer"] and 0.45 <= got[2]["score"] <= 1


def test_no_machine_local_folder_on_a_cluster(monkeypatch):
    from orderlens import session

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="checkpoint"):
        session.shared_folder(Session())
    Context.getCheckpointDir = lambda self: "hdfs://x/y"
    assert session.shared_folder(Session()) == "hdfs://x/y"
