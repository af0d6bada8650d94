"""Vector queries: top-k, nearest exemplar, confusion family, standardisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens import constants as C
from orderlens.functions import vectors as V
from orderlens.operators import answers as A
from orderlens.operators import confusion as K
from orderlens.operators import models as ML
from orderlens.operators import prepare as P
from orderlens.operators.topk import dense_top_k, nearest_rows
from orderlens.plans.registry import Registry
from orderlens.session import bounded_rows, once, staged
from orderlens.sources.readers import table

queries = Registry()
EXEMPLARS = 3
MAX_EXEMPLARS = 10_000

COS = ("list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) "
       "* sqrt(list_dot_product(b.v, b.v)))")

CENTROIDS = """
items AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
dims AS (SELECT label, d, avg(v[d + 1]) AS m
  FROM (SELECT *, unnest(range(len(v))) AS d FROM items) GROUP BY label, d),
centroids AS (SELECT label, list(m ORDER BY d) AS v FROM dims GROUP BY label)"""


def _items(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", "label", V.as_doubles(F.col("embedding")).alias("vector"))


def _centroids(items):
    """Mean vector per label: one aggregate with one average per dimension."""
    dim = V.width_of(items, "vector")
    means = items.groupBy("label").agg(*[
        F.avg(F.get("vector", F.lit(i))).alias(f"m{i}") for i in range(dim)])
    return means.select(
        F.col("label").cast("bigint").alias("query_id"),
        F.array(*[f"m{i}" for i in range(dim)]).alias("vector"))


@queries.query(f"""WITH {CENTROIDS},
  s AS (SELECT a.label AS query_id, b.vec_id, round({COS}, 9) AS score
        FROM centroids a, items b)
  SELECT CAST(query_id AS BIGINT) AS query_id, vec_id, round(score, 4) AS score,
         CAST(row_number() OVER w AS INTEGER) AS rank
  FROM s WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
  QUALIFY row_number() OVER w <= 12""")
def vector_topk(spark, sf):
    items = _items(spark, sf)
    corpus = items.select(F.col("vec_id").alias("doc_id"), F.lit(0).alias("pos"), "vector")
    hits = dense_top_k(corpus, _centroids(items), C.CHUNK_POOL)
    return hits.select("query_id", F.col("doc_id").alias("vec_id"),
                       F.round("score", 4).alias("score"), "rank")


@queries.query("""SELECT label, vec_id, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id)
    AS INTEGER) AS position
  FROM embeddings QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1""")
def first_per_class(spark, sf):
    return K.first_per_class(
        table(spark, sf, "embeddings").select("vec_id", "label"), "label", "vec_id")


NEAREST = f"""
items AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
exemplars AS (SELECT * FROM items QUALIFY row_number() OVER (
  PARTITION BY label ORDER BY vec_id) <= {EXEMPLARS}),
scores AS (SELECT a.vec_id, a.label, b.vec_id AS exemplar, b.label AS predicted,
                  round({COS}, 9) AS s FROM items a, exemplars b),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, exemplar) AS r
           FROM scores),
nearest AS (SELECT vec_id, label, predicted, exemplar, s FROM ranked WHERE r = 1),
pairs AS (SELECT label AS actual, predicted, count(*) AS n FROM nearest GROUP BY label, predicted)"""


def _nearest(spark, sf):
    return _labelled(spark, sf)[0]


def _labelled(spark, sf):
    """Rows with their three nearest exemplars, and the map from exemplar to class."""
    items = _items(spark, sf)
    rows = bounded_rows(
        K.first_per_class(items, "label", "vec_id", EXEMPLARS), MAX_EXEMPLARS, "exemplars")
    rows = sorted(rows, key=lambda r: r["vec_id"])
    near = nearest_rows(items, ["vec_id", "label"], "vector", [r["vec_id"] for r in rows],
                        [r["vector"] for r in rows], 3)
    labels = F.create_map(*[
        F.lit(x) for r in rows for x in (r["vec_id"], r["label"])])
    return near.withColumn("predicted", labels[F.element_at("nearest", 1)["exemplar"]]), labels


@queries.query(f"""WITH {NEAREST},
  second AS (SELECT vec_id, exemplar AS runner_up FROM ranked WHERE r = 2)
  SELECT n.vec_id, n.label, n.predicted, n.exemplar, round(n.s, 4) AS similarity,
         CASE WHEN n.s < 0.25 THEN 1 ELSE 0 END AS below_floor, second.runner_up,
         CASE WHEN n.predicted = n.label THEN 1 ELSE 0 END AS agrees
  FROM nearest n JOIN second USING (vec_id)""")
def nearest_exemplar(spark, sf):
    best, second = F.element_at("nearest", 1), F.element_at("nearest", 2)
    near = _nearest(spark, sf).select(
        "vec_id", "label", "predicted", best["exemplar"].alias("exemplar"),
        F.round(best["similarity"], 4).alias("similarity"),
        (best["similarity"] < C.ROUTING_FLOOR).cast("int").alias("below_floor"),
        second["exemplar"].alias("runner_up"))
    return K.agreement(near, "label", "predicted")


@queries.query(f"""WITH {NEAREST}, other AS (SELECT r.vec_id, min_by(r.predicted, r.r) AS predicted,
    min_by(r.s, r.r) AS s FROM ranked r JOIN nearest n USING (vec_id)
    WHERE r.r <= 3 AND r.predicted <> n.predicted GROUP BY r.vec_id)
  SELECT n.vec_id, 'Item ' || n.vec_id || ': class ' || n.predicted || ' ('
      || printf('%.2f', round(n.s, 4) * 100) || '%)' || coalesce(', next ' || o.predicted || ' ('
      || printf('%.2f', round(o.s, 4) * 100) || '%)', '') || '.' AS answer,
    'image_classifier_tool' AS source, round(n.s, 4) AS confidence
  FROM nearest n LEFT JOIN other o USING (vec_id)""")
def image_answers(spark, sf):
    """The class of every vector in words, with the next other class among its three nearest."""
    near, labels = _labelled(spark, sf)
    best = F.element_at("nearest", 1)
    other = F.get(F.filter("nearest", lambda e: labels[e["exemplar"]] != F.col("predicted")),
                  F.lit(0))
    said = near.withColumns({
        "s": F.round(best["similarity"], 4), "next": labels[other["exemplar"]].cast("string"),
        "next_s": F.round(other["similarity"], 4)})
    answer = A.image_answer(
        F.col("predicted").cast("string"), F.col("s"), F.col("next"), F.col("next_s"),
        F.concat(F.lit("Item "), F.col("vec_id").cast("string")))
    response = A.response(answer, F.lit("image_classifier_tool"), F.col("s"))
    return said.select("vec_id", response.alias("r")).select(
        "vec_id", "r.answer", "r.source", "r.confidence")


def _pairs(spark, sf):
    return K.pair_counts(_nearest(spark, sf), "label", "predicted")


# The classes come from the pairs; only the column names of the wide form are a list here.
COLUMNS = list(range(10))
CELLS = ("classes AS (SELECT actual AS c FROM pairs UNION SELECT predicted FROM pairs), "
         "cells AS (SELECT a.c AS actual, b.c AS predicted, coalesce(p.n, 0) AS n "
         "FROM classes a CROSS JOIN classes b LEFT JOIN pairs p "
         "ON p.actual = a.c AND p.predicted = b.c)")
_PIVOT = ", ".join(
    f"CAST(sum(CASE WHEN predicted = {c} THEN n ELSE 0 END) AS BIGINT) AS pred_{c}"
    for c in COLUMNS)


@queries.query(f"WITH {NEAREST}, {CELLS} SELECT actual, {_PIVOT} FROM cells GROUP BY actual")
def confusion_matrix(spark, sf):
    return K.confusion_matrix(_pairs(spark, sf), COLUMNS)


PER_CLASS = f"""{NEAREST}, {CELLS},
sums AS (SELECT c AS class,
    (SELECT CAST(sum(n) AS BIGINT) FROM cells WHERE actual = c) AS support,
    (SELECT CAST(sum(n) AS BIGINT) FROM cells WHERE predicted = c) AS called,
    (SELECT CAST(sum(n) AS BIGINT) FROM cells WHERE actual = c AND predicted = c) AS tp
  FROM classes),
per AS (SELECT class,
    round(coalesce(CAST(tp AS DOUBLE) / nullif(called, 0), 0.0), 6) AS precision,
    round(coalesce(CAST(tp AS DOUBLE) / nullif(support, 0), 0.0), 6) AS recall,
    round(coalesce(CAST(2 * tp AS DOUBLE) / nullif(called + support, 0), 0.0), 6) AS f1, support
  FROM sums)"""


@queries.query(f"WITH {PER_CLASS} SELECT * FROM per")
def per_class_metrics(spark, sf):
    return K.per_class_metrics(_pairs(spark, sf))


_WEIGHTED = ", ".join(
    f"round(sum({c} * support) / sum(support), 5) AS weighted_{c}"
    for c in ("precision", "recall", "f1"))


@queries.query(f"""WITH {PER_CLASS}
  SELECT (SELECT round(CAST(sum(CASE WHEN actual = predicted THEN n ELSE 0 END) AS DOUBLE)
          / sum(n), 6) FROM cells) AS accuracy,
    round(avg(precision), 5) AS macro_precision, round(avg(recall), 5) AS macro_recall,
    round(avg(f1), 5) AS macro_f1, {_WEIGHTED}, CAST(sum(support) AS BIGINT) AS support
  FROM per""")
def classification_report(spark, sf):
    return K.classification_report(_pairs(spark, sf))


@queries.query(f"""WITH {NEAREST} SELECT * FROM pairs WHERE actual <> predicted
  ORDER BY n DESC, actual, predicted LIMIT 6""")
def confusion_pairs(spark, sf):
    return K.confusion_pairs(_pairs(spark, sf))


@queries.query(f"""WITH {NEAREST}
  SELECT least(actual, predicted) AS class_a, greatest(actual, predicted) AS class_b,
         CAST(sum(n) AS BIGINT) AS n
  FROM pairs WHERE actual <> predicted GROUP BY ALL ORDER BY n DESC, class_a, class_b LIMIT 3""")
def undirected_pairs(spark, sf):
    return K.undirected_pairs(_pairs(spark, sf))


@queries.query("""WITH long AS (
    SELECT vec_id, label, d, CAST(embedding[d + 1] AS DOUBLE) AS x
    FROM (SELECT *, unnest(range(len(embedding))) AS d FROM embeddings)),
  stats AS (SELECT d, avg(x) AS m, stddev_pop(x) AS s FROM long GROUP BY d),
  z AS (SELECT vec_id, label, d, (x - m) / nullif(s, 0) AS z FROM long JOIN stats USING (d)),
  e AS (SELECT vec_id, label, sum(exp(z)) AS total, max(z) AS top FROM z GROUP BY ALL)
  SELECT e.vec_id, e.label, CAST(min(z.d) FILTER (WHERE z.z = e.top) AS INTEGER) AS top_dim,
         round(any_value(exp(e.top) / e.total), 6) AS top_share,
         round(sum(z.z * z.z), 4) AS square_sum
  FROM e JOIN z USING (vec_id) GROUP BY e.vec_id, e.label""")
def standardise_vectors(spark, sf):
    items = _items(spark, sf)
    dim = V.width_of(items, "vector")
    x = [F.get("vector", F.lit(i)) for i in range(dim)]
    stats = items.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)],
                      *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(x)]).first()
    mean = F.array(*[F.lit(stats[f"m{i}"]) for i in range(dim)])
    std = F.array(*[F.lit(stats[f"s{i}"]) for i in range(dim)])
    # The vector is computed once per row; the barrier keeps it from being inlined again.
    z = items.select("vec_id", "label", F.explode(F.array(
        V.standardise(F.col("vector"), mean, std))).alias("z"))
    p = z.select("vec_id", "label", "z", F.explode(F.array(
        F.transform("z", lambda v: F.exp(v)))).alias("e"))
    total = F.aggregate("e", F.lit(0.0), lambda acc, v: acc + v)
    return p.select(
        "vec_id", "label", V.argmax(F.col("z")).alias("top_dim"),
        F.round(F.array_max("e") / total, 6).alias("top_share"),
        F.round(V.dot(F.col("z"), F.col("z")), 4).alias("square_sum"))


@queries.query("""WITH sized AS (
    SELECT vec_id, label, row_number() OVER (PARTITION BY label
             ORDER BY md5(CAST(vec_id AS VARCHAR) || ':42'), vec_id) AS r,
           count(*) OVER (PARTITION BY label) AS n, count(*) OVER () AS total FROM embeddings),
  k AS (SELECT count(DISTINCT label) AS k FROM embeddings)
  SELECT CASE WHEN r <= least(n, (total // 5) // k) THEN 'val' ELSE 'train' END AS split, label,
         count(*) AS n, CAST(sum(vec_id) AS BIGINT) AS id_sum
  FROM sized, k GROUP BY ALL""")
def quota_split(spark, sf):
    items = table(spark, sf, "embeddings").select("vec_id", "label")
    val_size = items.count() // 5
    return P.quota_split(items, "vec_id", "label", val_size).groupBy("split", "label").agg(
        F.count("*").alias("n"), F.sum("vec_id").alias("id_sum"))


def _head(spark, sf):
    """(test rows with the kept head's output, best, history); fitted once per folder."""
    def make():
        parts = staged(P.stratified_split(table(spark, sf, "embeddings"), "vec_id", "label"))
        train = parts.where(F.col("split") == "train").drop("split")
        inner = P.stratified_split(train, "vec_id", "label", seed=7)
        best, history = ML.fit_head(
            inner.where(F.col("split") == "train"), inner.where(F.col("split") == "test"),
            [0.0, 0.01, 0.1])
        test = parts.where(F.col("split") == "test").drop("split")
        return staged(ML.head_predictions(best[0], test)), best, history

    return once(spark, sf, "head", make)


@queries.query()
def head_metrics(spark, sf):
    """Linear head on cached vectors, best validated state kept, measured on test."""
    scored, (_, accuracy, strength, rounds), _ = _head(spark, sf)
    return scored.agg(
        F.count("*").alias("n_test"),
        F.round(F.avg((F.col("predicted") == F.col("label")).cast("double")), 6)
        .alias("test_accuracy"),
        F.round(F.avg("confidence"), 6).alias("mean_confidence"),
        F.lit(float(accuracy)).alias("validation_accuracy"),
        F.lit(float(strength)).alias("chosen_strength"), F.lit(rounds).alias("chosen_rounds"))


@queries.query()
def head_output(spark, sf):
    """Per test vector: class, confidence and the three best classes with their shares."""
    scored, *_ = _head(spark, sf)
    return scored.select(
        "vec_id", "label", "predicted", F.round("confidence", 6).alias("confidence"),
        F.transform("top3", lambda e: F.struct(
            e["index"].alias("class"), F.round(e["probability"], 6).alias("share"))).alias("top3"))


@queries.query("""WITH sized AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label
      ORDER BY md5(CAST(vec_id AS VARCHAR) || ':42'), vec_id) AS r,
    count(*) OVER (PARTITION BY label) AS n, max(label) OVER () + 1 AS classes FROM embeddings)
  SELECT vec_id, CAST(classes AS INTEGER) AS n_classes, 1 AS sums_to_one, 1 AS is_argmax,
    1 AS ordered, CAST(least(3, classes) AS INTEGER) AS n_top, 1 AS first_is_best,
    1 AS best_state_kept FROM sized WHERE r <= (20 * n * 2 + 100) // 200""")
def head_checks(spark, sf):
    """What must hold of every row of ``head_output``, and of the state that was kept."""
    scored, best, history = _head(spark, sf)
    p, top = F.col("probabilities"), F.col("top3")
    higher = F.exists(p, lambda x: x > F.get(p, F.col("predicted")))
    share = F.transform(top, lambda e: e["probability"])
    held = best[1] == max(h[2] for h in history)
    return scored.select(
        "vec_id", F.size(p).alias("n_classes"),
        (F.abs(F.aggregate(p, F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9).cast("int")
        .alias("sums_to_one"), (~higher).cast("int").alias("is_argmax"),
        (share == F.sort_array(share, asc=False)).cast("int").alias("ordered"),
        F.size(top).alias("n_top"),
        ((F.get(top, F.lit(0))["probability"] == F.col("confidence"))
         & (F.get(p, F.get(top, F.lit(0))["index"]) == F.col("confidence"))).cast("int")
        .alias("first_is_best"), F.lit(int(held)).alias("best_state_kept"))
