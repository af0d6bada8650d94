"""Order-risk queries: profile, split, score, evaluate, explain."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens import constants as C
from orderlens.functions import scoring as S
from orderlens.operators import explain as X
from orderlens.operators import importance as I
from orderlens.operators import metrics as M
from orderlens.operators import models as ML
from orderlens.operators import ordering as R
from orderlens.operators import orders as O
from orderlens.operators import prepare as P
from orderlens.operators import profile as PR
from orderlens.plans import base_sql as B
from orderlens.plans.registry import Registry
from orderlens.schemas import FeatureSpec
from orderlens.session import new_folder, staged
from orderlens.sources.readers import order_history, tables
from orderlens.sources.sinks import csv_report

queries = Registry()
DIMS = ["product_category", "payment_method"]
OPERATING = 0.30
REPEATS = 10
MAX_GROUPS = 1000
# Seed of the order in which the permutation takes donors.
SEED = C.SPLIT_SEED


def _scored(spark, sf):
    return O.scored(order_history(spark, sf))


@queries.query(f"WITH {B.ORDERS} SELECT * FROM feats")
def order_features(spark, sf):
    return order_history(spark, sf)


@queries.query(f"""WITH {B.SCORED}
  SELECT order_id, score, CASE WHEN product_category IN ('Apparel', 'Footwear') THEN 1 ELSE 0 END
    AS fit_risk, round(coalesce(CAST(num_previous_returns AS DOUBLE)
      / nullif(num_previous_orders, 0), 0.0), 6) AS prev_return_ratio
  FROM scored""")
def rule_score(spark, sf):
    return _scored(spark, sf).select(
        "order_id", "score",
        F.col("product_category").isin(C.FIT_RISK_CATEGORIES).cast("int").alias("fit_risk"),
        F.round(S.guarded_ratio(F.col("num_previous_returns"), F.col("num_previous_orders")), 6)
        .alias("prev_return_ratio"))


@queries.query(f"""WITH {B.ORDERS}
  SELECT 'product_category' AS dimension, product_category AS level, count(*) AS orders,
         CAST(sum(returned) AS BIGINT) AS returns, round(avg(returned), 6) AS return_rate
  FROM feats GROUP BY product_category
  UNION ALL
  SELECT 'payment_method', payment_method, count(*), CAST(sum(returned) AS BIGINT),
         round(avg(returned), 6) FROM feats GROUP BY payment_method""")
def rate_table(spark, sf):
    return PR.rate_tables(order_history(spark, sf), DIMS)


CHECKS = """
  SELECT 'rows equal orders' AS check_name, CAST(n_rows - (SELECT count(*) FROM orders) AS DOUBLE)
           AS measured, 0.0 AS low, 0.0 AS high FROM agg
  UNION ALL SELECT 'return rate', return_rate, 0.18, 0.40 FROM agg
  UNION ALL SELECT 'missing rating rate', missing_rate, 0.0, 0.18 FROM agg
  UNION ALL SELECT 'lowest price', min_price, 0.0, 1000000.0 FROM agg
  UNION ALL SELECT 'latest delivery day', max_days, 1.0, 21.0 FROM agg
  UNION ALL SELECT 'returns beyond orders', bad_history, 0.0, 0.0 FROM agg
  UNION ALL SELECT 'unknown categories', unknown_cat, 0.0, 0.0 FROM agg
  UNION ALL SELECT 'unknown payments', unknown_pay, 0.0, 0.0 FROM agg"""


@queries.query(f"""WITH {B.ORDERS},
  agg AS (SELECT count(*) AS n_rows, avg(returned) AS return_rate,
    avg(CASE WHEN rating_given IS NULL THEN 1.0 ELSE 0.0 END) AS missing_rate,
    min(price_inr) AS min_price, CAST(max(delivery_days) AS DOUBLE) AS max_days,
    CAST(count(*) FILTER (WHERE num_previous_returns > num_previous_orders) AS DOUBLE)
      AS bad_history,
    CAST(count(*) FILTER (WHERE product_category NOT IN ('Apparel', 'Electronics', 'Home',
      'Footwear', 'Beauty')) AS DOUBLE) AS unknown_cat,
    CAST(count(*) FILTER (WHERE payment_method NOT IN ('COD', 'Prepaid_Card', 'Prepaid_UPI',
      'Wallet')) AS DOUBLE) AS unknown_pay FROM feats),
  checks AS ({CHECKS})
  SELECT check_name, round(measured, 6) AS measured,
         CASE WHEN measured BETWEEN low AND high THEN 1 ELSE 0 END AS passed FROM checks""")
def profile_checks(spark, sf):
    f = order_history(spark, sf)
    orders, = tables(spark, sf, "orders")
    expected = orders.agg(F.count("*").alias("n"))

    def between(low, high):
        return F.lit(float(low)), F.lit(float(high))

    def unknown(column, levels):
        return F.count_if(~F.col(column).isin(levels))

    return PR.quality_checks(f, {
        "rows equal orders": (F.count("*") - F.max(expected.scalar()), *between(0, 0)),
        "return rate": (F.avg("returned"), *between(0.18, 0.40)),
        "missing rating rate": (F.avg(F.col("rating_given").isNull().cast("int")),
                                *between(0, 0.18)),
        "lowest price": (F.min("price_inr"), *between(0, 1e6)),
        "latest delivery day": (F.max("delivery_days"), *between(1, 21)),
        "returns beyond orders": (
            F.count_if(F.col("num_previous_returns") > F.col("num_previous_orders")),
            *between(0, 0)),
        "unknown categories": (unknown("product_category", C.PRODUCT_CATEGORIES),
                               *between(0, 0)),
        "unknown payments": (unknown("payment_method", C.PAYMENT_METHODS), *between(0, 0)),
    })


def _missing_sql() -> str:
    pairs = []
    for column in ("quality", "toxic"):
        pairs.append(f"""SELECT '{column}' AS column_name, g AS group_name,
              count(*) FILTER (WHERE lang = g) AS n_in,
              count(*) FILTER (WHERE lang <> g) AS n_out,
              count(*) FILTER (WHERE lang = g AND {column} IS NULL) AS missing_in,
              count(*) FILTER (WHERE lang <> g AND {column} IS NULL) AS missing_out
              FROM docs, (SELECT DISTINCT lang AS g FROM documents WHERE lang IS NOT NULL)
              GROUP BY g""")
    return f"""WITH docs AS (SELECT lang, quality, toxic FROM documents LEFT JOIN labels
                             USING (doc_id)),
      pairs AS ({' UNION ALL '.join(pairs)}),
      rates AS (SELECT *, coalesce(CAST(missing_in AS DOUBLE) / nullif(n_in, 0), 0.0) AS a,
                       coalesce(CAST(missing_out AS DOUBLE) / nullif(n_out, 0), 0.0) AS b
                FROM pairs)
      SELECT column_name, group_name, n_in, n_out, missing_in, missing_out,
             round(a, 6) AS rate_in, round(b, 6) AS rate_out, round((a - b) * 100, 4) AS gap_pp,
             round(a / nullif(b, 0), 6) AS ratio,
             CASE WHEN abs(a - b) >= 0.05 THEN 'MAR' ELSE 'no dependence seen' END AS verdict
      FROM rates"""


@queries.query(_missing_sql())
def missingness_by_group(spark, sf):
    documents, labels = tables(spark, sf, "documents", "labels")
    joined = documents.select("doc_id", "lang").join(labels, "doc_id", "left")
    return PR.missingness_by_group(
        joined, ["quality", "toxic"],
        {lang: F.col("lang") == lang for lang in PR.levels_of(documents, "lang", MAX_GROUPS)})


@queries.query(f"""WITH {B.SPLIT}
  SELECT split, returned, count(*) AS n, CAST(min(order_id) AS BIGINT) AS first_id,
         CAST(sum(order_id) AS BIGINT) AS id_sum FROM parts GROUP BY split, returned""")
def stratified_split(spark, sf):
    f = staged(order_history(spark, sf).select("order_id", "returned"))
    return P.stratified_split(f, "order_id", "returned").groupBy("split", "returned").agg(
        F.count("*").alias("n"), F.min("order_id").alias("first_id"),
        F.sum("order_id").alias("id_sum"))


@queries.query(f"""WITH {B.SPLIT},
  folded AS (
    SELECT order_id, returned, row_number() OVER (PARTITION BY returned
             ORDER BY md5(CAST(order_id AS VARCHAR) || ':42'), order_id) AS r,
           count(*) OVER (PARTITION BY returned) AS n
    FROM feats),
  numbered AS (
    SELECT *, (CASE WHEN r > n * 1 // 5 THEN 1 ELSE 0 END)
            + (CASE WHEN r > n * 2 // 5 THEN 1 ELSE 0 END)
            + (CASE WHEN r > n * 3 // 5 THEN 1 ELSE 0 END)
            + (CASE WHEN r > n * 4 // 5 THEN 1 ELSE 0 END) AS fold FROM folded)
  SELECT fold, returned, count(*) AS n, CAST(sum(order_id) AS BIGINT) AS id_sum
  FROM numbered GROUP BY fold, returned""")
def stratified_folds(spark, sf):
    f = staged(order_history(spark, sf).select("order_id", "returned"))
    return P.stratified_folds(f, "order_id", "returned").groupBy("fold", "returned").agg(
        F.count("*").alias("n"), F.sum("order_id").alias("id_sum"))


@queries.query(f"""WITH {B.SPLIT}
  SELECT count(*) FILTER (WHERE split = 'train') AS n_train,
         count(*) FILTER (WHERE split = 'test') AS n_test,
         CAST(0 AS BIGINT) AS n_overlap,
         count(*) - count(*) FILTER (WHERE split = 'test') AS n_complement FROM parts""")
def split_overlap(spark, sf):
    f = staged(order_history(spark, sf).select("order_id", "returned"))
    parts = P.stratified_split(f, "order_id", "returned")
    train = parts.where(F.col("split") == "train").select("order_id")
    test = parts.where(F.col("split") == "test").select("order_id")
    overlap = train.intersect(test).agg(F.count("*").alias("n"))
    complement = f.select("order_id").join(test, "order_id", "left_anti").agg(
        F.count("*").alias("n"))
    return parts.agg(
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "test").alias("n_test"),
        F.max(overlap.scalar()).alias("n_overlap"),
        F.max(complement.scalar()).alias("n_complement"))


@queries.query(f"""WITH {B.ORDERS}
  SELECT returned, count(*) AS n,
         round((SELECT count(*) FROM feats) / (2.0 * count(*)), 6) AS weight
  FROM feats GROUP BY returned""")
def class_weights(spark, sf):
    return P.class_weights(order_history(spark, sf), "returned").withColumn(
        "weight", F.round("weight", 6))


def _matrix_sql() -> str:
    stats = []
    for c in C.NUMERIC_FEATURES:
        x = f"coalesce(CAST(t.{c} AS DOUBLE), med_{c})"
        stats.append(f"avg({x}) AS m_{c}, stddev_pop({x}) AS s_{c}")
    meds = ", ".join(f"median({c}) AS med_{c}" for c in C.NUMERIC_FEATURES)
    num = ", ".join(
        f"round((coalesce(CAST(p.{c} AS DOUBLE), med_{c}) - m_{c}) / "
        f"CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS num__{c}"
        for c in C.NUMERIC_FEATURES)
    cats = ", ".join(
        f"CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS cat__{c}_{v}"
        for c, levels in (("product_category", sorted(C.PRODUCT_CATEGORIES)),
                          ("payment_method", sorted(C.PAYMENT_METHODS)))
        for v in levels)
    return f"""WITH {B.SPLIT}, train AS (SELECT * FROM parts WHERE split = 'train'),
      med AS (SELECT {meds} FROM train),
      stat AS (SELECT {', '.join(stats)} FROM train t, med)
      SELECT order_id, split, {num}, {cats} FROM parts p, med, stat"""


@queries.query(_matrix_sql())
def preprocess_matrix(spark, sf):
    spec = FeatureSpec()
    f = staged(order_history(spark, sf))
    parts = P.stratified_split(f, "order_id", "returned")
    prep = P.Preprocessor.fit(parts.where(F.col("split") == "train"), spec)
    return parts.select("order_id", "split", *[
        (F.round(c, 6) if name.startswith("num__") else c).alias(name)
        for name, c in prep.columns().items()])


@queries.query(f"""WITH {B.SPLIT},
  maj AS (SELECT returned AS m FROM parts WHERE split = 'train' GROUP BY returned
          ORDER BY count(*) DESC, returned LIMIT 1),
  c AS (SELECT count(*) AS n, count(*) FILTER (WHERE returned = 1 AND m = 1) AS tp,
         count(*) FILTER (WHERE returned = 0 AND m = 1) AS fp,
         count(*) FILTER (WHERE returned = 1 AND m = 0) AS fn,
         count(*) FILTER (WHERE returned = 0 AND m = 0) AS tn
        FROM parts, maj WHERE split = 'test')
  SELECT n, tp, fp, fn, tn, round(CAST(tp + tn AS DOUBLE) / n, 6) AS accuracy, {B.metrics()}
  FROM c""")
def baseline_metrics(spark, sf):
    f = staged(order_history(spark, sf).select("order_id", "returned"))
    parts = P.stratified_split(f, "order_id", "returned")
    majority = ML.majority_class(parts.where(F.col("split") == "train"))
    test = parts.where(F.col("split") == "test").withColumn("predicted", F.lit(majority))
    return M.class1_metrics(test, "predicted")


@queries.query(f"WITH {B.SWEEP} SELECT * FROM sweep")
def threshold_sweep(spark, sf):
    return M.sweep(M.score_cube(_scored(spark, sf)))


@queries.query(f"""WITH {B.SWEEP}
  SELECT * FROM sweep ORDER BY f1 DESC, threshold LIMIT 1""")
def best_threshold(spark, sf):
    return M.best_threshold(M.sweep(M.score_cube(_scored(spark, sf))))


@queries.query(f"""WITH {B.SWEEP},
  lo AS (SELECT * FROM sweep WHERE threshold = 0.5),
  hi AS (SELECT * FROM sweep WHERE threshold = 0.3)
  SELECT round((hi.precision - lo.precision) * 100, 4) AS precision_delta_pp,
         round((hi.recall - lo.recall) * 100, 4) AS recall_delta_pp,
         round((hi.f1 - lo.f1) * 100, 4) AS f1_delta_pp,
         round((hi.accuracy - lo.accuracy) * 100, 4) AS accuracy_delta_pp FROM lo, hi""")
def threshold_delta(spark, sf):
    return M.sweep_delta(M.sweep(M.score_cube(_scored(spark, sf))), 0.5, 0.3)


@queries.query(f"""WITH {B.SWEEP},
  r AS (SELECT *, row_number() OVER (ORDER BY threshold) AS k FROM sweep)
  SELECT * EXCLUDE (k) FROM r WHERE (k - 1) % 2 = 0""")
def sweep_report_rows(spark, sf):
    return M.every_nth(M.sweep(M.score_cube(_scored(spark, sf))), 2)


@queries.query(f"WITH {B.SCORED} {B.auc('scored')}")
def roc_auc(spark, sf):
    return M.roc_auc(_scored(spark, sf))


@queries.query(f"WITH {B.SCORED} {B.auc('scored', 'payment_method')}")
def roc_auc_by_payment(spark, sf):
    return M.roc_auc(_scored(spark, sf), ["payment_method"])


def _subgroups(threshold: float) -> str:
    return f"""long AS (
      SELECT 'product_category' AS dimension, product_category AS subgroup, score, returned
      FROM scored UNION ALL SELECT 'payment_method', payment_method, score, returned FROM scored),
    groups AS (
      SELECT dimension, subgroup, count(*) AS n_test, CAST(sum(returned) AS BIGINT) AS actual_returns,
        count(*) FILTER (WHERE score >= {threshold}) AS flagged,
        count(*) FILTER (WHERE score >= {threshold} AND returned = 1) AS tp
      FROM long GROUP BY dimension, subgroup),
    subgroup AS (
      SELECT *, flagged - tp AS fp, actual_returns - tp AS fn,
        {B.metrics('tp', '(flagged - tp)', '(actual_returns - tp)')}
      FROM groups)"""


@queries.query(f"WITH {B.SCORED}, {_subgroups(OPERATING)} SELECT * FROM subgroup")
def subgroup_metrics(spark, sf):
    return M.subgroup_metrics(M.score_cube(_scored(spark, sf), DIMS), DIMS, OPERATING)


@queries.query(f"""WITH {B.SCORED}, {_subgroups(OPERATING)}, {B.GRID},
  local_counts AS (
    SELECT dimension, subgroup, threshold, count(*) FILTER (WHERE score >= threshold) AS flagged,
      count(*) FILTER (WHERE score >= threshold AND returned = 1) AS tp,
      CAST(sum(returned) AS BIGINT) AS pos
    FROM long, grid GROUP BY ALL),
  local_sweep AS (SELECT *, {B.metrics('tp', '(flagged - tp)', '(pos - tp)')} FROM local_counts),
  local_best AS (SELECT * FROM local_sweep QUALIFY row_number() OVER (
    PARTITION BY dimension, subgroup ORDER BY f1 DESC, threshold) = 1),
  overall AS (SELECT count(*) FILTER (WHERE score >= {OPERATING} AND returned = 1)
    / CAST(sum(returned) AS DOUBLE) AS r FROM scored),
  gaps AS (
    SELECT s.*, o.r - CAST(s.tp AS DOUBLE) / nullif(s.actual_returns, 0) AS gap,
      b.threshold AS local_threshold, b.f1 AS local_f1, b.recall AS local_recall,
      b.flagged AS local_flagged, b.tp AS local_tp
    FROM subgroup s JOIN local_best b USING (dimension, subgroup), overall o
    WHERE s.n_test >= 50)
  SELECT dimension, subgroup, n_test, actual_returns, flagged, tp, recall,
    round(gap, 6) AS recall_gap, CASE WHEN gap >= 0.05 THEN 1 ELSE 0 END AS material,
    CASE WHEN row_number() OVER (ORDER BY gap DESC, dimension, subgroup) = 1 THEN 1 ELSE 0 END
      AS weakest,
    local_threshold, local_f1, local_recall, local_flagged,
    local_flagged - flagged AS extra_flagged, local_tp - tp AS recovered FROM gaps""")
def subgroup_thresholds(spark, sf):
    cube = staged(M.score_cube(_scored(spark, sf), DIMS))
    return M.subgroup_thresholds(cube, DIMS, OPERATING)


BUCKET = f"""CASE WHEN score < {OPERATING} THEN 'Low' WHEN score < {OPERATING}::DOUBLE + 0.15::DOUBLE
  THEN 'Medium' ELSE 'High' END"""


@queries.query(f"""WITH {B.SCORED}, b AS (SELECT *, {BUCKET} AS risk_bucket FROM scored)
  SELECT risk_bucket, CAST(least(floor(score * 20), 19) AS INTEGER) AS bin, count(*) AS n
  FROM b GROUP BY ALL""")
def score_histogram(spark, sf):
    scored = _scored(spark, sf).withColumn("risk_bucket", S.risk_bucket(F.col("score"), F.lit(OPERATING)))
    return PR.binned_scores(scored, "risk_bucket", "score")


@queries.query(f"""WITH {B.SCORED}, b AS (SELECT *, {BUCKET} AS risk_bucket FROM scored)
  SELECT order_id, risk_bucket, round(score * 100, 4) AS return_probability_percent,
         round(greatest(score, 1 - score), 6) AS confidence, 'ok' AS status FROM b""")
def risk_buckets(spark, sf):
    scored = ML.score_batch(_scored(spark, sf), F.col("score"), OPERATING)
    return scored.select(
        "order_id", "risk_bucket",
        F.round(F.col("score") * 100, 4).alias("return_probability_percent"),
        F.round(S.decision_confidence(F.col("score")), 6).alias("confidence"), "status")


@queries.query(f"""WITH {B.SCORED}, b AS (SELECT *, {BUCKET} AS risk_bucket,
    round(score * 100, 2) AS pct FROM scored)
  SELECT count(*) AS n_rows, count(*) AS n_scored, round(avg(pct), 4) AS mean_percent,
    round(avg(CASE WHEN risk_bucket = 'High' THEN 1.0 ELSE 0.0 END), 6) AS share_high,
    round(avg(CASE WHEN risk_bucket = 'Low' THEN 1.0 ELSE 0.0 END), 6) AS share_low FROM b""")
def batch_summary(spark, sf):
    return ML.batch_summary(ML.score_batch(_scored(spark, sf), F.col("score"), OPERATING))


def _actions_sql() -> str:
    def q(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    discount = q(C.ACTION_DISCOUNT)
    verdict = " ".join(f"WHEN risk_bucket = '{k}' THEN {q(v)}" for k, v in C.RISK_VERDICTS.items())
    tips = [
        ("risk_bucket = 'High' AND payment_method = 'COD'", q(C.ACTION_PREPAID_ONLY)),
        ("risk_bucket = 'High'", q(C.ACTION_QUALITY_CHECK)),
        ("risk_bucket = 'High' AND fit", q(C.ACTION_SIZE_GUIDE)),
        ("risk_bucket = 'High' AND coalesce(discount_pct, 0) >= 40",
         f"printf({discount}, discount_pct)"),
        ("risk_bucket = 'High' AND delivery_days >= 7", q(C.ACTION_EXPEDITE)),
        ("risk_bucket = 'Medium'", q(C.ACTION_CHECK_IN)),
        ("risk_bucket = 'Medium' AND fit", q(C.ACTION_OFFER_GUIDE)),
        ("risk_bucket = 'Medium' AND payment_method = 'COD'", q(C.ACTION_PREPAID_NUDGE)),
        ("risk_bucket = 'Low'", q(C.ACTION_STANDARD)),
        ("risk_bucket = 'Low'", q(C.ACTION_FAST_TRACK)),
    ]
    entries = ", ".join(f"CASE WHEN {cond} THEN {text} END" for cond, text in tips)
    return f"""WITH {B.SCORED},
      b AS (SELECT *, {BUCKET} AS risk_bucket,
              product_category IN ('Apparel', 'Footwear') AS fit FROM scored)
      SELECT order_id, risk_bucket, CASE {verdict} END AS verdict,
        array_to_string(list_filter([{entries}], lambda x: x IS NOT NULL)[1:5], ' | ') AS actions
      FROM b"""


@queries.query(_actions_sql())
def risk_actions(spark, sf):
    scored = _scored(spark, sf).withColumn("risk_bucket", S.risk_bucket(F.col("score"), F.lit(OPERATING)))
    b = F.col("risk_bucket")
    return scored.select(
        "order_id", "risk_bucket", S.risk_verdict(b).alias("verdict"),
        F.array_join(S.risk_actions(b), " | ").alias("actions"))


@queries.query(f"""WITH {B.SCORED},
  r AS (SELECT order_id, score, row_number() OVER (ORDER BY score, order_id) - 1 AS k,
               count(*) OVER () AS n FROM scored)
  SELECT CASE WHEN p = 0 THEN 'min' WHEN p = 1 THEN 'q1' WHEN p = 2 THEN 'median'
              WHEN p = 3 THEN 'q3' ELSE 'max' END AS pick, order_id, score
  FROM r, range(5) t(p) WHERE k = CASE WHEN p = 4 THEN n - 1 ELSE p * n // 4 END""")
def quantile_picks(spark, sf):
    return M.quantile_rows(staged(_scored(spark, sf).select("order_id", "score")), "order_id")


def _driver_stats_cte() -> str:
    nums = X.NUMERIC_DRIVERS
    parts = [f"SELECT '{f}' AS feature, '' AS level, 'median' AS statistic, "
             f"CAST(median({f}) AS DOUBLE) AS value FROM feats" for f in nums]
    parts += [f"SELECT '{f}', '', 'corr', corr({f}, returned) FROM feats" for f in nums]
    parts += ["SELECT 'payment_method', payment_method, 'rate', avg(returned) FROM feats "
              "GROUP BY payment_method",
              "SELECT '', '', 'overall_rate', avg(returned) FROM feats"]
    return f"stats AS ({' UNION ALL '.join(parts)})"


@queries.query(f"""WITH {B.ORDERS}, {_driver_stats_cte()}
  SELECT feature, level, statistic, round(value, 6) AS value FROM stats""")
def driver_stats(spark, sf):
    return X.driver_stats_table(staged(order_history(spark, sf).select(
        *[f for f, _ in C.DRIVER_FEATURES], "returned")))


# Driver weights of the explanation (impurity importances of a saved forest).
DRIVER_WEIGHTS = {
    "payment_method": 0.269202,
    "price_inr": 0.132267,
    "delivery_distance_km": 0.095675,
    "customer_tenure_days": 0.090013,
    "delivery_days": 0.088449,
}


def _explain_sql() -> str:
    rows = []
    for place, (f, _) in enumerate(C.DRIVER_FEATURES):
        w = DRIVER_WEIGHTS[f]
        if f == "payment_method":
            rows.append(f"""SELECT order_id, {place} AS place, '{f}' AS feature, {w} AS w,
              CASE WHEN r.value > o.value * 1.1 THEN 'up' WHEN r.value < o.value * 0.9 THEN 'down'
                   ELSE 'neutral' END AS direction, r.value AS reference
              FROM feats JOIN stats r ON r.feature = '{f}' AND r.level = payment_method,
                   (SELECT value FROM stats WHERE statistic = 'overall_rate') o""")
        else:
            rows.append(f"""SELECT order_id, {place}, '{f}', {w},
              CASE WHEN abs(c.value) < 0.02 THEN 'neutral'
                   WHEN (c.value > 0) = ({f} > m.value) THEN 'up' ELSE 'down' END, m.value
              FROM feats, (SELECT value FROM stats WHERE feature = '{f}' AND statistic = 'median') m,
                   (SELECT value FROM stats WHERE feature = '{f}' AND statistic = 'corr') c""")
    return f"""WITH {B.ORDERS}, {_driver_stats_cte()},
      long AS ({' UNION ALL '.join(rows)}),
      signed AS (SELECT *, CAST(CASE direction WHEN 'up' THEN w WHEN 'down' THEN -w ELSE 0 END
                 AS DOUBLE) AS s FROM long)
      SELECT order_id, CAST(row_number() OVER (PARTITION BY order_id ORDER BY abs(s) DESC, place)
               AS INTEGER) AS driver_rank, feature, direction, round(s, 6) AS signed_weight,
             round(reference, 6) AS reference FROM signed"""


@queries.query(_explain_sql())
def driver_explain(spark, sf):
    f = staged(order_history(spark, sf).select(
        "order_id", *[f for f, _ in C.DRIVER_FEATURES], "returned"))
    return X.feature_drivers(f, X.driver_stats(f), DRIVER_WEIGHTS)


def _permuted_cte() -> str:
    repeats = [f"""SELECT {r} AS repeat, a.*, {', '.join(f'd.{f} AS d_{f}' for f in S.RULE_INPUTS)}
          FROM ranked a JOIN ranked d
            ON d.k = (a.k - 1 + 1 + {(SEED + r) * 104_729} % greatest(a.total - 1, 1)) % a.total + 1"""
               for r in range(REPEATS)]
    variants = " UNION ALL ".join(
        f"SELECT repeat, '{f}' AS feature, returned, {B.rule_score(**{f: 'd_' + f})} AS score FROM paired"
        for f in S.RULE_INPUTS)
    return f"""{B.SCORED}, ranked AS (SELECT *, count(*) OVER () AS total, row_number() OVER (
        ORDER BY md5(CAST(order_id AS VARCHAR) || ':{SEED}'), order_id) AS k FROM scored),
      paired AS ({' UNION ALL '.join(repeats)}),
      permuted AS ({variants}),
      base AS ({B.auc('scored')}),
      aucs AS ({B.auc('permuted', 'repeat, feature')}),
      drops AS (SELECT feature, base.auc - aucs.auc AS drop_auc FROM aucs, base),
      perm AS (SELECT feature, round(avg(drop_auc), 6) AS importance_mean,
                      round(stddev_pop(drop_auc), 6) AS importance_std FROM drops GROUP BY feature),
      perm_ranked AS (SELECT *, CAST(row_number() OVER (ORDER BY importance_mean DESC, feature)
                             AS INTEGER) AS permutation_rank FROM perm)"""


def _permutation(scored):
    return I.importance_of_aucs(scored, I.permuted_rule_aucs(
        scored, "order_id", S.RULE_INPUTS, REPEATS))


@queries.query(f"WITH {_permuted_cte()} SELECT * FROM perm_ranked")
def permutation_importance(spark, sf):
    scored = staged(_scored(spark, sf).select("order_id", "returned", "score", *S.RULE_INPUTS))
    return _permutation(scored)


NUMERIC_RULE = [f for f in S.RULE_INPUTS if f in C.NUMERIC_FEATURES]


@queries.query()
def importance_comparison(spark, sf):
    scored = staged(_scored(spark, sf).select("order_id", "returned", "score", *S.RULE_INPUTS))
    impurity = I.impurity_by_source(I.separation_importance(scored, NUMERIC_RULE, "order_id"))
    return I.compare_importances(impurity, _permutation(scored))


# Report figures with four digits, one of them out of date.
@queries.query(f"""WITH {B.SWEEP}, figures AS (SELECT threshold, f1,
    CASE WHEN threshold = 0.5 THEN 0.0 ELSE round(f1, 4) END AS stored FROM sweep)
  SELECT threshold, round(f1, 4) AS fresh, stored,
    CASE WHEN abs(round(f1, 4) - stored) <= 0.00005 THEN 1 ELSE 0 END AS agrees FROM figures""")
def recheck_results(spark, sf):
    """Recomputed F1 against the figures of a CSV report that was written before."""
    path = new_folder(spark, "report")
    fresh = M.sweep(M.score_cube(_scored(spark, sf))).select(
        "threshold", F.round("f1", 4).alias("f1"))
    fresh = staged(fresh)
    csv_report(fresh.withColumn("f1", F.when(F.col("threshold") == 0.5, 0.0).otherwise(
        F.col("f1"))), path)
    stored = spark.read.schema("threshold double, f1 double").option("header", True).csv(path)
    return M.compare_results(fresh, stored, ["threshold"], "f1", 0.00005)


@queries.query(f"""WITH {B.ORDERS}, need AS (SELECT order_id * 2 AS order_id FROM feats)
  SELECT need.order_id, f.price_inr, f.payment_method,
         CASE WHEN f.order_id IS NULL THEN 'not found' ELSE 'found' END AS lookup
  FROM need LEFT JOIN feats f ON f.order_id = need.order_id""")
def order_lookup(spark, sf):
    history = staged(order_history(spark, sf).select("order_id", "price_inr", "payment_method"))
    asked = history.select((F.col("order_id") * 2).alias("order_id"))
    dim = history.withColumn("hit", F.lit(1))
    return R.skewed_lookup(asked, dim, "order_id").select(
        "order_id", "price_inr", "payment_method",
        F.when(F.col("hit") == 1, "found").otherwise("not found").alias("lookup"))
