"""SQL building blocks of the oracles: the order table, the score, the split."""

from __future__ import annotations

from orderlens import constants as C

ORDERS = """
lines AS (
  SELECT l_orderkey, count(*) AS n_lines,
         sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_ret,
         sum(CAST(round(l_discount * 100) AS BIGINT)) AS pts,
         sum(CAST(l_quantity AS BIGINT)) AS qty, max(l_shipdate) AS last_ship
  FROM lineitem GROUP BY l_orderkey),
labelled AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority,
         n_lines, pts, qty, last_ship,
         CASE WHEN 2 * n_ret >= n_lines THEN 1 ELSE 0 END AS returned
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey),
feats AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'Apparel' WHEN 'AUTOMOBILE' THEN 'Electronics'
      WHEN 'FURNITURE' THEN 'Home' WHEN 'MACHINERY' THEN 'Footwear'
      WHEN 'HOUSEHOLD' THEN 'Beauty' END AS product_category,
    round(o_totalprice / 10) AS price_inr,
    coalesce(floor((20 * pts + n_lines) / (2 * n_lines)) / 10.0, 0.0)::DOUBLE AS discount_pct,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'COD' WHEN '2-HIGH' THEN 'Prepaid_Card'
      WHEN '3-MEDIUM' THEN 'Prepaid_UPI' WHEN '4-NOT SPECIFIED' THEN 'Wallet'
      WHEN '5-LOW' THEN 'COD' END AS payment_method,
    CAST(date_diff('day', min(o_orderdate) OVER (PARTITION BY o_custkey)::DATE,
                   o_orderdate::DATE) AS BIGINT) AS customer_tenure_days,
    CAST(count(*) OVER past AS BIGINT) AS num_previous_orders,
    CAST(coalesce(sum(returned) OVER past, 0) AS BIGINT) AS num_previous_returns,
    round(abs(c_acctbal) * 2) / 10.0 AS delivery_distance_km,
    CAST(greatest(1, least(21, coalesce(1 + floor(
      abs(date_diff('day', o_orderdate::DATE, last_ship::DATE)) / 120), 1))) AS BIGINT)
      AS delivery_days,
    CASE WHEN isodow(o_orderdate) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend_order,
    CAST(1 + qty % 5 AS DOUBLE) AS rating_given,
    returned
  FROM labelled LEFT JOIN customer ON c_custkey = o_custkey
  WINDOW past AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def rule_score(**override: str) -> str:
    """The rule score as SQL, with single columns replaced by other expressions."""
    def c(name: str) -> str:
        return override.get(name, name)

    ratio = (f"coalesce(CAST({c('num_previous_returns')} AS DOUBLE) / "
             f"nullif({c('num_previous_orders')}, 0), 0.0)")
    return f"""round(1 / (1 + exp(-(
      -2.2 + 1.9 * {ratio}
      + 0.55 * (CASE WHEN {c('product_category')} IN ('Apparel', 'Footwear') THEN 1.0 ELSE 0.0 END)
      + 0.014 * ({c('discount_pct')} - 20) / 10
      + 0.9 * (CASE WHEN {c('payment_method')} = 'COD' THEN 1.0 ELSE 0.0 END)
      + 0.10 * ({c('delivery_days')} - 4.5) / 2
      + 0.30 * ({c('price_inr')} / 45000)
      + 0.05 * {c('is_weekend_order')}
      - 0.15 * tanh({c('customer_tenure_days')} / 500)))), 6)"""


SCORED = f"{ORDERS},\nscored AS (SELECT *, {rule_score()} AS score FROM feats)"

SPLIT = f"""{SCORED},
hashed AS (
  SELECT *, row_number() OVER (PARTITION BY returned
              ORDER BY md5(CAST(order_id AS VARCHAR) || ':{C.SPLIT_SEED}'), order_id) AS hash_rank,
         count(*) OVER (PARTITION BY returned) AS class_size
  FROM scored),
parts AS (
  SELECT *, CASE WHEN hash_rank <= (20 * class_size * 2 + 100) // 200 THEN 'test'
                 ELSE 'train' END AS split
  FROM hashed)"""

GRID = "grid AS (SELECT (10 + 2 * i) / 100.0 AS threshold FROM range(41) t(i))"


def metrics(tp: str = "tp", fp: str = "fp", fn: str = "fn") -> str:
    """precision, recall and f1 columns from counts."""
    return f"""
    round(coalesce(CAST({tp} AS DOUBLE) / nullif({tp} + {fp}, 0), 0.0), 6) AS precision,
    round(coalesce(CAST({tp} AS DOUBLE) / nullif({tp} + {fn}, 0), 0.0), 6) AS recall,
    round(coalesce(CAST(2 * {tp} AS DOUBLE) / nullif(2 * {tp} + {fp} + {fn}, 0), 0.0), 6) AS f1"""


SWEEP = f"""{SCORED},
{GRID},
counts AS (
  SELECT threshold, count(*) FILTER (WHERE score >= threshold) AS n_flagged,
         count(*) FILTER (WHERE score >= threshold AND returned = 1) AS tp,
         count(*) FILTER (WHERE score >= threshold AND returned = 0) AS fp,
         count(*) FILTER (WHERE score < threshold AND returned = 1) AS fn,
         count(*) FILTER (WHERE score < threshold AND returned = 0) AS tn
  FROM scored, grid GROUP BY threshold),
sweep AS (
  SELECT threshold, {metrics()}, n_flagged, tp, fp, fn, tn,
         round(CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn), 6) AS accuracy
  FROM counts)"""


def auc(source: str, by: str = "") -> str:
    """Mann-Whitney AUC with average ranks for ties, grouped by ``by`` (a column list)."""
    part = f"PARTITION BY {by}" if by else ""
    keep = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
    SELECT {keep} CAST(sum(returned) AS BIGINT) AS positives,
           CAST(sum(1 - returned) AS BIGINT) AS negatives,
           round((sum(CASE WHEN returned = 1 THEN avg_rank END)
             - CAST(sum(returned) AS DOUBLE) * (sum(returned) + 1) / 2)
             / nullif(CAST(sum(returned) AS DOUBLE) * sum(1 - returned), 0), 6) AS auc
    FROM (SELECT *, rank() OVER ({part} ORDER BY score)
                  + (count(*) OVER (PARTITION BY {keep} score) - 1) / 2.0 AS avg_rank
          FROM {source}) {group}"""
