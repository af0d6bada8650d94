"""Retrieval queries: chunks, lexical top-k, roll-up, gate, calibration, evaluation, answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens import constants as C
from orderlens.functions import text as T
from orderlens.operators import answers as A
from orderlens.operators import catalog as K
from orderlens.operators import retrieval as R
from orderlens.operators import routing as G
from orderlens.plans.registry import Registry
from orderlens.session import once, staged
from orderlens.sources.readers import spread, table

queries = Registry()

TOKENS = r"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}]+')"


def strip_sql(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def sentences_sql(x: str) -> str:
    parts = (rf"string_split(regexp_replace({strip_sql(x)}, '([.!?])\s+', '\1' || chr(1), 'g'), "
             "chr(1))")
    return (f"list_filter(list_transform({parts}, lambda s: {strip_sql('s')}), "
            "lambda s: s <> '')")


CHUNKS = f"""
split_docs AS (SELECT doc_id, {sentences_sql('text')} AS parts FROM documents),
chunks AS (SELECT doc_id, unnest(parts) AS chunk_text,
                  CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS pos FROM split_docs)"""


def tfidf(corpus: str, key: str, text: str, query_source: str) -> str:
    """TF-IDF cosine of (query_id, text) rows against a corpus table, as CTEs up to ``pool``."""
    return f"""
post AS (SELECT {key}, term, count(*) AS tf FROM (
  SELECT {key}, unnest({TOKENS.format(x=text)}) AS term FROM {corpus}) GROUP BY ALL),
nn AS (SELECT count(*) AS n FROM {corpus}),
idf AS (SELECT term, ln(CAST(1 + n AS DOUBLE) / (1 + count(*))) + 1 AS idf
        FROM post, nn GROUP BY term, n),
cv AS (SELECT {key}, term, tf * idf AS w FROM post JOIN idf USING (term)),
cn AS (SELECT {key}, sqrt(sum(w * w)) AS length FROM cv GROUP BY ALL),
qsource AS ({query_source}),
qpost AS (SELECT query_id, term, count(*) AS tf FROM (
  SELECT query_id, unnest({TOKENS.format(x='text')}) AS term FROM qsource) GROUP BY ALL),
qv AS (SELECT query_id, term, tf * coalesce(idf, ln(1 + n) + 1) AS w
       FROM qpost LEFT JOIN idf USING (term), nn),
qn AS (SELECT query_id, sqrt(sum(w * w)) AS length FROM qv GROUP BY ALL),
dots AS (SELECT query_id, {key}, sum(qv.w * cv.w) AS s FROM qv JOIN cv USING (term)
         GROUP BY ALL),
scores AS (SELECT query_id, {key}, round(s / (qn.length * cn.length), 9) AS raw
           FROM dots JOIN qn USING (query_id) JOIN cn USING ({key})),
pool AS (SELECT query_id, {key}, round(raw, 4) AS score,
           CAST(row_number() OVER (PARTITION BY query_id ORDER BY raw DESC, {key}) AS INTEGER)
             AS rank
         FROM scores WHERE raw > 0
         QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY raw DESC, {key}) <= 12)"""


POOL = f"{CHUNKS},{tfidf('chunks', 'doc_id, pos', 'chunk_text', 'SELECT item_id AS query_id, text FROM benchmark')}"
DOCS = f"""{POOL},
best AS (SELECT query_id, doc_id, score, rank, pos FROM pool
         QUALIFY row_number() OVER (PARTITION BY query_id, doc_id ORDER BY score DESC, rank) = 1),
rolled AS (SELECT query_id, doc_id, score, pos AS best_pos,
             CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, rank) AS INTEGER)
               AS doc_rank FROM best)"""
RELEVANT = f"""
own AS (SELECT DISTINCT item_id AS query_id, unnest({sentences_sql('text')}) AS chunk_text
        FROM benchmark),
own_size AS (SELECT query_id, count(*) AS n FROM own GROUP BY query_id),
relevant AS (SELECT query_id, doc_id FROM (SELECT DISTINCT doc_id, chunk_text FROM chunks)
             JOIN own USING (chunk_text) JOIN own_size USING (query_id)
             GROUP BY query_id, doc_id, n HAVING count(*) >= 0.5 * n)"""


def _queries(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def chunk_rows(spark, sf):
    return once(spark, sf, "chunks", lambda: staged(R.chunks(spread(
        table(spark, sf, "documents").select("doc_id", "text")))))


def chunk_index(spark, sf):
    """The lexical index of all chunks."""
    return once(spark, sf, "chunk index",
                lambda: R.LexicalIndex.build(chunk_rows(spark, sf)).kept())


def product_index(spark, sf):
    """The lexical index of the catalog's searchable texts, one vector per distinct text."""
    return once(spark, sf, "product index", lambda: R.LexicalIndex.build_merged(
        catalog(spark, sf).select(
            F.col("product_id").alias("doc_id"), F.lit(0).alias("pos"),
            K.searchable_text().alias("chunk_text"))).kept())


def _pool(spark, sf):
    return chunk_index(spark, sf).search(_queries(spark, sf))


@queries.query(rf"""WITH {CHUNKS}
  SELECT doc_id, pos, chunk_text,
         CAST(doc_id AS VARCHAR) || '::s' || CASE WHEN pos < 10 THEN '0' ELSE '' END
           || CAST(pos AS VARCHAR) AS chunk_id FROM chunks""")
def chunks(spark, sf):
    return chunk_rows(spark, sf)


@queries.query(rf"""WITH {CHUNKS}, c AS (SELECT doc_id, count(*) AS n, min(pos) AS low, max(pos) AS high,
    count(DISTINCT pos) AS places FROM chunks GROUP BY doc_id)
  SELECT 'chunks without a document' AS check_name, count(*) FILTER (WHERE d.doc_id IS NULL) AS n
    FROM c LEFT JOIN documents d USING (doc_id)
  UNION ALL SELECT 'documents without a chunk', count(*) FILTER (WHERE c.doc_id IS NULL)
    FROM documents d LEFT JOIN c USING (doc_id)
  UNION ALL SELECT 'documents with a gap', count(*) FILTER (WHERE low <> 0 OR high + 1 <> n) FROM c
  UNION ALL SELECT 'documents with a repeated place', count(*) FILTER (WHERE places <> n) FROM c""")
def chunk_checks(spark, sf):
    """Every chunk has its document, every document its chunks, in places without a gap."""
    return R.chunk_checks(chunk_rows(spark, sf), table(spark, sf, "documents"))


_NESTED = 40  # chunks in a segment


@queries.query(rf"""WITH {CHUNKS}
  SELECT doc_id, CAST(pos // {_NESTED} AS BIGINT) AS segment,
    CASE WHEN pos // {_NESTED} > 0 THEN CAST(pos // {_NESTED} - 1 AS BIGINT) END AS previous,
    count(*) AS n, md5(string_agg(CAST(doc_id AS VARCHAR) || '::s' || CASE WHEN pos < 10 THEN '0'
      ELSE '' END || CAST(pos AS VARCHAR) || ' ' || chunk_text, chr(10) ORDER BY pos)) AS digest
  FROM chunks GROUP BY doc_id, pos // {_NESTED}""")
def documentchunk_rows(spark, sf):
    """Documents with their chunks nested in linked segments."""
    lines = F.transform("chunks", lambda c: F.concat(c["chunk_id"], F.lit(" "), c["chunk_text"]))
    return R.nested_chunks(chunk_rows(spark, sf), _NESTED).select(
        "doc_id", "segment", "previous", "n", F.md5(F.array_join(lines, "\n")).alias("digest"))


@queries.query(f"WITH {POOL} SELECT * FROM pool")
def lexical_topk(spark, sf):
    return _pool(spark, sf)


@queries.query(f"WITH {DOCS} SELECT * FROM rolled")
def doc_rollup(spark, sf):
    return R.to_documents(_pool(spark, sf))


@queries.query(f"WITH {DOCS} SELECT * FROM rolled WHERE doc_rank <= 3")
def search_documents(spark, sf):
    return R.search_documents(_pool(spark, sf))


GATED = """
gated AS (SELECT q.query_id, CASE WHEN coalesce(max(score), 0.0) >= 0.45 THEN 1 ELSE 0 END
            AS grounded, coalesce(max(score), 0.0) AS best_score,
            CAST(0.45 AS DOUBLE) AS threshold, count(score) AS n_chunks_considered
          FROM qsource q LEFT JOIN pool p ON p.query_id = q.query_id AND p.rank <= 3
          GROUP BY q.query_id)"""


@queries.query(f"WITH {POOL}, {GATED} SELECT * FROM gated")
def groundedness(spark, sf):
    top = _pool(spark, sf).where(F.col("rank") <= C.TOP_K)
    return R.groundedness(_queries(spark, sf), top)


@queries.query(f"""WITH {POOL}, {GATED}, {RELEVANT},
  marked AS (SELECT g.*, g.query_id IN (SELECT query_id FROM relevant) AS inside FROM gated g),
  a AS (SELECT count(*) FILTER (WHERE inside) AS n_in, count(*) FILTER (WHERE NOT inside) AS n_out,
      min(best_score) FILTER (WHERE inside) AS in_min, max(best_score) FILTER (WHERE inside) AS in_max,
      round(avg(best_score) FILTER (WHERE inside), 6) AS in_mean,
      min(best_score) FILTER (WHERE NOT inside) AS out_min,
      max(best_score) FILTER (WHERE NOT inside) AS out_max,
      round(avg(best_score) FILTER (WHERE NOT inside), 6) AS out_mean FROM marked)
  SELECT *, round(in_min - out_max, 4) AS gap, round((in_min + out_max) / 2, 6) AS midpoint,
         CASE WHEN out_max < 0.45 AND 0.45 <= in_min THEN 1 ELSE 0 END AS separates FROM a""")
def calibration(spark, sf):
    chunk_table, wanted = chunk_rows(spark, sf), _queries(spark, sf)
    top = chunk_index(spark, sf).search(wanted).where(F.col("rank") <= C.TOP_K)
    inside = R.relevant_by_sentence(wanted, chunk_table).select("query_id").distinct().withColumn(
        "inside", F.lit(True))
    gated = R.groundedness(wanted, top).join(inside, "query_id", "left")
    return R.calibration(gated, F.coalesce("inside", F.lit(False)))


def _scores_sql(docs: str) -> str:
    return f"""WITH {DOCS}, {RELEVANT}, agent_best AS (
        SELECT query_id, doc_id, max(score) AS score FROM pool WHERE rank <= 3 GROUP BY ALL),
      retrieved AS ({docs}),
      hits AS (SELECT query_id, count(*) AS n FROM retrieved JOIN relevant
               USING (query_id, doc_id) GROUP BY query_id),
      sizes AS (SELECT query_id, count(*) AS n FROM relevant GROUP BY query_id),
      per AS (SELECT q.query_id, coalesce(h.n, 0) AS n_hits, coalesce(s.n, 0) AS n_relevant,
                coalesce(h.n, 0) / 3.0::DOUBLE AS precision_at_k,
                coalesce(CAST(coalesce(h.n, 0) AS DOUBLE) / nullif(s.n, 0), 0.0) AS recall_at_k
              FROM qsource q LEFT JOIN hits h USING (query_id) LEFT JOIN sizes s USING (query_id))"""


TOP3_DOCS = "SELECT query_id, doc_id FROM rolled WHERE doc_rank <= 3"


@queries.query(f"{_scores_sql(TOP3_DOCS)} SELECT * FROM per")
def retrieval_scores(spark, sf):
    chunk_table, wanted = chunk_rows(spark, sf), _queries(spark, sf)
    docs = R.search_documents(chunk_index(spark, sf).search(wanted))
    return R.retrieval_scores(wanted, docs, R.relevant_by_sentence(wanted, chunk_table))


_MEANS = """SELECT count(*) AS n_queries, round(avg(precision_at_k), 6) AS mean_precision,
  round(avg(recall_at_k), 6) AS mean_recall FROM per"""


@queries.query(f"{_scores_sql(TOP3_DOCS)} {_MEANS}")
def retrieval_eval(spark, sf):
    return R.macro_means(retrieval_scores(spark, sf))


@queries.query(f"{_scores_sql('SELECT query_id, doc_id FROM agent_best')} {_MEANS}")
def retrieval_eval_agent(spark, sf):
    chunk_table, wanted = chunk_rows(spark, sf), _queries(spark, sf)
    docs = R.agent_documents(chunk_index(spark, sf).search(wanted))
    return R.macro_means(R.retrieval_scores(
        wanted, docs, R.relevant_by_sentence(wanted, chunk_table)))


# The first phrase pools, and CRC-32 spelled out over the UTF-8 bytes.
def _pool_sql(pool: list[str]) -> str:
    return "[" + ", ".join("'" + p.replace("'", "''") + "'" for p in pool) + "]"


CRC = """
bytes AS (SELECT query_id, text, list_transform(range(octet_length(encode(text))),
    lambda i: CAST('0x' || substr(hex(encode(text)), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))
    AS b FROM qsource),
crc AS (SELECT query_id, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
    lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)),
      lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)),
    4294967295::BIGINT) AS crc FROM bytes)"""

INTENT = "CASE query_id % 3 WHEN 1 THEN 'comparison' WHEN 2 THEN 'explanation' ELSE 'policy' END"
REFUSAL = C.REFUSAL_TEXT.replace("{shop}", A.SHOP).replace("'", "''")


@queries.query(rf"""WITH {POOL}, {CRC},
  intents AS (SELECT query_id, text, {INTENT} AS fine FROM qsource),
  used AS (SELECT p.* FROM pool p JOIN intents USING (query_id)
           WHERE p.rank <= CASE WHEN fine = 'comparison' THEN 8 ELSE 3 END),
  b AS (SELECT * FROM used QUALIFY row_number() OVER (
          PARTITION BY query_id, doc_id ORDER BY score DESC, rank) = 1),
  docs AS (SELECT query_id, score, row_number() OVER (PARTITION BY query_id
             ORDER BY score DESC, rank) AS r, 'Document ' || doc_id AS title,
             doc_id, 'Document ' || doc_id || ' (' || doc_id || ')' AS cite, chunk_text
           FROM b JOIN chunks USING (doc_id, pos)),
  lists AS (SELECT query_id, count(*) AS n, max(score) AS best,
      max(CASE WHEN r = 1 THEN score END) AS s1, max(CASE WHEN r = 2 THEN score END) AS s2,
      list(cite ORDER BY r) AS cites, list(chunk_text ORDER BY r) AS texts,
      list(title || ' — ' || chunk_text ORDER BY r) AS sides, list(score ORDER BY r) AS ss
    FROM docs GROUP BY query_id),
  shaped AS (SELECT q.query_id, fine, l.*, coalesce(l.best, 0.0) AS best_score,
      CASE WHEN s1 - s2 <= 0.05 AND s2 >= 0.45 THEN 2 ELSE 1 END AS nq, crc
    FROM intents q LEFT JOIN lists l USING (query_id) JOIN crc USING (query_id)),
  worded AS (SELECT *, CASE
      WHEN best_score >= 0.45 AND fine = 'comparison' AND n >= 2 THEN
        'Comparing what''s documented: ' || array_to_string(sides[1:4], '  |  ')
        || ' [Source: ' || array_to_string(cites[1:4], ', ') || ']'
      WHEN best_score >= 0.45 THEN
        CASE WHEN fine = 'explanation' THEN {_pool_sql(C.LEAD_INS_EXPLANATION)}[crc % 4 + 1]
             ELSE {_pool_sql(C.LEAD_INS)}[crc % 5 + 1] END || ' '
        || array_to_string(texts[1:nq], ' ') || ' [Source: '
        || array_to_string(cites[1:nq], ', ') || ']'
        || coalesce(' [Related policies: ' || nullif(array_to_string(list_filter(
             cites[nq + 1:], lambda c, i: ss[nq + i] >= 0.45), ', '), '') || ']', '')
      ELSE printf('{REFUSAL}', best_score, 0.45::DOUBLE) END AS raw FROM shaped)
  SELECT query_id, fine AS fine_intent,
    {strip_sql(r"regexp_replace(raw, '\s+', ' ', 'g')")} AS answer, 'policy_kb' AS source,
    round(best_score, 4) AS confidence,
    CASE WHEN best_score >= 0.45 THEN 'grounded_response' ELSE 'safe_refusal' END AS outcome
  FROM worded""")
def policy_answers(spark, sf):
    """Questions answered from the documents; the intent is derived from the item number."""
    chunk_table = chunk_rows(spark, sf).select("doc_id", "pos", "chunk_text")
    q = F.col("query_id")
    turns = _queries(spark, sf).withColumn(
        "fine_intent", F.when(q % 3 == 1, "comparison").when(q % 3 == 2, "explanation")
        .otherwise("policy"))
    pool = staged(chunk_index(spark, sf).search(turns))
    used = pool.join(turns.select("query_id", "fine_intent"), "query_id").where(
        F.col("rank") <= G.pool_size(F.col("fine_intent")))
    docs = R.to_documents(used)
    texts = chunk_table.select("doc_id", F.col("pos").alias("best_pos"),
                               F.col("chunk_text").alias("best_text"))
    hits = docs.join(texts, ["doc_id", "best_pos"]).withColumn(
        "title", F.format_string("Document %d", "doc_id"))
    ready = turns.join(R.groundedness(turns, used), "query_id").join(
        A.hit_arrays(hits), "query_id", "left")
    outcome = G.outcome(F.lit(0), F.lit("policy"), F.lit(""), F.lit(0), F.col("grounded"))
    return A.compose_policy_lane(ready).select(
        "query_id", "fine_intent", "response.answer", "response.source", "response.confidence",
        outcome.alias("outcome"))


CATALOG = """
catalog AS (SELECT p_partkey AS product_id, p_name AS product_name,
  CASE p_type WHEN 'STANDARD' THEN 'Apparel' WHEN 'MEDIUM' THEN 'Footwear'
    WHEN 'PROMO' THEN 'Electronics' WHEN 'LARGE' THEN 'Home' WHEN 'SMALL' THEN 'Beauty'
    ELSE 'Apparel' END AS category,
  string_split(p_name, ' ')[-1] AS subcategory, p_retailprice AS price,
  CASE p_size % 3 WHEN 0 THEN 0 WHEN 1 THEN 7 ELSE 10 END AS return_window,
  p_size % 2 = 0 AS exchange_available, p_size % 5 <> 0 AS cod_available,
  p_size % 3 = 0 AS non_returnable, p_brand AS description FROM part)"""
# Part type -> category level.
CATEGORY_OF_TYPE = {
    "STANDARD": "Apparel",
    "MEDIUM": "Footwear",
    "PROMO": "Electronics",
    "LARGE": "Home",
    "SMALL": "Beauty",
    "ECONOMY": "Apparel",
}


def catalog(spark, sf):
    size = F.col("p_size")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        T.first_rule([(F.col("p_type") == k, v) for k, v in CATEGORY_OF_TYPE.items()],
                     F.lit("Apparel")).alias("category"),
        F.element_at(F.split("p_name", " "), -1).alias("subcategory"),
        F.col("p_retailprice").alias("price"),
        F.when(size % 3 == 0, 0).when(size % 3 == 1, 7).otherwise(10).alias("return_window"),
        (size % 2 == 0).alias("exchange_available"), (size % 5 != 0).alias("cod_available"),
        (size % 3 == 0).alias("non_returnable"), F.col("p_brand").alias("description"))


@queries.query(f"""WITH {CATALOG} SELECT product_id, product_name, price, return_window FROM catalog
  WHERE lower(category) = 'footwear' AND cod_available AND return_window <= 7""")
def catalog_filter(spark, sf):
    return K.filter_products(catalog(spark, sf), category="footwear", cod_available=True,
                             max_return_window=7).select(
        "product_id", "product_name", "price", "return_window")


@queries.query(f"WITH {CATALOG} SELECT DISTINCT category FROM catalog")
def catalog_categories(spark, sf):
    return catalog(spark, sf).select("category").distinct().orderBy("category")


QUESTIONS = """
questions AS (SELECT p_partkey AS query_id, CASE p_partkey % 5
    WHEN 0 THEN 'Which products have a ' || p_size || '-day return window?'
    WHEN 1 THEN 'Which ' || lower(c.category) || ' products support cash on delivery?'
    WHEN 2 THEN 'Show me ' || c.category || ' products that are non-returnable within '
                || p_size || ' days'
    WHEN 3 THEN 'Can I exchange a ' || p_name || '?'
    ELSE 'Tell me about the ' || p_name END AS text
  FROM part JOIN catalog c ON c.product_id = p_partkey)"""


def questions(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size")
    c = catalog(spark, sf).select(
        F.col("product_id").alias("p_partkey"), "category", "product_name")
    joined = c.join(p, "p_partkey")
    kind = F.col("p_partkey") % 5
    return joined.select(
        F.col("p_partkey").alias("query_id"),
        F.when(kind == 0, F.format_string(
            "Which products have a %d-day return window?", "p_size"))
        .when(kind == 1, F.format_string(
            "Which %s products support cash on delivery?", F.lower("category")))
        .when(kind == 2, F.format_string(
            "Show me %s products that are non-returnable within %d days", "category", "p_size"))
        .when(kind == 3, F.format_string("Can I exchange a %s?", "product_name"))
        .otherwise(F.format_string("Tell me about the %s", "product_name")).alias("text"))


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _named(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q('(?i)' + pattern)})"


ASKED = f"""
asked AS (SELECT query_id, text, CASE
      WHEN {_named('text', C.NON_RETURNABLE_PATTERN)} THEN 'non_returnable'
      WHEN {_named('text', C.COD_PATTERN)} THEN 'cod_available'
      WHEN {_named('text', C.EXCHANGE_PATTERN)} THEN 'exchange_available' END AS want_kind,
    CASE WHEN contains(lower(text), 'window') OR contains(lower(text), 'return')
      THEN TRY_CAST(nullif(regexp_extract(text, {q('(?i)' + C.DAY_WINDOW_PATTERN)}, 1), '')
        AS INTEGER) END AS want_window,
    CASE WHEN contains(lower(text), 'apparel') THEN 'Apparel'
      WHEN contains(lower(text), 'footwear') THEN 'Footwear'
      WHEN contains(lower(text), 'electronics') THEN 'Electronics'
      WHEN contains(lower(text), 'home') THEN 'Home'
      WHEN contains(lower(text), 'beauty') THEN 'Beauty' END AS want_category
    FROM questions)"""
MEETS = """coalesce(want_kind, CAST(want_window AS VARCHAR), want_category) IS NOT NULL
   AND (want_kind IS NULL OR (want_kind = 'non_returnable' AND non_returnable)
        OR (want_kind = 'cod_available' AND cod_available)
        OR (want_kind = 'exchange_available' AND exchange_available))
   AND (want_window IS NULL OR return_window <= want_window)
   AND (want_category IS NULL OR category = want_category)"""


@queries.query(f"""WITH {CATALOG}, {QUESTIONS}, {ASKED}
  SELECT a.query_id, want_kind, want_window, want_category, count(c.product_id) AS n_matches,
         min(c.product_id) AS first_product
  FROM asked a LEFT JOIN catalog c ON {MEETS} GROUP BY ALL""")
def catalog_questions(spark, sf):
    return K.matched_products(questions(spark, sf), catalog(spark, sf))


NAMES = ("SELECT min(p_partkey) AS query_id, p_name || ' ' || p_brand AS text FROM part "
         "GROUP BY p_name, p_brand")
SEARCHABLE = (", texts AS (SELECT product_id AS doc_id, CAST(0 AS INTEGER) AS pos, product_name || ' -- ' || "
              "subcategory || ', ' || category || '. ' || description AS body FROM catalog)")


@queries.query(f"""WITH {CATALOG}{SEARCHABLE},{tfidf('texts', 'doc_id, pos', 'body', NAMES)}
  SELECT query_id, doc_id AS product_id, score, rank FROM pool WHERE rank <= 5 AND score >= 0.45""")
def product_search(spark, sf):
    products = catalog(spark, sf)
    wanted = products.groupBy("product_name", "description").agg(
        F.min("product_id").alias("query_id")).select(
        "query_id", F.concat_ws(" ", "product_name", "description").alias("text"))
    return K.search_products(product_index(spark, sf), wanted).select(
        "query_id", F.col("doc_id").alias("product_id"), "score", "rank")


_OPEN = "SELECT query_id, text FROM questions WHERE query_id NOT IN (SELECT query_id FROM hit)"


@queries.query(f"""WITH {CATALOG}, {QUESTIONS}, {ASKED},
  hit AS (SELECT a.query_id, c.product_id, count(*) OVER (PARTITION BY a.query_id) AS n,
      row_number() OVER (PARTITION BY a.query_id ORDER BY c.product_id) AS r
    FROM asked a JOIN catalog c ON {MEETS} QUALIFY r <= 5){SEARCHABLE},
  {tfidf('texts', 'doc_id, pos', 'body', _OPEN)},
  near AS (SELECT query_id, doc_id AS product_id, rank AS r,
      count(*) OVER (PARTITION BY query_id) AS n
    FROM pool WHERE rank <= 5 AND score >= 0.45),
  found AS (SELECT *, 'criteria' AS how FROM hit
    UNION ALL SELECT query_id, product_id, n, r, 'similar' FROM near),
  told AS (SELECT query_id, how, n, printf('%d product(s) match: ', n) || string_agg(
      product_name || ' {{price: ₹' || printf('%.2f', CAST(price AS DOUBLE)) || ', ' ||
      CASE WHEN non_returnable THEN 'returns: no'
        ELSE 'returns: ' || return_window || ' days' END
      || ', exchange: ' || CASE WHEN exchange_available THEN 'yes' ELSE 'no' END
      || ', cash on delivery: ' || CASE WHEN cod_available THEN 'yes' ELSE 'no' END || '}}',
      '; ' ORDER BY r) AS answer
    FROM found JOIN catalog USING (product_id) GROUP BY query_id, how, n)
  SELECT q.query_id, coalesce(how, 'none') AS how, coalesce(n, 0) AS n_matches, answer
  FROM questions q LEFT JOIN told USING (query_id)""")
def product_answers(spark, sf):
    """Catalog questions answered: criteria first, else the nearest products, in words."""
    products = catalog(spark, sf)
    found = K.first_products(staged(questions(spark, sf)), products,
                             product_index(spark, sf))
    return found.select(
        "query_id", "how", "n_matches",
        F.when(F.col("how") != "none", A.product_answer(F.col("products"), F.col("n_matches")))
        .alias("answer"))
