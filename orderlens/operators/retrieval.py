"""Chunks, TF-IDF index, exact top-k retrieval, document roll-up, gates and evaluation."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens import constants as C
from orderlens.functions import text as T
from orderlens.functions.scoring import guarded_ratio
from orderlens.operators.ordering import (HOT_KEYS, all_of, segmented_lists, skewed_lookup,
                                           top_per_group)
from orderlens.operators.topk import merged_hits, sparse_top_k
from orderlens.session import staged


def chunks(documents: DataFrame, identifier: str = "doc_id", text: str = "text",
           *extra: str) -> DataFrame:
    """One row per sentence with a pointer to its document."""
    return documents.select(
        F.col(identifier).alias("doc_id"), *extra,
        F.posexplode(T.sentences(F.col(text))).alias("pos", "chunk_text"),
    ).withColumn("chunk_id", chunk_id())


def chunk_id() -> Column:
    return F.format_string("%s::s%02d", F.col("doc_id").cast("string"), F.col("pos"))


def nested_chunks(chunk_table: DataFrame, size: int = 1000) -> DataFrame:
    """Documents with their chunks nested, at most ``size`` in a row: doc_id, segment, the
    segment before, the number of chunks and the chunks as (position, chunk_id, chunk_text)."""
    named = chunk_table.withColumn("chunk_id", chunk_id())
    return segmented_lists(named, ["doc_id"], F.col("pos"), ["chunk_id", "chunk_text"], size,
                           "chunks")


def chunk_checks(chunk_table: DataFrame, documents: DataFrame) -> DataFrame:
    """(check_name, n): chunks whose document is missing, documents without chunks, and those
    whose places have gaps or repeats, all from one count per document."""
    held = chunk_table.groupBy("doc_id").agg(
        F.count("*").alias("n"), F.min("pos").alias("low"), F.max("pos").alias("high"),
        F.count_distinct("pos").alias("places"))
    both = held.join(documents.select("doc_id", F.lit(1).alias("known")), "doc_id", "full")
    has = F.col("n").isNotNull()
    counted = both.agg(*[F.count_if(F.coalesce(bad, F.lit(False))).alias(name) for name, bad in {
        "chunks without a document": F.col("known").isNull(),
        "documents without a chunk": ~has,
        "documents with a gap": has & ((F.col("low") != 0) | (F.col("high") + 1 != F.col("n"))),
        "documents with a repeated place": has & (F.col("places") != F.col("n"))}.items()])
    return counted.unpivot([], counted.columns, "check_name", "n")


# The row marker counts rows in the same pass as the terms; tokens are never empty.
ROW_MARK = ""
MAX_VOCABULARY = 1_000_000
MAX_SENTENCES = 100_000


def token_rows(rows: DataFrame, key: list[str], text: str) -> DataFrame:
    """(key, tokens), tokens in text order with repeats."""
    return rows.select(*key, T.tokens(F.col(text)).alias("tokens"))


def document_frequency(tokens: DataFrame, copies: str | None = None) -> DataFrame:
    """(term, df); the row for ROW_MARK holds the number of rows. ``copies`` names the column
    that says for how many equal rows a row stands, where that is not one."""
    seen = F.array_append(F.array_distinct("tokens"), F.lit(ROW_MARK))
    n = F.lit(1) if copies is None else F.col(copies)
    return tokens.select(F.explode(seen).alias("term"), n.alias("_n")).groupBy("term").agg(
        F.sum("_n").alias("df"))


def idf(n: Column, df: Column) -> Column:
    return F.log((1 + n).cast("double") / (1 + df)) + 1


def idf_table(frequencies: DataFrame) -> DataFrame:
    """(term, df, idf) with idf = ln((1 + N) / (1 + df)) + 1."""
    n = frequencies.where(F.col("term") == ROW_MARK).select("df")
    return frequencies.where(F.col("term") != ROW_MARK).select(
        "term", "df", idf(n.scalar(), F.col("df")).alias("idf"))


def term_vectors(tokens: DataFrame, idfs: DataFrame, key: list[str], unseen: float,
                 limit: int = MAX_VOCABULARY) -> DataFrame:
    """(key, terms, weights): unit TF-IDF vectors of every row.

    The most frequent terms, at most ``limit``, are broadcast and applied to Arrow batches. The
    rare ones stand in few places; only those places are joined with their idf and come back to
    their rows. ``unseen`` is the idf of a term the table does not know.
    """
    rare_below = _rare_below(idfs, limit)
    table = idfs.where(F.col("df") >= rare_below).select("term", "idf").toArrow().combine_chunks()
    shared = tokens.sparkSession.sparkContext.broadcast(
        (table.column("term").combine_chunks(), table.column("idf").to_numpy()))
    kept = ", ".join(f"{k} {t}" for k, t in tokens.select(*key).dtypes)
    if rare_below > 1:
        tokens = _with_rare(tokens, idfs.where(F.col("df") < rare_below), key, kept, shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, idfs = shared.value
        for batch in batches:
            yield weigh_batch(batch, key, *_known(batch, terms, idfs), unseen)

    return tokens.mapInArrow(run, f"{kept}, terms array<string>, weights array<double>")


def _rare_below(idfs: DataFrame, limit: int) -> int:
    """The least power of two such that at most ``limit`` terms have that df or more."""
    sizes = {r["bits"]: r["count"] for r in idfs.groupBy(
        F.length(F.bin("df")).alias("bits")).count().collect()}
    terms, bits = sum(sizes.values()), 1
    while terms > limit:
        terms, bits = terms - sizes.get(bits, 0), bits + 1
    return 2 ** (bits - 1)


def _with_rare(tokens: DataFrame, rare: DataFrame, key: list[str], kept: str,
               shared) -> DataFrame:
    """Adds ``_rare``, the (term, idf) pairs of a row's terms outside the shared table. Rows of
    one key share a list, which is right for each of them."""
    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, _ = shared.value
        for batch in batches:
            lists = batch.column("tokens")
            flat = lists.flatten().dictionary_encode()
            rare = pc.is_null(pc.index_in(flat.dictionary, terms)).take(flat.indices)
            row = pc.list_parent_indices(lists).filter(rare)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k).take(row) for k in key],
                 flat.dictionary.cast(pa.string()).take(flat.indices.filter(rare))],
                names=[*key, "term"])

    places = tokens.mapInArrow(others, f"{kept}, term string")
    found = places.join(rare.select("term", "idf"), "term").groupBy(
        *[F.col(k).alias(f"_{k}") for k in key]).agg(
        F.collect_set(F.struct("term", "idf")).alias("_rare"))
    same = all_of([F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    return tokens.join(found, same, "left").select(*key, "tokens", "_rare")


def _known(batch: pa.RecordBatch, terms: pa.Array, idfs: np.ndarray) -> tuple:
    """The shared terms and idfs, with those the batch brings along."""
    if "_rare" not in batch.schema.names:
        return terms, idfs
    own = batch.column("_rare").flatten()
    words = own.field("term").dictionary_encode()
    _, first = np.unique(words.indices.to_numpy(zero_copy_only=False), return_index=True)
    values = own.field("idf").to_numpy(zero_copy_only=False)
    return (pa.concat_arrays([terms.cast(pa.string()), words.dictionary.cast(pa.string())]),
            np.concatenate([idfs, values[first]]))


def weigh_batch(batch: pa.RecordBatch, key: list[str], terms: pa.Array, idfs: np.ndarray,
                unseen: float) -> pa.RecordBatch:
    """Term counts, idf weights and unit length for one batch of token lists."""
    tokens = batch.column("tokens")
    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    flat = tokens.flatten().dictionary_encode()
    width = max(1, len(flat.dictionary))
    cell = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths) * width \
        + flat.indices.to_numpy(zero_copy_only=False)
    cell, tf = np.unique(cell, return_counts=True)
    row, code = cell // width, cell % width
    found = pc.index_in(flat.dictionary, terms)
    known = pc.is_valid(found).to_numpy(zero_copy_only=False)
    word_idf = np.full(len(flat.dictionary), unseen)
    word_idf[known] = idfs[pc.fill_null(found, 0).to_numpy(zero_copy_only=False)[known]]
    weight = tf * word_idf[code] if len(code) else np.array([])
    square = np.bincount(row, weight * weight, minlength=len(lengths))
    weight = weight / np.sqrt(square)[row]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(lengths)))])
    offsets = pa.array(offsets, pa.int32())
    words = flat.dictionary.cast(pa.string()).take(pa.array(code))
    return pa.RecordBatch.from_arrays(
        [*[batch.column(k) for k in key],
         pa.ListArray.from_arrays(offsets, words),
         pa.ListArray.from_arrays(offsets, pa.array(weight, pa.float64()))],
        names=[*key, "terms", "weights"])


def joined_vectors(tokens: DataFrame, idfs: DataFrame, key: list[str],
                   unseen: float) -> DataFrame:
    """The same by joins, for a vocabulary of any size.

    Terms in more than a thousandth of all postings go through a broadcast of their few
    rows, so the shuffle join has no hot term.
    """
    postings = tokens.select(*key, F.explode("tokens").alias("term")).groupBy(
        *key, "term").agg(F.count("*").alias("tf"))
    total = idfs.agg(F.sum("df").alias("n"))
    hot = idfs.where(F.col("df") * HOT_KEYS > total.scalar()).select("term")
    weighted = skewed_lookup(postings, idfs.select("term", "idf"), "term", hot).withColumn(
        "w", F.col("tf") * F.coalesce("idf", F.lit(unseen)))
    grouped = weighted.groupBy(*key).agg(
        F.sum(F.col("w") * F.col("w")).alias("_sq"),
        F.collect_list(F.struct("term", "w")).alias("_v"))
    length = F.sqrt("_sq")
    found = grouped.select(
        *key, F.col("_v.term").alias("terms"),
        F.transform("_v.w", lambda w: w / length).alias("weights"))
    # A row without tokens has an empty vector here as in the broadcast form.
    bare = tokens.where(F.coalesce(F.size("tokens"), F.lit(0)) <= 0).select(
        *key, F.array().cast("array<string>").alias("terms"),
        F.array().cast("array<double>").alias("weights"))
    return found.unionByName(bare)


class LexicalIndex:
    """Term vectors of all chunks plus the idf table; both can be written and read back.

    ``members`` (doc_id, pos, member_doc, member_pos) lists the chunks behind every vector
    where equal texts share one.
    """

    def __init__(self, vectors: DataFrame, idfs: DataFrame, n_chunks: int,
                 members: DataFrame | None = None):
        self.vectors, self.idfs, self.n_chunks = vectors, idfs, n_chunks
        self.members = members

    @property
    def unseen(self) -> float:
        return math.log(1 + self.n_chunks) + 1

    @classmethod
    def build(cls, chunk_table: DataFrame) -> LexicalIndex:
        """Two passes over the chunks: one counts terms, one weighs them (when read)."""
        return cls._of(token_rows(chunk_table, ["doc_id", "pos"], "chunk_text"))

    @classmethod
    def build_merged(cls, chunk_table: DataFrame) -> LexicalIndex:
        """The same with one vector per distinct text, for tables of many equal texts.

        A vector bears the place of its first chunk, so vectors rank as their first chunks do;
        ``pos`` numbers the texts that begin with the same document.
        """
        texts = chunk_table.groupBy("chunk_text").agg(
            F.count("*").alias("_n"), F.min(F.struct("doc_id", "pos")).alias("_first"))
        number = F.row_number().over(W.partitionBy("_first.doc_id").orderBy(
            "_first.pos", "chunk_text"))
        texts = staged(texts.select(
            "chunk_text", "_n", F.col("_first.doc_id").alias("doc_id"), number.alias("pos")))
        tokens = token_rows(texts, ["doc_id", "pos", "_n"], "chunk_text")
        out = cls._of(tokens, "_n")
        placed = texts.select(F.col("chunk_text").alias("_text"), "doc_id", "pos")
        out.members = chunk_table.select(
            "chunk_text", F.col("doc_id").alias("member_doc"), F.col("pos").alias("member_pos")
        ).join(placed, F.col("chunk_text").eqNullSafe(F.col("_text"))).select(
            "doc_id", "pos", "member_doc", "member_pos")
        return out

    @classmethod
    def _of(cls, tokens: DataFrame, copies: str | None = None) -> LexicalIndex:
        frequencies = staged(document_frequency(tokens, copies))
        mark = frequencies.where(F.col("term") == ROW_MARK).first()
        out = cls(None, idf_table(frequencies), mark["df"] if mark else 0)
        out.vectors = term_vectors(tokens, out.idfs, ["doc_id", "pos"], out.unseen)
        return out

    def kept(self) -> LexicalIndex:
        """The index with its vectors written, for searches that come in rounds."""
        return LexicalIndex(staged(self.vectors), staged(self.idfs), self.n_chunks,
                            None if self.members is None else staged(self.members))

    def save(self, path: str) -> None:
        self.vectors.write.mode("overwrite").parquet(f"{path}/vectors")
        self.idfs.write.mode("overwrite").parquet(f"{path}/idf")
        merged = self.members is not None
        if merged:
            self.members.write.mode("overwrite").parquet(f"{path}/members")
        size = self.vectors.sparkSession.createDataFrame(
            [(self.n_chunks, merged)], "n bigint, merged boolean")
        size.write.mode("overwrite").parquet(f"{path}/size")

    @classmethod
    def load(cls, spark, path: str) -> LexicalIndex:
        size = spark.read.parquet(f"{path}/size").first()
        return cls(spark.read.parquet(f"{path}/vectors"), spark.read.parquet(f"{path}/idf"),
                   size["n"], spark.read.parquet(f"{path}/members") if size["merged"] else None)

    def query_vectors(self, queries: DataFrame, text: str = "text") -> DataFrame:
        """Queries(query_id, text) in the index's own weighting."""
        tokens = token_rows(queries, ["query_id"], text)
        return term_vectors(tokens, self.idfs, ["query_id"], self.unseen)

    def search(self, queries: DataFrame, k: int = C.CHUNK_POOL, text: str = "text") -> DataFrame:
        """Top-k chunks per query: (query_id, doc_id, pos, score, rank), score to 4 dp.

        Every distinct text is searched once, and its hits go to all queries that ask it. The
        k best chunks lie behind the k best vectors, at most k of them behind each.
        """
        asked = staged(queries.select(F.col(text).alias("_text")).distinct().select(
            F.monotonically_increasing_id().alias("query_id"), "_text"))
        hits = sparse_top_k(self.vectors, self.query_vectors(asked, "_text"), k)
        if self.members is not None:
            first = top_per_group(self.members, ["doc_id", "pos"], [
                F.col("member_doc"), F.col("member_pos")], k, "_r")
            hits = merged_hits(hits.join(first, ["doc_id", "pos"]).select(
                "query_id", F.col("member_doc").alias("doc_id"),
                F.col("member_pos").alias("pos"), "score"), k)
        hits = hits.select(F.col("query_id").alias("_asked"), "doc_id", "pos", "score")
        pairs = queries.select("query_id", F.col(text).alias("_t")).join(
            asked.withColumnRenamed("query_id", "_asked"),
            F.col("_t").eqNullSafe(F.col("_text"))).select("query_id", "_asked")
        out = merged_hits(pairs.join(hits, "_asked").drop("_asked"), k)
        return out.withColumn("score", F.round("score", 4))


def to_documents(hits: DataFrame) -> DataFrame:
    """Best chunk per (query, document); the earlier hit wins a tie. Adds ``doc_rank``."""
    best = hits.groupBy("query_id", "doc_id").agg(
        F.max_by(F.struct("score", "rank", "pos"), F.struct("score", -F.col("rank"))).alias("b"))
    order = W.partitionBy("query_id").orderBy(F.desc("b.score"), "b.rank")
    return best.select(
        "query_id", "doc_id", "b.score", F.col("b.pos").alias("best_pos"),
        F.row_number().over(order).alias("doc_rank"))


def search_documents(pool: DataFrame, n: int = C.EVAL_K) -> DataFrame:
    """Distinct-document top n out of a wider chunk pool."""
    return to_documents(pool).where(F.col("doc_rank") <= n)


def agent_documents(pool: DataFrame, k: int | Column = C.TOP_K) -> DataFrame:
    """Documents behind the top k chunks only; fewer than k can come back."""
    return to_documents(pool.where(F.col("rank") <= k))


def groundedness(queries: DataFrame, hits: DataFrame,
                 threshold: float = C.SIMILARITY_THRESHOLD) -> DataFrame:
    """Best score per query (0 without a hit) against the gate."""
    best = hits.groupBy("query_id").agg(
        F.max("score").alias("best_score"), F.count("*").alias("n_chunks_considered"))
    score = F.coalesce("best_score", F.lit(0.0))
    return queries.select("query_id").join(best, "query_id", "left").select(
        "query_id", (score >= threshold).cast("int").alias("grounded"),
        score.alias("best_score"), F.lit(threshold).alias("threshold"),
        F.coalesce("n_chunks_considered", F.lit(0)).alias("n_chunks_considered"))


def calibration(gated: DataFrame, in_domain: Column,
                threshold: float = C.SIMILARITY_THRESHOLD) -> DataFrame:
    """Score range of in-domain and out-of-domain queries, their gap, and the verdict."""
    s = F.col("best_score")
    inside, outside = F.when(in_domain, s), F.when(~in_domain, s)
    row = gated.agg(
        F.count(inside).alias("n_in"), F.count(outside).alias("n_out"),
        F.min(inside).alias("in_min"), F.max(inside).alias("in_max"),
        F.round(F.avg(inside), 6).alias("in_mean"),
        F.min(outside).alias("out_min"), F.max(outside).alias("out_max"),
        F.round(F.avg(outside), 6).alias("out_mean"))
    separates = (F.col("out_max") < threshold) & (F.lit(threshold) <= F.col("in_min"))
    return row.select(
        "*", F.round(F.col("in_min") - F.col("out_max"), 4).alias("gap"),
        F.round((F.col("in_min") + F.col("out_max")) / 2, 6).alias("midpoint"),
        separates.cast("int").alias("separates"))


def relevant_by_sentence(queries: DataFrame, chunk_table: DataFrame,
                         share: float = 0.5) -> DataFrame:
    """Answer key: documents that hold at least ``share`` of a passage's own sentences.

    An equi-join on the sentence; both sides are made distinct first, so copies within a
    document count once. The passages' sentences are broadcast within a checked size, so a
    sentence that a third of the documents share is never shuffled; beyond it the join
    handles hot sentences apart.
    """
    own = queries.select(
        "query_id", F.explode(F.array_distinct(T.sentences(F.col("text")))).alias("chunk_text"))
    asked = own.groupBy("chunk_text").agg(F.collect_set("query_id").alias("_queries"))
    rows = chunk_table.select("doc_id", "chunk_text")
    if asked.limit(MAX_SENTENCES + 1).count() <= MAX_SENTENCES:
        held = rows.join(F.broadcast(asked), "chunk_text")
    else:
        held = skewed_lookup(rows, asked, "chunk_text").where(F.col("_queries").isNotNull())
    shared = held.dropDuplicates(["doc_id", "chunk_text"]).select("doc_id", F.explode("_queries").alias("query_id")).groupBy(
        "query_id", "doc_id").agg(F.count("*").alias("n_shared"))
    sizes = queries.select("query_id", F.size(F.array_distinct(T.sentences(F.col("text"))))
                           .alias("n_sentences"))
    return shared.join(sizes, "query_id").where(
        F.col("n_shared") >= share * F.col("n_sentences")).select("query_id", "doc_id")


def retrieval_scores(queries: DataFrame, retrieved: DataFrame, relevant: DataFrame,
                     k: int = C.EVAL_K) -> DataFrame:
    """Hits, precision (always divided by k) and recall (0 without relevant documents)."""
    hits = retrieved.join(relevant, ["query_id", "doc_id"], "left_semi").groupBy(
        "query_id").agg(F.count("*").alias("n_hits"))
    sizes = relevant.groupBy("query_id").agg(F.count("*").alias("n_relevant"))
    n_hits, n_relevant = F.coalesce("n_hits", F.lit(0)), F.coalesce("n_relevant", F.lit(0))
    return queries.select("query_id").join(hits, "query_id", "left").join(
        sizes, "query_id", "left").select(
        "query_id", n_hits.alias("n_hits"), n_relevant.alias("n_relevant"),
        (n_hits / F.lit(k)).alias("precision_at_k"),
        guarded_ratio(n_hits, n_relevant).alias("recall_at_k"))


def macro_means(per_query: DataFrame) -> DataFrame:
    return per_query.agg(
        F.count("*").alias("n_queries"),
        F.round(F.avg("precision_at_k"), 6).alias("mean_precision"),
        F.round(F.avg("recall_at_k"), 6).alias("mean_recall"))
