"""Exact top-k by similarity: many queries against a large corpus, without emitting pairs.

The corpus streams past the queries in Arrow batches. A task multiplies each batch with the
query block and keeps only the best k rows per query, so a partition emits at most
queries x k rows; a window then merges the partitions. Nothing is shuffled but those rows,
and no frequent term or hot label can concentrate work on one task.

A query set within ``MAX_CELLS`` is broadcast. A larger one is cut into blocks of that size,
and each of them meets the corpus in the same way, so the result stays exact.

Queries of terms are broadcast as lists. A task turns its rows into lists as well, a slab at a
time, and a query adds up those of its own terms, so a pair without a common term costs nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.session import staged

MAX_CELLS = 16_000_000
BLOCK_QUERIES = 2_000
SLICE_CELLS = 4_000_000
SLAB_ROWS = 50_000
RANK_DIGITS = 9

HIT_SCHEMA = "query_id bigint, doc_id bigint, pos int, score double"


class BestK:
    """Running best k hits per query, ordered by (score desc, doc_id, pos).

    Scores are compared after rounding to 9 digits, so the order in which products were
    summed cannot change the ranking.
    """

    def __init__(self, queries: int, k: int):
        self.k = k
        self.floor = np.full(queries, 0.0)
        self.rows: list[tuple] = []
        self.held = 0

    def offer(self, scores: np.ndarray, docs: np.ndarray, pos: np.ndarray) -> None:
        """``scores`` is rows x queries; entries <= 0 are not hits."""
        scores = np.round(scores, RANK_DIGITS)
        n = scores.shape[0]
        bar = self.floor
        if n > self.k:
            bar = np.maximum(bar, np.partition(scores, n - self.k, axis=0)[n - self.k])
        row, query = np.nonzero((scores >= bar) & (scores > 0))
        if len(row):
            self.rows.append((query, docs[row], pos[row], scores[row, query]))
            self.held += len(row)
        if self.held > 200_000:
            self._trim()

    def _trim(self) -> None:
        query, docs, pos, score = (np.concatenate(c) for c in zip(*self.rows))
        order = np.lexsort((pos, docs, -score, query))
        query, docs, pos, score = query[order], docs[order], pos[order], score[order]
        starts = np.searchsorted(query, np.arange(len(self.floor)))
        rank = np.arange(len(query)) - starts[query]
        keep = rank < self.k
        last = rank == self.k - 1
        self.floor[query[last]] = score[last]
        self.rows = [(query[keep], docs[keep], pos[keep], score[keep])]
        self.held = int(keep.sum())

    def result(self) -> tuple:
        if not self.rows:
            return tuple(np.array([], dtype=t) for t in ("int64", "int64", "int32", "float64"))
        self._trim()
        return self.rows[0]


class DenseBlock:
    """Queries as a matrix of unit vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids = ids
        self.vectors = unit(vectors)

    def scores(self, batch: pa.Table | pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray]]:
        flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
        rows = unit(flat.astype(np.float64).reshape(batch.num_rows, -1))
        step = max(1, SLICE_CELLS // max(1, len(self.ids)))
        for i in range(0, len(rows), step):
            yield slice(i, i + step), rows[i:i + step] @ self.vectors.T


class SparseBlock:
    """Queries as weighted terms, kept as a (term x query) matrix over their own terms."""

    def __init__(self, ids: np.ndarray, query: np.ndarray, terms: list[str],
                 weights: np.ndarray):
        self.ids = ids
        vocabulary = sorted(set(terms))
        position = {t: i for i, t in enumerate(vocabulary)}
        self.vocabulary = pa.array(vocabulary, pa.string())
        self.matrix = np.zeros((len(vocabulary), len(ids)))
        self.matrix[[position[t] for t in terms], query] = weights

    def scores(self, batch: pa.Table | pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray]]:
        terms, weights = batch.column("terms"), batch.column("weights")
        lengths = pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False)
        column = pc.index_in(terms.flatten(), self.vocabulary)
        known = pc.is_valid(column).to_numpy(zero_copy_only=False)
        column = pc.fill_null(column, 0).to_numpy(zero_copy_only=False)[known]
        weight = weights.flatten().to_numpy(zero_copy_only=False)[known]
        row = np.repeat(np.arange(len(lengths)), lengths)[known]
        step = max(1, SLICE_CELLS // max(1, len(self.ids)))
        start = 0
        while start < len(row):
            # Cut between rows, at or after the step; one long row stays whole.
            end = min(len(row), start + step)
            if end < len(row):
                cut = np.searchsorted(row, row[end - 1])
                end = cut if cut > start else int(np.searchsorted(row, row[start], "right"))
            part = self.matrix[column[start:end]] * weight[start:end, None]
            ids, first = np.unique(row[start:end], return_index=True)
            yield ids, np.add.reduceat(part, first, axis=0)
            start = end


class PostingBlock:
    """Queries as lists of weighted terms; ``starts`` cuts the lists."""

    def __init__(self, table: pa.Table):
        terms = table.column("terms").combine_chunks()
        flat = terms.flatten().dictionary_encode()
        lengths = pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False)
        self.ids = table.column("query_id").to_numpy()
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.vocabulary = flat.dictionary.cast(pa.string())
        self.codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.weights = table.column("weights").combine_chunks().flatten().to_numpy(
            zero_copy_only=False)

    def postings(self, slab: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The slab's rows and weights by term, and where each term's list begins."""
        terms = slab.column("terms").combine_chunks()
        lengths = pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False)
        code = pc.fill_null(pc.index_in(terms.flatten(), self.vocabulary), -1).to_numpy(
            zero_copy_only=False)
        weight = slab.column("weights").combine_chunks().flatten().to_numpy(
            zero_copy_only=False)
        row = np.repeat(np.arange(len(lengths)), lengths)
        order = np.argsort(code, kind="stable")[np.count_nonzero(code < 0):]
        begins = np.concatenate([[0], np.cumsum(np.bincount(
            code[order], minlength=len(self.vocabulary)))])
        return row[order], weight[order], begins

    def best(self, slabs: Iterator[pa.Table], k: int) -> Iterator[tuple]:
        """(query, doc_id, pos, score) arrays of the best k rows, a query at a time."""
        found = [None] * len(self.ids)
        for slab in slabs:
            docs = slab.column("doc_id").to_numpy()
            pos = slab.column("pos").to_numpy()
            row, weight, begins = self.postings(slab)
            for query in range(len(self.ids)):
                mine = slice(self.starts[query], self.starts[query + 1])
                code = self.codes[mine]
                held = begins[code + 1] > begins[code]
                if held.any():
                    lists = [slice(a, b) for a, b in zip(
                        begins[code[held]].tolist(), begins[code[held] + 1].tolist())]
                    scores = np.bincount(
                        np.concatenate([row[x] for x in lists]),
                        np.concatenate([weight[x] * w for x, w in zip(
                            lists, self.weights[mine][held].tolist())]))
                    found[query] = _merged(found[query], scores, docs, pos, k)
        for query, hits in enumerate(found):
            if hits is not None:
                yield np.full(len(hits[0]), query), *hits


def _merged(known: tuple | None, scores: np.ndarray, docs: np.ndarray, pos: np.ndarray,
            k: int) -> tuple | None:
    """The best k of those known and of further rows, in the order of ``BestK``."""
    full = known is not None and len(known[2]) == k
    # Scores are compared as rounded; the slack keeps all that may round up to the last one.
    near = np.flatnonzero(scores >= known[2][-1] - 10.0 ** -RANK_DIGITS if full else scores > 0)
    score = np.round(scores[near], RANK_DIGITS)
    if len(near) > k:
        kept = score >= np.partition(score, len(score) - k)[len(score) - k]
        near, score = near[kept], score[kept]
    if not score.any():
        return known
    hits = docs[near], pos[near], score
    if known is not None:
        hits = tuple(np.concatenate(both) for both in zip(known, hits))
    order = np.lexsort((hits[1], hits[0], -hits[2]))[:k]
    docs, pos, score = (x[order] for x in hits)
    return docs[score > 0], pos[score > 0], score[score > 0]


def _slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together, so that a list of postings is worth a call."""
    held, rows = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= SLAB_ROWS:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def _frame(block, best: BestK) -> pa.RecordBatch:
    query, docs, pos, score = best.result()
    return pa.RecordBatch.from_arrays([
        pa.array(block.ids[query] if len(query) else query, pa.int64()),
        pa.array(docs, pa.int64()), pa.array(pos, pa.int32()),
        pa.array(score, pa.float64())], names=["query_id", "doc_id", "pos", "score"])


def _feed(block, best: BestK, batch) -> None:
    docs = batch.column("doc_id").to_numpy(zero_copy_only=False)
    pos = batch.column("pos").to_numpy(zero_copy_only=False)
    for rows, scores in block.scores(batch):
        best.offer(scores, docs[rows], pos[rows])


def merged_hits(hits: DataFrame, k: int) -> DataFrame:
    """The best k of every query's hits, with their rank."""
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "doc_id", "pos")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _hits(block: PostingBlock, batches: Iterator[pa.RecordBatch],
          k: int) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for hits in block.best(_slabs(batches), k):
        held.append(hits)
        rows += len(hits[0])
        if rows >= SLAB_ROWS:
            yield _hit_batch(block, held)
            held, rows = [], 0
    if held:
        yield _hit_batch(block, held)


def _hit_batch(block: PostingBlock, held: list[tuple]) -> pa.RecordBatch:
    query, docs, pos, score = (np.concatenate(c) for c in zip(*held))
    return pa.RecordBatch.from_arrays([
        pa.array(block.ids[query], pa.int64()), pa.array(docs, pa.int64()),
        pa.array(pos, pa.int32()), pa.array(score, pa.float64())],
        names=["query_id", "doc_id", "pos", "score"])


def _stream(corpus: DataFrame, block, k: int) -> DataFrame:
    shared = corpus.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        if isinstance(block, PostingBlock):
            yield from _hits(block, batches, k)
            return
        best = BestK(len(block.ids), k)
        for batch in batches:
            if batch.num_rows:
                _feed(block, best, batch)
        yield _frame(block, best)

    return merged_hits(corpus.mapInArrow(run, HIT_SCHEMA), k)


def _blocked(corpus: DataFrame, queries: DataFrame, q_blocks: int, k: int, build) -> DataFrame:
    """One block of queries after another past the corpus, which is written once and then only
    read: no row of it is copied or shuffled. Blocks are hash slices, so they are even."""
    number = F.pmod(F.xxhash64("query_id"), F.lit(q_blocks))
    corpus, queries = staged(corpus), staged(queries.withColumn("_q", number))
    hits = []
    for block in range(q_blocks):
        part = queries.where(F.col("_q") == block).drop("_q").toArrow()
        if part.num_rows:
            hits.append(staged(_stream(corpus, build(part), k)))
    return reduce(DataFrame.unionByName, hits)


def _dense_block(table: pa.Table) -> DenseBlock:
    ids = table.column("query_id").to_numpy()
    flat = np.concatenate([np.asarray(v, dtype=np.float64)
                           for v in table.column("vector").to_pylist()])
    return DenseBlock(ids, flat.reshape(len(ids), -1))


def _top_k(corpus, queries, k, build, width, limit) -> DataFrame:
    """``width`` is the number of stored cells per query, used for the broadcast check."""
    stats = queries.agg(F.count("*").alias("n"), F.coalesce(F.max(width), F.lit(0)).alias("w"),
                        F.coalesce(F.sum(width), F.lit(0)).alias("total")).first()
    # Lists hold the terms there are; the dense matrix has exactly w x n cells.
    cells = stats["total"] if build is PostingBlock else stats["n"] * stats["w"]
    if cells > limit:
        q_blocks = min(stats["n"], math.ceil(cells / max(1, limit)))
        if build is not PostingBlock:
            q_blocks = max(-(-stats["n"] // BLOCK_QUERIES), q_blocks)
        return _blocked(corpus, queries, q_blocks, k, build)
    return _stream(corpus, build(queries.toArrow()), k)


def dense_top_k(corpus: DataFrame, queries: DataFrame, k: int,
                limit: int = MAX_CELLS) -> DataFrame:
    """``corpus``(doc_id, pos, vector) against ``queries``(query_id, vector) by cosine.

    Returns (query_id, doc_id, pos, score, rank).
    """
    return _top_k(corpus.select("doc_id", "pos", F.col("vector").cast("array<double>")
                                .alias("vector")),
                  queries.select("query_id", F.col("vector").cast("array<double>")
                                 .alias("vector")),
                  k, _dense_block, F.size("vector"), limit)


def sparse_top_k(corpus: DataFrame, queries: DataFrame, k: int,
                 limit: int = MAX_CELLS // 4) -> DataFrame:
    """The same for term vectors: columns terms and weights, both of unit length."""
    return _top_k(corpus.select("doc_id", "pos", "terms", "weights"),
                  queries.select("query_id", "terms", "weights"),
                  k, PostingBlock, F.greatest(F.size("terms"), F.lit(0)), limit)


def nearest_rows(df: DataFrame, keep: list[str], vector: str, ids: list, vectors: list,
                 k: int) -> DataFrame:
    """The k nearest of a small, checked exemplar set for every row; a map, no shuffle.

    Adds ``nearest``: array of (exemplar, similarity), best first, ties to the lower id.
    """
    ids_array = np.array(ids, dtype=np.int64)
    matrix = unit(np.array(vectors, dtype=np.float64))
    shared = df.sparkSession.sparkContext.broadcast((ids_array, matrix))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keep).schema)
    schema = f"{fields}, nearest array<struct<exemplar:bigint,similarity:double>>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_array, matrix = shared.value
        for batch in batches:
            out = batch[keep].copy()
            out["nearest"] = []if batch.empty else _nearest(
                np.stack(batch[vector].to_numpy()), ids_array, matrix, k)
            yield out

    return df.select(*dict.fromkeys([*keep, vector])).mapInPandas(run, schema)


def _nearest(rows: np.ndarray, ids: np.ndarray, matrix: np.ndarray, k: int) -> list:
    scores = np.round(unit(rows) @ matrix.T, RANK_DIGITS)
    order = np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=1)[:, :k]
    return [
        [{"exemplar": int(ids[j]), "similarity": float(scores[i, j])} for j in picked]
        for i, picked in enumerate(order)]
