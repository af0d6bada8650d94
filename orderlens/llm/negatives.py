"""Hard negatives: exact integer scores of stated anchors against all rows.

Scores come from a residue number system. Every component matrix is reduced modulo several
small primes, multiplied in float32 (whose sums stay below 2**24 and are therefore exact), and
the residues are put together by the Chinese remainder theorem. Anchors go in blocks of a fixed
number of components; every block meets all rows as they are read, so no row is copied or
shuffled, and a task keeps only its best few for each anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.session import staged

COLUMNS_AT_ONCE = 256      # components summed in float32
LARGEST_PRIME = 509        # 256 * 254 ** 2 < 2 ** 24
MOST_SCORE = 2 ** 61       # scores, and what they are rebuilt from, are 64-bit integers
BLOCK_CELLS = 2 ** 21      # components of a block of anchors, which is broadcast
ANCHORS_AT_ONCE, ROWS_AT_ONCE = 256, 2048
NO_ID = 2 ** 63 - 1        # orders rows without an id after all others


def primes_for(bound: int) -> list[int]:
    """Primes, at least two, whose product exceeds twice the largest absolute score."""
    if bound > MOST_SCORE:
        raise ArithmeticError("scores can pass 64-bit integers")
    found, product, p = [], 1, LARGEST_PRIME
    while product <= 2 * bound or len(found) < 2:
        if all(p % d for d in range(2, int(p ** 0.5) + 1)):
            found.append(p)
            product *= p
        p -= 1
    return found


def _mod(x: np.ndarray, p: int) -> np.ndarray:
    """x modulo p, not negative; a floor division by one number is much faster than ``%``."""
    return x - x // p * p


def residues(matrix: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """The matrix modulo every prime, as float32 between -p/2 and p/2."""
    out = []
    for p in primes:
        r = _mod(matrix, p)
        out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return out


def scores(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Inner products (rows of left x rows of right) as exact 64-bit integers."""
    value, product = 0, 1
    for p, a, b in zip(primes, left, right):
        sums = 0
        for at in range(0, a.shape[1], COLUMNS_AT_ONCE):
            part = slice(at, at + COLUMNS_AT_ONCE)
            sums = sums + (a[:, part] @ b[:, part].T).astype(np.int64)
        digit = _mod(_mod(sums - value, p) * pow(product, -1, p), p) if product > 1 \
            else _mod(sums, p)
        value = value + digit * product
        product *= p
    return np.where(value > product // 2, value - product, value)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows; a short one is filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


class _Best:
    """The ``most`` best (score, id) of every slot; higher scores, then smaller ids first."""

    def __init__(self, least: np.ndarray, most: int):
        self.cut, self.most = least.copy(), most  # what a score must reach to be of use
        self.held = {}  # first slot of a block: its (slot, score, id)

    def add(self, first: int, block: np.ndarray, open_: np.ndarray, ids: np.ndarray) -> None:
        """Scores of slots first, first + 1, ... (rows) where ``open_`` holds; a slot always
        comes in the same block."""
        cut = self.cut[first:first + len(block)]
        use = open_ & (block >= cut[:, None])
        if use.sum() > 4 * self.most * len(block) and block.shape[1] > self.most:
            low = np.where(use, block, np.iinfo(np.int64).min)
            cut = np.maximum(cut, np.partition(low, -self.most, axis=1)[:, -self.most])
            use &= block >= cut[:, None]
        row, column = np.nonzero(use)
        if not len(row):
            return
        new = row + first, block[row, column], ids[column]
        slot, score, id_ = (np.concatenate([a, b]) for a, b in zip(self.held[first], new)) \
            if first in self.held else new
        order = np.lexsort((id_, -score, slot))
        slot, score, id_ = slot[order], score[order], id_[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        full = rank == self.most - 1
        self.cut[slot[full]] = score[full]
        keep = rank < self.most
        self.held[first] = slot[keep], score[keep], id_[keep]

    def rows(self) -> tuple[np.ndarray, ...]:
        """(slot, score, id) of all that is held."""
        parts = [(np.zeros(0, np.int64),) * 3, *self.held.values()]
        return tuple(np.concatenate(column) for column in zip(*parts))


def _pieces(batches: Iterator[pa.RecordBatch], width: int, primes: list[int]) -> Iterator[tuple]:
    """(row, id, label, residues) of a bounded number of rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            row, id_, label = (part.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            yield row, id_, label, residues(matrix(part.column(3), width), primes)


def _ids(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=values == NO_ID)


def _positives(rows: DataFrame, block, width: int, primes: list[int], most: int) -> DataFrame:
    """(anchor, place, id, score): the best rows of the anchor's own label, without itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, _, labels, cells = block.value
        order = np.argsort(labels, kind="stable")
        anchors = [a[order] for a in residues(cells, primes)]
        own, labels = own[order], labels[order]
        best = _Best(np.full(len(own), np.iinfo(np.int64).min), most)
        for row, id_, label, parts in _pieces(batches, width, primes):
            for value in np.unique(label):
                at, end = np.searchsorted(labels, [value, value + 1])
                here = np.flatnonzero(label == value)
                for first in range(at, end, ANCHORS_AT_ONCE):
                    some = slice(first, min(end, first + ANCHORS_AT_ONCE))
                    got = scores([a[some] for a in anchors], [b[here] for b in parts], primes)
                    best.add(first, got, row[here][None, :] != own[some, None], id_[here])
        slot, score, id_ = best.rows()
        yield pa.RecordBatch.from_arrays(
            [pa.array(own[slot]), pa.array(id_), pa.array(score)],
            ["anchor", "id", "score"])

    found = rows.mapInArrow(run, "anchor long, id long, score long")
    ranked = W.partitionBy("anchor").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= most)


def _negatives(rows: DataFrame, block, width: int, primes: list[int], most: int,
               low: int, high: int) -> DataFrame:
    """The best rows of other labels inside the window of every (anchor, positive)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, cells, slots = block.value  # slots: (anchor's place, place, id, score)
        anchor, place, positive, score = slots
        floor, top = -(-low * score // 100), high * score // 100
        anchors = residues(cells, primes)
        best = _Best(floor, most)
        for _, id_, label, parts in _pieces(batches, width, primes):
            for first in range(0, len(ids), ANCHORS_AT_ONCE):
                some = slice(first, first + ANCHORS_AT_ONCE)
                got = scores([a[some] for a in anchors], parts, primes)
                other = label[None, :] != labels[some, None]
                # Slots are in the order of anchors, so those of a group stand together.
                at, end = np.searchsorted(anchor, [first, first + ANCHORS_AT_ONCE])
                for start in range(at, end, ANCHORS_AT_ONCE):
                    part = slice(start, min(end, start + ANCHORS_AT_ONCE))
                    which = anchor[part] - first
                    mine = got[which]
                    best.add(start, mine, other[which] & (mine <= top[part, None]), id_)
        slot, reached, id_ = best.rows()
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot), _ids(ids[anchor[slot]]), _ids(positive[slot]),
             pa.array(id_), pa.array(score[slot]), pa.array(reached)],
            ["slot", "anchor_id", "positive_id", "id", "positive_score", "negative_score"])

    found = rows.mapInArrow(run, "slot long, anchor_id long, positive_id long, id long, "
                                 "positive_score long, negative_score long")
    ranked = W.partitionBy("slot").orderBy(F.desc("negative_score"), "id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(
        F.col("rank") <= most).select(
        "anchor_id", "positive_id", "rank",
        F.when(F.col("id") != NO_ID, F.col("id")).alias("negative_id"),
        "positive_score", "negative_score")


def _blocks(anchors: DataFrame, count: int, width: int) -> tuple[Column, int]:
    """(block number, blocks): no block has more than BLOCK_CELLS components, or one anchor.

    The row number is distinct, so a finer deal always ends.
    """
    most = max(1, BLOCK_CELLS // max(1, width))
    blocks = max(1, -(-count // most))
    while True:
        number = F.pmod(F.xxhash64("row"), F.lit(blocks))
        if blocks == 1 or anchors.groupBy(number).count().agg(F.max("count")).first()[0] <= most:
            return number, blocks
        blocks *= 2


def mine(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10,
         low: int = 30, high: int = 90, id_: str = "vec_id", vector: str = "vector",
         label: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vector`` holds lists of integers; ``anchor`` is a condition on the input's columns. An
    anchor's positives are its first other rows of the same label by (score descending, id
    ascending); for each of them, the first rows of other labels with low % to high % of the
    positive's score follow in the same order. A positive score below zero has no such rows.

    Rows with a null label, vector or component take no part. A row without an id takes part
    after all rows of its score that have one, and is no anchor. Rows that repeat an id are rows
    of their own. A short vector counts as filled up with zeros, an empty one scores 0. No
    rows, or no anchors, give no rows. Integers so large that a score could pass 2**61 are an
    error before any score is made.
    """
    known = F.col(vector).isNotNull() & F.col(label).isNotNull() & \
        ~F.exists(vector, lambda x: x.isNull())
    rows = staged(vectors.where(known).select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(id_).cast("long"), F.lit(NO_ID)).alias("id"),
        F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<long>").alias("cells"),
        F.coalesce(anchor & F.col(id_).isNotNull(), F.lit(False)).alias("is_anchor")))
    reach = F.coalesce(F.array_max(F.transform("cells", F.abs)), F.lit(0))
    count, width, widest, tallest = rows.agg(
        F.count_if("is_anchor"), F.coalesce(F.max(F.size("cells")), F.lit(0)),
        F.coalesce(F.max(reach), F.lit(0)),
        F.coalesce(F.max(F.when(F.col("is_anchor"), reach)), F.lit(0))).first()
    primes = primes_for(max(1, width * widest * tallest))
    plain = rows.select("row", "id", "label", "cells")
    anchors = rows.where("is_anchor")
    number, blocks = _blocks(anchors, count, width)
    spark, out = vectors.sparkSession, None
    for block in range(blocks):
        own = anchors.where(number == block).select("row", "id", "label", "cells").toArrow()
        row, ids, labels = (own.column(i).to_numpy() for i in range(3))
        order = np.argsort(row)
        cells = matrix(own.column(3), width)[order] if len(row) else np.zeros((0, width), int)
        row, ids, labels = row[order], ids[order], labels[order]
        sent = spark.sparkContext.broadcast((row, ids, labels, cells))
        near = _positives(plain, sent, width, primes, positives).where("score >= 0").toArrow()
        sent.unpersist()
        named = [near.column(c).to_numpy() for c in ("anchor", "place", "id", "score")]
        named[0] = np.searchsorted(row, named[0])
        by = np.lexsort((named[1], named[0]))
        sent = spark.sparkContext.broadcast((ids, labels, cells, [c[by] for c in named]))
        part = staged(_negatives(plain, sent, width, primes, negatives, low, high))
        sent.unpersist()
        out = part if out is None else out.unionByName(part)
    return out


def quantised(vector: str, scale: int) -> Column:
    """floor(scale * x) of every component, x as a double; null if one is null or not finite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(wide, lambda x: F.floor(x * scale)))
