"""Packing: length buckets with the least padding, token-budget batches inside each bucket.

The histogram counts every document. Bucket limits come from dynamic programming over it on
the driver, whose input is bounded: lengths up to EXACT are their own bin, longer ones share
a bin where their first SHARP bits agree, so 2**40 tokens still give fewer than MAX_BINS bins.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.llm.common import lookup, whole, words
from orderlens.session import staged

SHARP = 17
EXACT = 2 ** SHARP
MAX_BINS = 2_000_000
# Rows that one window partition ranks, on average.
CHUNK_ROWS = 20_000


def n_words(text: str = "text") -> Column:
    """Length measure of the query: words of the whole text, null counts none."""
    return F.size(words(whole(text))).cast("long")


def bin_of(length: Column) -> Column:
    """The length itself up to EXACT, beyond it rounded up to SHARP significant bits."""
    shift = F.greatest(F.length(F.bin(length)) - SHARP, F.lit(0))
    step = F.call_function("shiftleft", F.lit(1).cast("long"), shift)
    return F.when(length <= EXACT, length).otherwise(F.ceil(length / step).cast("long") * step)


def best_limits(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper limits of at most ``buckets`` buckets that pad least; the last is the maximum.

    cost[j] is the least padded size of the j shortest bins in so many buckets. A last bucket
    that starts after bin i costs cost[i] + (seen[j] - seen[i]) * length[j]: a line in
    length[j] with slope -seen[i]. Slopes fall and lengths rise, so the lower hull of the lines
    answers every j in one pass over whole numbers.
    """
    size = len(lengths)
    if not size:
        return []
    seen = [0, *accumulate(counts)]
    cost, cuts = [0, *[None] * size], []
    for _ in range(min(buckets, size)):
        now, start, hull, at = [None] * (size + 1), [0] * (size + 1), [], 0
        for j in range(1, size + 1):
            if cost[j - 1] is not None:
                line = -seen[j - 1], cost[j - 1], j - 1
                while len(hull) > 1 and _needless(hull[-2], hull[-1], line):
                    hull.pop()
                hull.append(line)
                at = min(at, len(hull) - 1)
            if not hull:
                continue
            x = lengths[j - 1]
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] \
                    <= hull[at][0] * x + hull[at][1]:
                at += 1
            now[j] = hull[at][0] * x + hull[at][1] + seen[j] * x
            start[j] = hull[at][2]
        if cost[size] is not None and now[size] >= cost[size]:
            break
        cuts.append(start)
        cost = now
    out, j = [], size
    for start in reversed(cuts):
        if j == 0:
            break
        out.append(int(lengths[j - 1]))
        j = start[j]
    return sorted(out)


def _needless(a: tuple, b: tuple, c: tuple) -> bool:
    """Is line b nowhere below both a and c? Slopes fall from a to c."""
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def bucket_limits(lengths: DataFrame, length: str, buckets: int) -> list[int]:
    """Limits from the whole histogram of non-negative lengths. A bin stands for its longest
    text, so a limit is the length of some text."""
    bins = lengths.groupBy(bin_of(F.col(length)).alias("bin")).agg(
        F.count("*").alias("n"), F.max(length).alias("longest")).orderBy("bin")
    found = bins.limit(MAX_BINS + 1).toArrow()
    if found.num_rows > MAX_BINS:
        raise ValueError("length histogram: lengths beyond 2**40")
    return best_limits(found.column("longest").to_pylist(), found.column("n").to_pylist(),
                       buckets)


def pack(docs: DataFrame, length: Column, buckets: int = 16, budget: int = 65_536,
         doc: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_tokens, bucket limit, batch within the bucket, slot
    within the batch, and its padding.

    A batch of a bucket holds as many documents as the budget has room for at the bucket's
    limit, one at least. Places follow the order of (hash of id and length, id, length), so
    batches do not depend on partitioning; repeated rows and null ids get places of their own;
    empty texts fall into the shortest bucket. Places are counted within chunks of that order
    and shifted by the sizes of the chunks before, so no task ranks a whole bucket. An id and
    length that more than CHUNK_ROWS rows share stand after the others, counted by the input's
    partitions; such rows are alike, so it is all one which of them gets which place.
    """
    rows = staged(docs.select(F.col(doc).alias("doc_id"), length.alias("n_tokens"))
                  .withColumn("_part", F.spark_partition_id()))
    limits = bucket_limits(rows, "n_tokens", buckets)
    chunks = max(1, rows.count() // CHUNK_ROWS)
    limit = F.lit(None).cast("long")
    for upper in reversed(limits):
        limit = F.when(F.col("n_tokens") <= upper, F.lit(upper).cast("long")).otherwise(limit)
    spread = F.xxhash64("doc_id", "n_tokens")
    keyed = rows.withColumn("bucket", limit).withColumn("_order", F.shiftrightunsigned(spread, 1))
    alike = staged(rows.groupBy(spread.alias("_key")).agg(F.count("*").alias("_n")).where(
        F.col("_n") > CHUNK_ROWS))
    marked = lookup(keyed.withColumn("_key", spread), alike, ["_key"], "_n")
    hot = F.col("_n").isNotNull()
    # The chunk is the hash's high bits scaled down, so chunks follow the order of the hash.
    top = F.shiftrightunsigned(spread, 33)
    keyed = marked.select(
        "doc_id", "n_tokens", "bucket", "_order", hot.alias("_hot"),
        F.when(hot, F.col("_order")).otherwise(F.shiftrightunsigned(top * chunks, 31))
        .alias("_chunk"), F.when(hot, F.col("_part")).otherwise(0).alias("_split"))
    by = ["bucket", "_hot", "_chunk", "_split"]
    inner = keyed.withColumn("_place", F.row_number().over(
        W.partitionBy(*by).orderBy("_order", "doc_id", "n_tokens")))
    sizes = keyed.groupBy(*by).agg(F.count("*").alias("_n"))
    before = W.partitionBy("bucket").orderBy(*by[1:]).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(*by, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_place") - 1
    room = F.greatest(F.lit(1).cast("long"), F.expr(f"{budget} div greatest(bucket, 1)"))
    return (
        inner.join(offsets, by)
        .withColumn("_place", place).withColumn("_room", room)
        .select("doc_id", "n_tokens", "bucket", F.expr("_place div _room").alias("batch"),
                (F.col("_place") % F.col("_room")).alias("slot"),
                (F.col("bucket") - F.col("n_tokens")).alias("padding")))
