"""Near-duplicates: SimHash fingerprints, links by shared blocks, connected components.

The 64 bits are cut into blocks so that close fingerprints share some; rows meet on blocks and
the Hamming distance is then verified. Equal fingerprints are one row from the start, so copies
never make pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import lookup
from orderlens.session import staged

SEED = 42
# Up to so many different fingerprints in a block meet in pairs; a larger block goes by
# neighbourhoods, whose groups are small by construction. Both find every link.
SMALL_BLOCK = 64
STEP = 50_000  # shingles whose bits are counted at once
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """XXH64 of the word shingles, repeats included; with fewer words, of all of them.

    ``bytes.lower`` and ``bytes.split`` are the word rule: they know ASCII letters and the
    six ASCII blanks only.
    """
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    count = max(1, len(words) - width + 1)
    joined = map(b" ".join, zip(*(words[i:] for i in range(width)))) if len(words) >= width \
        else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, SEED) for s in joined), np.uint64, count)


def majority(hashes: np.ndarray) -> int:
    """Bits set in more than half of the hashes, as a signed 64-bit integer.

    Byte values are counted per byte place; a table of the 256 values' bits turns the counts
    into bit counts, which spares unpacking every hash.
    """
    counts = np.zeros((8, 8), np.int64)
    place = (np.arange(8) * 256).astype(np.intp)
    for at in range(0, len(hashes), STEP):
        seen = hashes[at:at + STEP].astype(">u8").view(np.uint8).reshape(-1, 8)
        values = np.bincount((seen + place).ravel(), minlength=2048).reshape(8, 256)
        counts += values @ BYTE_BITS
    return int(np.packbits(counts * 2 > len(hashes), axis=1).reshape(8).view(">i8")[0])


def fingerprints(docs: DataFrame, width: int, text: str = "text") -> DataFrame:
    """The rows without their text, with the long ``fp``.

    A text without words, an empty or a null one has fingerprint zero.
    """
    rest = [f for f in docs.schema.fields if f.name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [majority(shingle_hashes(t.as_py() or "", width)) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(prints, pa.int64())],
                [*[f.name for f in rest], "fp"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rest)
    return docs.select(text, *[f"`{f.name}`" for f in rest]).mapInArrow(run, f"{kinds}fp long")


def _block_keys(fp: Column) -> list[tuple[int, Column, int]]:
    """(number, key, mask) of every pair of the four 16-bit blocks.

    Two or fewer differing bits touch at most two blocks, so the other two are equal: close
    fingerprints share at least one of the six keys of 32 bits.
    """
    out = []
    for number, (a, b) in enumerate(combinations(range(4), 2)):
        mask = (0xFFFF << 16 * a) | (0xFFFF << 16 * b)
        signed = mask - 2 ** 64 if mask >= 2 ** 63 else mask
        out.append((number, fp.bitwiseAND(F.lit(signed)), mask))
    return out


def close_links(prints: DataFrame) -> DataFrame:
    """Links (a, b), a < b, whose components are those of all pairs of distinct ``fp`` with
    two or fewer differing bits.

    In a block of at most SMALL_BLOCK fingerprints, all pairs are verified. In a larger one,
    every fingerprint names its neighbourhood: itself and each change of one bit outside the
    block. Two fingerprints at distance two or less have a neighbour in common, and all that
    share one are that close to each other, so the smallest of them stands for the group. At
    most 65 fingerprints share a neighbour.
    """
    fp = F.col("fp")
    keys = [F.struct(F.lit(n).alias("k"), key.alias("v")) for n, key, _ in _block_keys(fp)]
    blocks = prints.select("fp", F.explode(F.array(*keys)).alias("_b")).select("fp", "_b.*")
    sizes = staged(blocks.groupBy("k", "v").agg(F.count("*").alias("n")).where("n > 1"))
    members = staged(lookup(blocks, sizes, ["k", "v"], "n").where(F.col("n").isNotNull()))

    small = members.where(F.col("n") <= SMALL_BLOCK)
    pairs = small.select("k", "v", F.col("fp").alias("a")).join(
        small.select("k", "v", F.col("fp").alias("b")), ["k", "v"])
    pairs = pairs.where("a < b").where(
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2).select("a", "b")

    large = members.where(F.col("n") > SMALL_BLOCK)
    changes = F.lit(None).cast("array<long>")
    for number, _, mask in _block_keys(fp):
        bits = [F.lit(1 << i if i < 63 else -2 ** 63) for i in range(64) if not mask >> i & 1]
        changes = F.when(F.col("k") == number, F.array(F.lit(0).cast("long"), *bits)) \
            .otherwise(changes)
    near = large.select("fp", F.explode(changes).alias("_x")).select(
        fp.bitwiseXOR(F.col("_x")).alias("near"), "fp").distinct()
    groups = near.groupBy("near").agg(F.collect_list("fp").alias("all")).where("size(all) > 1")
    stars = groups.select(F.array_min("all").alias("a"), F.explode("all").alias("b"))
    return pairs.union(stars.where("a <> b")).distinct()


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, root): the smallest node of each component of links (a, b), roots left out.

    Alternates two steps until nothing changes: every node hands its larger neighbours to
    its smallest neighbour, then its smaller ones. Each step writes its links, so lineage
    stays short, and splits nodes with very many neighbours.
    """
    links = staged(links.select("a", "b"))
    if links.isEmpty():
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))

    def step(links: DataFrame, larger: bool) -> DataFrame:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if larger:
            both = both.union(links.select("b", "a"))
        else:
            # A link's larger end owns it.
            both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = staged(both.groupBy("u").agg(
            F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n")))
        met = lookup(both, least, ["u"], "n")
        if larger:
            out = met.where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        else:
            out = met.where("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b")).union(
                met.select(F.col("m").alias("a"), F.col("u").alias("b")))
        return staged(out.where("a <> b").distinct())

    def mark(links: DataFrame) -> tuple:
        return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    seen = None
    for _ in range(most_rounds):
        links = step(step(links, True), False)
        now = mark(links)
        if now == seen:
            return links.select(F.col("b").alias("node"), F.col("a").alias("root"))
        seen = now
    raise RuntimeError("components: not settled")


def _best_of_classes(rows: DataFrame, best: Column) -> DataFrame:
    """(fp, n, best): every fingerprint of the rows, their number, and the least ``best`` of
    all rows reachable over links of two or fewer differing bits."""
    prints = staged(rows.groupBy("fp").agg(F.min(best).alias("first"), F.count("*").alias("n")))
    roots = components(close_links(prints.select("fp")))
    rooted = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    named = staged(rooted)
    least = named.groupBy("root").agg(F.min("first").alias("best"))
    return staged(named.join(least, "root").select("fp", "n", "best"))


def classes(docs: DataFrame, width: int = 3, doc: str = "doc_id",
            text: str = "text") -> DataFrame:
    """One row per document: doc_id, fp, and component_id, the smallest doc_id reachable over
    links of two or fewer differing bits.

    Repeated rows stay; a null doc_id takes part, but names a component only if all its ids
    are null; no rows give no rows.
    """
    rows = staged(fingerprints(docs.select(F.col(doc).cast("long").alias("doc_id"),
                                           F.col(text).alias("text")), width))
    found = _best_of_classes(rows, F.col("doc_id")).withColumnRenamed("best", "component_id")
    return lookup(rows, found, ["fp"], "n").select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, width: int = 3) -> DataFrame:
    """``_row`` of one document of each class, out of (_row, doc_id, text) with distinct ``_row``.

    The smallest doc_id stays, a null one only where there is no other; ties go by row number.
    """
    rows = staged(fingerprints(docs.select("_row", "doc_id", "text"), width))
    best = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    return _best_of_classes(rows, best).select(F.col("best._row").alias("_row")).distinct()


def hex_of(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
