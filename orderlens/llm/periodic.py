"""Periodic runs of words, by Kruskal over the suffixes in descending order of their LCP.

Suffixes of a text are sorted, and neighbours in that order are united by decreasing length of
their longest common prefix. Every class is a sorted list of positions; a smaller class moves
into a larger one. Two positions that come to stand side by side in a class, at a distance not
above the common prefix, are one period apart: they seed a run, and each run is seeded at its
start. A text without a repeated word sequence of the least useful length needs none of this,
which is found for many texts at once.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import whole, words

WORDS_AT_ONCE = 200_000  # words of short texts that are looked through together
TABLE_BITS = 20          # places of the table that counts word sequences
MIX = np.uint64(0x9E3779B97F4A7C15)


def useful_prefix(least: int, times: int) -> int:
    """The shortest common prefix that can seed a run of ``least`` words and ``times`` periods."""
    return min(max(least - q, (times - 1) * q) for q in range(1, least + 1))


def may_repeat(hashes: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Texts that may hold a sequence of ``size`` words twice; no other one does.

    ``hashes`` are those of the words of all texts one after another, text t ending at ends[t].
    """
    count = len(hashes) - size + 1
    if count < 1:
        return np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    with np.errstate(over="ignore"):
        key = text[:count].astype(np.uint64)
        for i in range(size):
            key = (key ^ hashes[i:i + count]) * MIX
            key ^= key >> np.uint64(29)
    place = (key >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    inside = text[:count] == text[size - 1:]
    twice = np.bincount(place[inside], minlength=1 << TABLE_BITS)[place] > 1
    some = np.flatnonzero(twice & inside)
    value, first, seen = np.unique(key[some], return_index=True, return_counts=True)
    return np.unique(text[some[first[seen > 1]]])


def sorted_suffixes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in suffix order, and the common prefix of each with the one before it.

    Ranks of prefixes double in length until all differ; they are kept, and the common prefixes
    are then read off them from the longest length down.
    """
    n = len(ids)
    rank = np.append(ids, -1).astype(np.int32)
    levels, step = [rank], 1
    while True:
        after = np.zeros(n, np.int64)
        after[:n - step] = rank[step:n] + 1
        key = rank[:n].astype(np.int64) * (int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.diff(key[order], prepend=key[order[0]]) != 0)
        rank = np.full(n + 1, -1, np.int32)
        rank[order] = new
        if new[-1] == n - 1 or step * 2 >= n:
            break
        levels.append(rank)
        step *= 2
    a, b = order[:-1], order[1:]
    common = np.zeros(n - 1, np.int64)
    for level in range(len(levels) - 1, -1, -1):
        same = levels[level][a + common] == levels[level][b + common]
        common[same] += 1 << level
    return order, np.append(0, common)


def runs_of(ids: np.ndarray, least: int = 6, times: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one text, in that order of start and period.

    A run has its smallest period, at least ``least`` words and ``times`` (two or more) periods,
    and no word beside it continues the period.
    """
    if len(ids) < least:
        return []
    order, common = sorted_suffixes(ids)
    useful = np.flatnonzero(common >= useful_prefix(least, times))
    if not len(useful):
        return []
    useful = useful[np.argsort(-common[useful], kind="stable")]
    word, home, found = ids.tolist(), {}, []

    def meet(i: int, j: int, lcp: int) -> None:
        q = j - i
        if q * (times - 1) <= lcp and lcp + q >= least and (
                i == 0 or word[i - 1] != word[j - 1]):
            found.append((i, lcp + q, q))

    for lcp, a, b in zip(common[useful].tolist(), order[useful - 1].tolist(),
                         order[useful].tolist()):
        large, small = home.get(a) or [a], home.get(b) or [b]
        if len(large) < len(small):
            large, small = small, large
        places = [bisect_left(large, x) for x in small]
        for k, (x, at) in enumerate(zip(small, places)):
            if at and (k == 0 or places[k - 1] != at):
                meet(large[at - 1], x, lcp)
            if at < len(large) and (k + 1 == len(small) or places[k + 1] != at):
                meet(x, large[at], lcp)
        if 8 * len(small) < len(large):
            for x, at in zip(reversed(small), reversed(places)):
                large.insert(at, x)
        else:
            if len(large) == 1:
                home[large[0]] = large
            large += small
            large.sort()
        for x in small:
            home[x] = large
    return sorted(found, key=lambda r: (r[0], r[2]))


def best_of(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length by period; ties by smaller start, then period."""
    best = None
    for run in runs:  # in the order of the ties
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def beyond_first_period(runs: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """Words that some run contains after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) > 0


def _groups(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    """Word lists of consecutive texts, WORDS_AT_ONCE words or one text more at a time."""
    group, held = [], 0
    for t in texts:
        group.append((t.as_py() or "").encode().split())
        held += len(group[-1])
        if held >= WORDS_AT_ONCE:
            yield group
            group, held = [], 0
    if group:
        yield group


def _runs_of_group(group: list[list[bytes]], least: int, times: int) -> list[list[tuple]]:
    ends = np.cumsum([len(w) for w in group])
    hashes = np.fromiter((hash(w) for text in group for w in text), np.int64, ends[-1])
    out = [[] for _ in group]
    for t in may_repeat(hashes.view(np.uint64), ends, useful_prefix(least, times)):
        numbers = {}
        ids = [numbers.setdefault(w, len(numbers)) for w in group[t]]
        out[t] = runs_of(np.array(ids, np.int32), least, times)
    return out


RUN = "struct<start: long, length: long, period: long>"


def runs(docs: DataFrame, least: int = 6, times: int = 4, doc: str = "doc_id",
         text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, runs (sorted by start, then period), best (the run
    with most periods, or null), collapsed (the words that no run contains after its first
    period, joined by one space).

    A null or empty text, or one of fewer than ``least`` words, has no runs. Repeated rows stay,
    ids may be null, no rows give no rows. A text is worked on as a whole by one task; beside
    its words that takes 4 bytes a word for every doubling of its longest repeated sequence.
    """
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def record(run):
        return dict(zip(("start", "length", "period"), run)) if run else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in _groups(batch.column(1)):
                found = _runs_of_group(group, least, times)
                kept = []
                for own, text in zip(found, group):
                    if own:
                        gone = beyond_first_period(own, len(text)).tolist()
                        text = [w for w, drop in zip(text, gone) if not drop]
                    kept.append(b" ".join(text))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(group)),
                     pa.array([len(w) for w in group], pa.int64()),
                     pa.array([[record(r) for r in own] for own in found], kind),
                     pa.array([record(best_of(own)) for own in found], kind.value_type),
                     pa.array(kept, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "best", "collapsed"])
                at += len(group)

    return docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text")) \
        .mapInArrow(run, f"doc_id long, n_words long, runs array<{RUN}>, best {RUN}, "
                         "collapsed string")


def with_planted_period(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where about a tenth of the texts, chosen by the id's checksum, repeat a
    stretch of their words to the end. A null id is not chosen."""
    h = F.crc32(F.col("doc_id").cast("string"))
    n, g = F.size("w"), F.col("g")
    rest = n - F.col("a")
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words(whole())).alias("w"),
                         F.floor(h / 10).alias("g"))
    cut = chosen.withColumn("a", (g % F.greatest(n, F.lit(1))).cast("int"))
    cut = cut.withColumn("p", (1 + F.floor(rest / (3 + g % 8))).cast("int"))
    period = F.slice("w", F.col("a") + 1, F.col("p"))
    repeated = F.slice(F.flatten(F.array_repeat(period, F.ceil(rest / F.col("p")).cast("int"))),
                       F.lit(1), rest)
    planted: Column = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), repeated), " ")
    return cut.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))
