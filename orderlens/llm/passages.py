"""Repeated passages: Rabin-Karp hashes of all windows of a fixed number of words.

Neighbouring windows whose least gram is the same occurrence of the same words travel as one
segment with a hash of all its words, so copies are counted by segment and not by window. A
document that is not the first with a segment loses all of it. Windows are hashed and counted
singly where one gram occurs in different segments, and only for the first document of each:
those are the borders of a passage. No window goes uncounted, since equal windows have the
same least gram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import document_key, lookup
from orderlens.session import staged

GRAM = 10                # words of the grams that cut a text into segments
WORDS_AT_ONCE = 200_000  # words that are hashed together
WORDS_KNOWN = 300_000    # words whose hashes a task remembers
BASE = 0x9E3779B97F4A7C15 | 1
BACK = pow(BASE, -1, 2 ** 64)


class _Hashes(dict):
    """Word to XXH64, computed once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KNOWN:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class Rolling:
    """Hashes of any stretch of a sequence of word hashes, modulo 2**64."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        self.power = np.full(n + 1, BASE, np.uint64)
        back = np.full(n + 1, BACK, np.uint64)
        self.power[0] = back[0] = 1
        np.multiply.accumulate(self.power, out=self.power)
        np.multiply.accumulate(back, out=back)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * back[:n], out=self.sums[1:])

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.power[start])

    def windows(self, size: int) -> np.ndarray:
        """Of every ``size`` consecutive words."""
        count = max(0, len(self.sums) - size)
        return _mixed((self.sums[size:size + count] - self.sums[:count]) * self.power[:count])


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def segments_of(hashes: np.ndarray, text: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(start, number of windows, gram, hash) of the segments of texts one after another;
    ``text`` is the number of each word's text."""
    count = len(hashes) - window + 1
    if count < 1:
        return (np.zeros(0, np.int64),) * 4
    gram = min(GRAM, window)
    rolling = Rolling(hashes)
    grams = rolling.windows(gram)
    inside = np.flatnonzero(text[:count] == text[window - 1:])
    # The first of equal grams: equal windows agree on it.
    least = inside + sliding_window_view(grams, window - gram + 1)[inside].argmin(axis=1) \
        if len(inside) < count else \
        inside + sliding_window_view(grams, window - gram + 1).argmin(axis=1)
    first = np.flatnonzero(np.diff(least, prepend=-1))
    size = np.diff(first, append=len(inside))
    start = inside[first]
    whole = rolling.between(start, start + size + window - 1) + size.astype(np.uint64)
    return start, size, grams[least[first]], whole


def _groups(batch: pa.RecordBatch, text: int) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(first row, word lists) of WORDS_AT_ONCE words, or of one row more."""
    at, group, held = 0, [], 0
    for row, t in enumerate(batch.column(text)):
        group.append((t.as_py() or "").encode().split())
        held += len(group[-1])
        if held >= WORDS_AT_ONCE:
            yield at, group
            at, group, held = row + 1, [], 0
    if group:
        yield at, group


def _segments(docs: DataFrame, window: int) -> DataFrame:
    """(_doc, _hash, gram, whole, start, size) of (_doc, _hash, text)."""
    names = ["_doc", "_hash", "gram", "whole", "start", "size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            for at, group in _groups(batch, 2):
                sizes = np.array([len(w) for w in group])
                text = np.repeat(np.arange(len(group)), sizes)
                start, size, gram, whole = segments_of(
                    known.of([w for words in group for w in words]), text, window)
                rows = text[start] if len(start) else start
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(group)).take(pa.array(rows)),
                     batch.column(1).slice(at, len(group)).take(pa.array(rows)),
                     pa.array(gram.view(np.int64)), pa.array(whole.view(np.int64)),
                     pa.array((start - (np.cumsum(sizes) - sizes)[rows]).astype(np.int32)),
                     pa.array(size.astype(np.int32))], names)

    return docs.select("_doc", "_hash", "text").mapInArrow(
        run, "_doc long, _hash long, gram long, whole long, start int, size int")


def _windows(docs: DataFrame, window: int) -> DataFrame:
    """(gram, hash, _doc, _hash, start) of every window of the segments in ``parts``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            for row in range(batch.num_rows):
                words = batch.column(2)[row].as_py().encode().split()
                hashes = Rolling(known.of(words)).windows(window)
                parts = batch.column(3)[row].values
                start, size, gram = (parts.field(i).to_numpy() for i in range(3))
                place = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
                count = len(place)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(gram, size)), pa.array(hashes[place].view(np.int64)),
                     pa.repeat(batch.column(0)[row], count),
                     pa.repeat(batch.column(1)[row], count),
                     pa.array(place.astype(np.int32))],
                    ["gram", "hash", "_doc", "_hash", "start"])

    return docs.select("_doc", "_hash", "text", "parts").mapInArrow(
        run, "gram long, hash long, _doc long, _hash long, start int")


def _without(docs: DataFrame) -> DataFrame:
    """(doc_id, text, gone) as (doc_id, n_words, n_removed, removed, kept)."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(text: str | None, gone) -> tuple:
        words = (text or "").encode().split()
        spans = []
        if gone is not None:
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, gone.field(0).to_numpy(), 1)
            np.add.at(edge, gone.field(1).to_numpy(), -1)
            edges = np.flatnonzero(np.diff(np.cumsum(edge) > 0, prepend=False)).tolist()
            spans = list(zip(edges[::2], edges[1::2]))
            rest = [0, *edges, len(words)]
            words, n = [w for a, b in zip(rest[::2], rest[1::2]) for w in words[a:b]], len(words)
        else:
            n = len(words)
        return n, n - len(words), [dict(start=a, end=b) for a, b in spans], b" ".join(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                rows = [cut(t.as_py(), gone.values) for t, gone in
                        zip(batch.column(1), batch.column(2))]
                n, removed, spans, kept = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(spans, kind), pa.array(kept, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "n_removed", "removed", "kept"])

    return docs.select("doc_id", "text", "gone").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, "
             "removed array<struct<start: long, end: long>>, kept string")


def dedup(docs: DataFrame, window: int = 50, doc: str = "doc_id",
          text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, removed (maximal intervals of word
    numbers, ends exclusive), kept (the other words, joined by one space).

    A word goes if a window of ``window`` words covers it whose words also stand in a document
    with a smaller id. Windows are judged on the input. Null, empty and shorter texts lose
    nothing; neither do rows without an id, nor do they take anything from others. Rows that
    share an id take nothing from one another. No rows give no rows.
    """
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    keyed = rows.select(*document_key(), "doc_id", "text")
    named = keyed.where("doc_id is not null and text is not null")
    segments = staged(_segments(named, window))
    counted = staged(segments.groupBy("gram", "whole").agg(
        F.min("_doc").alias("first"), F.max("_doc").alias("last"), F.count("*").alias("n")))
    # One gram in different segments: their windows may be equal in part.
    mixed = staged(counted.groupBy("gram").agg(
        F.count("*").alias("n_whole"), F.min("first").alias("low"), F.max("last").alias("high"))
        .where("n_whole > 1 and low < high").select("gram", "n_whole"))
    shared = staged(lookup(counted, mixed, ["gram"], "n_whole").where(
        "n_whole is not null or first < last").select(
        "gram", "whole", "first", "n", F.col("n_whole").isNotNull().alias("mixed")))
    met = staged(lookup(segments, shared, ["gram", "whole"], "n").where(
        "_doc > first or mixed").drop("n"))
    later = met.where("_doc > first").select(
        "_doc", "_hash", "start", (F.col("start") + F.col("size") + (window - 1)).alias("end"))

    parts = met.where("_doc = first").groupBy("_doc", "_hash").agg(
        F.collect_set(F.struct("start", "size", "gram")).alias("parts"))
    texts = named.select("_doc", "_hash", "text")
    windows = staged(_windows(texts.join(parts, ["_doc", "_hash"]), window))
    owners = staged(windows.groupBy("gram", "hash").agg(
        F.min("_doc").alias("first"), F.max("_doc").alias("last"), F.count("*").alias("n"))
        .where("first < last").drop("last"))
    border = lookup(windows, owners, ["gram", "hash"], "n").where("_doc > first").select(
        "_doc", "_hash", "start", (F.col("start") + window).alias("end"))

    gone = later.union(border).groupBy("_doc", "_hash").agg(
        F.collect_set(F.struct("start", "end")).alias("gone"))
    return _without(keyed.join(gone, ["_doc", "_hash"], "left"))
