"""Byte-level BPE by merge replay over many words at once.

Texts are cut into chunks: a run of other characters than white space with the one space
before it, or white space. The split pattern never crosses a chunk, so a chunk's ids do not
depend on its place, and each distinct chunk of a batch is encoded once. All pieces not seen
before go through one replay: an inverted index from the pair's rank to word positions is
worked off in rank order, and a merge updates only its two neighbours.

The corpus meets the replay in slices: the distinct chunks of a slice of one task's rows,
SLICE characters or one text. A corpus-wide vocabulary would have to shuffle every word.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Characters of the Unicode property White_Space, as the inside of a character class.
SPACE = r"\t-\r \x85\xa0  -     　"
CHUNK = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
SLICE = 1_000_000      # characters whose chunks meet in one replay
REMEMBERED = 300_000   # distinct chunks in the newer of two generations a worker keeps
ROWS = 500             # texts of an Arrow batch handled at once
NONE = -1


def plain_pattern(pattern: str) -> str:
    """The split pattern with white space spelled out, whatever the engine takes ``\\s`` for."""
    pattern = pattern.replace(r"[^\s", f"[^{SPACE}")
    return pattern.replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")


class Encoder:
    """Ranks of a byte-level BPE vocabulary, and the chunks encoded so far."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.split = regex.compile(plain_pattern(pattern)).findall
        self.single = np.array([ranks[bytes([b])] for b in range(256)])
        # Ids stand apart by twice the width, so that no pair with an end mark is a key.
        self.width = 2 * (max(ranks.values()) + 2)
        self.pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left * self.width + right] = rank
        self.byte_pairs = np.array([[ranks.get(bytes([a, b]), NONE) for b in range(256)]
                                    for a in range(256)])
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def replay(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece. Positions of all pieces lie in one array, ends marked by -1."""
        width, get = self.width, self.pairs.get
        if not pieces:
            return []
        sizes = np.array([len(p) for p in pieces])
        data = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
        ends = np.cumsum(sizes + 1) - 1
        start = self.single[data]
        start[ends] = -1
        first = (ends - sizes).tolist()
        # Ranks of neighbouring bytes; pairs over an end have none.
        ranks = self.byte_pairs[data[:-1], data[1:]]
        ranks[ends[:-1]] = NONE
        ranks[ends[1:] - 1] = NONE
        if sizes[0]:
            ranks[ends[0] - 1] = NONE
        places = np.flatnonzero(ranks != NONE)
        places = places[np.argsort(ranks[places], kind="stable")]
        present, cuts = np.unique(ranks[places], return_index=True)
        index = {r: p.tolist() for r, p in zip(present.tolist(), np.split(places, cuts[1:]))}
        queue = present.tolist()
        symbol = start.tolist()
        size = len(symbol)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        while queue:
            rank = heappop(queue)
            places = index.pop(rank, None)
            if places is None:
                continue
            places.sort()
            lower = rank
            for n, at in enumerate(places):
                left, follows = symbol[at], after[at]
                # A merged-away place holds -2, so neither it nor an outdated pair fits.
                if left < 0 or get(left * width + symbol[follows]) != rank:
                    continue
                symbol[at], symbol[follows] = rank, -2
                end, ahead = after[follows], before[at]
                after[at], before[end] = end, at
                # An end has symbol -1; its product with any id is no key.
                new = get(symbol[ahead] * width + rank)
                if new is not None:
                    if new in index:
                        index[new].append(ahead)
                    else:
                        index[new] = [ahead]
                        heappush(queue, new)
                    if new < lower:
                        lower = new
                new = get(rank * width + symbol[end])
                if new is not None:
                    if new in index:
                        index[new].append(at)
                    else:
                        index[new] = [at]
                        heappush(queue, new)
                    if new < lower:
                        lower = new
                if lower < rank and n + 1 < len(places):
                    # A new pair comes before the rest of this rank.
                    index.setdefault(rank, []).extend(places[n + 1:])
                    heappush(queue, rank)
                    break
        out = []
        for at in first:
            ids = []
            while symbol[at] >= 0:
                ids.append(symbol[at])
                at = after[at]
            out.append(ids)
        return out

    def learn(self, chunks: set[str]) -> None:
        """Encode chunks not known yet, all in one replay."""
        known, older = self.known, self.older
        new = []
        for chunk in chunks - known.keys():
            if chunk in older:
                known[chunk] = older[chunk]
            else:
                new.append(chunk)
        cut = [[p.encode() for p in self.split(c)] for c in new]
        unknown = list({p for pieces in cut for p in pieces if p not in self.ranks})
        ids = dict(zip(unknown, self.replay(unknown)))
        for chunk, pieces in zip(new, cut):
            flat = []
            for p in pieces:
                whole = self.ranks.get(p)
                flat += ids[p] if whole is None else (whole,)
            known[chunk] = array("I", flat).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        waiting: list[list[str]] = []
        size = 0
        for n, text in enumerate(texts):
            waiting.append(CHUNK.findall(text))
            size += len(text)
            if size >= SLICE or n + 1 == len(texts):
                self.learn(set().union(*waiting))
                known = self.known
                out += [b"".join([known[c] for c in chunks]) for chunks in waiting]
                waiting, size = [], 0
                if len(known) > REMEMBERED:
                    self.known, self.older = {}, known
        return out


@lru_cache(maxsize=2)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(_ranks(path), pattern)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ROWS, so that no worker holds many texts twice."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def encode(docs: DataFrame, path: str, pattern: str, doc: str = "doc_id",
           text: str = "text") -> DataFrame:
    """doc_id, n_tokens, and ids as little-endian unsigned 32-bit integers.

    ``path`` is a rank file that every executor can read at that place. A null text counts
    as empty (no ids). One row per input row, repeats included.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch in _parts(batches):
            ids = encoder.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()),
                 pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    plain = docs.select(F.col(doc).cast("long").alias("doc_id"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    return plain.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The encoded table with ``decoded``, the bytes its ids stand for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: word for word, rank in _ranks(path).items()}
        for batch in _parts(batches):
            texts = [b"".join([token[i] for i in memoryview(ids).cast("I")])
                     for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary())],
                [*batch.schema.names, "decoded"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{fields}, decoded binary")
