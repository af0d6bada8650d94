"""Chat formatting: turns to marked text with a loss mask, and back.

One turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings start with ``<|``;
inside roles and texts a backslash goes between ``<`` and ``|`` (one more where some stand
there already), so no turn can forge a marker and the change can be undone. Line breaks in a
role are written as ``\\n``, backslashes there doubled.

A conversation's text is its segments in turn order. Segments are built where the rows are,
before any shuffle, so one huge conversation costs no task more than its rows; only the
read-back streams a conversation in order, holding one Arrow batch at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, MIDDLE, END = b"<|im_start|>", b"\n", b"<|im_end|>\n"
ORDER = ["conv_id", "turn", "role", "text"]
SEGMENTS = ("conv_id long, turn long, role string, text string, segment string, "
            "loss_start long, loss_end long")


def escape(column: pa.Array) -> pa.Array:
    """Put one backslash between ``<`` and ``|``, however many stand there already."""
    return pc.replace_substring_regex(column, r"<(\\*)\|", r"<\\\1|")


def unescape(column: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(column, r"<\\(\\*)\|", r"<\1|")


def escape_role(column: pa.Array) -> pa.Array:
    column = pc.replace_substring(column, "\\", "\\\\")
    return escape(pc.replace_substring(column, "\n", "\\n"))


def unescape_role(column: pa.Array) -> pa.Array:
    """Undo ``escape_role``; the parts between doubled backslashes are handled one by one."""
    parts = pc.split_pattern(unescape(column).cast(pa.string()), "\\\\")
    flat = pc.replace_substring(pc.list_flatten(parts), "\\n", "\n")
    return pc.binary_join(pa.ListArray.from_arrays(parts.offsets, flat), "\\")


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Data bytes, start offsets and lengths of a string column without nulls."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:][:len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8),
            offsets[:-1], np.diff(offsets))


def _scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, start: np.ndarray,
             size: np.ndarray) -> None:
    """Copy piece i of ``data`` to ``out[at[i]:]``, all pieces in one indexed copy."""
    before = np.cumsum(size) - size
    step = np.arange(int(size.sum()))
    out[step + np.repeat(at - before, size)] = data[step + np.repeat(start - before, size)]


def _fixed(out: np.ndarray, at: np.ndarray, mark: bytes) -> None:
    """Copy the same bytes to every place."""
    out[at[:, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)


def build_segments(role: pa.Array, text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Segments as one Arrow buffer, with start and end of each text in characters."""
    roles, texts = escape_role(role), escape(text)
    head, head_at, head_size = _bytes_of(roles)
    body, body_at, body_size = _bytes_of(texts)
    size = len(START) + head_size + len(MIDDLE) + body_size + len(END)
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    out = np.empty(int(offsets[-1]), np.uint8)
    at = offsets[:-1]
    _fixed(out, at, START)
    at = at + len(START)
    _scatter(out, at, head, head_at, head_size)
    at = at + head_size
    _fixed(out, at, MIDDLE)
    at = at + len(MIDDLE)
    _scatter(out, at, body, body_at, body_size)
    _fixed(out, at + body_size, END)
    segments = pa.LargeStringArray.from_buffers(
        len(size), pa.py_buffer(offsets), pa.py_buffer(out))
    first = len(START) + len(MIDDLE) + pc.utf8_length(roles).to_numpy(zero_copy_only=False)
    return segments, first, first + pc.utf8_length(texts).to_numpy(zero_copy_only=False)


def format_turns(turns: DataFrame) -> DataFrame:
    """Each turn with its segment and the part of it under the loss mask.

    ``loss_start`` and ``loss_end`` are characters within the segment, null unless the role
    is ``assistant``. A null text or role counts as empty; an unknown role is kept as it is;
    other columns are ignored; no rows give no rows; repeated rows are turns like any other.
    """
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            role, text = batch.column("role"), batch.column("text")
            segments, first, last = build_segments(role, text)
            masked = pc.equal(role, "assistant")
            none = pa.scalar(None, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), role, text,
                 segments.cast(pa.string()),
                 pc.if_else(masked, pa.array(first, pa.int64()), none),
                 pc.if_else(masked, pa.array(last, pa.int64()), none)],
                ["conv_id", "turn", "role", "text", "segment", "loss_start", "loss_end"])

    plain = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return plain.mapInArrow(build, SEGMENTS)


def in_order(segments: DataFrame) -> DataFrame:
    """Segments of a conversation next to each other, in turn order (nulls first, ties by
    role and text). Only the segment and its mask travel besides the order."""
    return segments.repartition("conv_id").sortWithinPartitions(*ORDER)


def parse_segments(segments: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Roles and texts of segments, read from the marked text alone."""
    inner = pc.utf8_slice_codeunits(segments, len(START), stop=None)
    cut = pc.find_substring(inner, "\n").to_numpy(zero_copy_only=False)
    data, at, size = _bytes_of(inner)

    def piece(start: np.ndarray, length: np.ndarray) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
        out = np.empty(int(offsets[-1]), np.uint8)
        _scatter(out, offsets[:-1], data, start, length)
        return pa.LargeStringArray.from_buffers(
            len(length), pa.py_buffer(offsets), pa.py_buffer(out))

    roles = piece(at, cut)
    texts = piece(at + cut + 1, size - cut - 1 - len(END))
    return unescape_role(roles), unescape(texts)


def read_back(ordered: DataFrame) -> DataFrame:
    """One row per conversation from ordered segments: counts and digests of what they say.

    The digests run on across Arrow batches, so a conversation may be larger than memory.
    """
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
              "loss_sha256 string, formatted_chars long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_row: list | None = None

        def closed(rows: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "conv_id": pa.array([r[0] for r in rows], pa.int64()),
                "n_turns": pa.array([r[1] for r in rows], pa.int64()),
                "turns_sha256": [r[2].hexdigest() for r in rows],
                "loss_chars": pa.array([r[3] for r in rows], pa.int64()),
                "loss_sha256": [r[4].hexdigest() for r in rows],
                "formatted_chars": pa.array([r[5] for r in rows], pa.int64())})

        for batch in batches:
            segments = batch.column("segment")
            roles, texts = parse_segments(segments)
            rows, done = zip(
                batch.column("conv_id").to_pylist(), roles.to_pylist(), texts.to_pylist(),
                segments.to_pylist(), batch.column("loss_start").to_pylist(),
                batch.column("loss_end").to_pylist()), []
            for conv, role, text, segment, start, end in rows:
                if open_row is None or open_row[0] != conv:
                    if open_row is not None:
                        done.append(open_row)
                    open_row = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                open_row[1] += 1
                open_row[2].update(f"{role}\n{text}\n".encode())
                open_row[5] += len(segment)
                if start is not None:
                    learned = unescape(pa.array([segment[start:end]]))[0].as_py()
                    open_row[3] += len(learned)
                    open_row[4].update(learned.encode())
            if done:
                yield closed(done)
        if open_row is not None:
            yield closed([open_row])

    return ordered.mapInArrow(read, schema)
