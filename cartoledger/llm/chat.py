r"""Chat formatting by columnar byte assembly.

A turn becomes ``<|im_start|>ROLE\nTEXT<|im_end|>\n``; a conversation is its
turns one after the other. Control strings inside a text are escaped
reversibly: in every run of ``<``, backslashes and ``|`` one more backslash
follows the ``<``, so no text can hold ``<|``; reading takes it out again. In
roles, backslash and line feed are written ``\\`` and ``\n`` before that.

The assembly is columnar: segment lengths give cumulative offsets, offsets give
scatter positions, and headers and contents are copied into one preallocated
buffer per Arrow batch. Turns are formatted where they lie, without a shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoledger.llm.common import pieces

START, END = b"<|im_start|>", b"<|im_end|>\n"
LEARNED_ROLE = "assistant"
_ESCAPE = re.compile(rb"<(\\*)\|")
_UNESCAPE = re.compile(rb"<\\(\\*)\|")
_ROLE_ESCAPE = re.compile(rb"\\(.)", re.S)
_SEGMENT = re.compile(re.escape(START) + rb"([^\n]*)\n(.*)" + re.escape(END), re.S)


def escape(data: bytes) -> bytes:
    return _ESCAPE.sub(rb"<\\\1|", data)


def unescape(data: bytes) -> bytes:
    return _UNESCAPE.sub(rb"<\1|", data) if b"<\\" in data else data


def _header(role: bytes) -> bytes:
    return START + escape(role.replace(b"\\", b"\\\\").replace(b"\n", b"\\n")) + b"\n"


def _role(written: bytes) -> bytes:
    return _ROLE_ESCAPE.sub(lambda m: b"\n" if m[1] == b"n" else m[1], unescape(written))


def _within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each segment of the given lengths."""
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _escapes(content: np.ndarray) -> np.ndarray:
    """Positions of each ``<`` that is followed by any backslashes and a ``|``."""
    opens = np.flatnonzero(content == 0x3C)
    if not len(opens):
        return opens
    others = np.flatnonzero(content != 0x5C)
    after = np.searchsorted(others, opens, side="right")
    ended = after >= len(others)
    nexts = content[others[np.minimum(after, len(others) - 1)]]
    return opens[~ended & (nexts == 0x7C)]


def assemble(roles: list[bytes], texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All segments of a batch in one buffer: ``(buffer, offsets, first, last)``; texts lie in ``[first, last)``."""
    texts = texts.cast(pa.large_binary())
    known: dict[bytes, int] = {}
    code = np.array([known.setdefault(r, len(known)) for r in roles], np.int64)
    headers = [_header(r) for r in known]
    head_size = np.array([len(h) for h in headers], np.int64)
    head_at = np.cumsum(head_size) - head_size
    head_bytes = np.frombuffer(b"".join(headers), np.uint8)

    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    raw = texts.buffers()[2]
    whole = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    content = whole[offsets[0] : offsets[-1]]
    starts = offsets[:-1] - offsets[0]
    size = np.diff(offsets)

    # Escapes never cross rows: a row's last "<" whose "|" is the next row's first byte is not one.
    marks = _escapes(content)
    if len(marks):
        row = np.searchsorted(offsets - offsets[0], marks, side="right") - 1
        others = np.flatnonzero(content != 0x5C)
        bar = others[np.searchsorted(others, marks, side="right")]
        marks = marks[bar < (offsets[1:] - offsets[0])[row]]
    flags = np.zeros(len(content) + 1, np.int64)
    flags[marks + 1] = 1
    before = np.cumsum(flags)  # escapes placed before each byte
    added = before[starts + size] - before[starts]
    # an escape of the last byte cannot occur: its "|" follows in the same row

    lead = head_size[code]
    length = lead + size + added + len(END)
    ends = np.cumsum(length)
    at = ends - length
    out = np.empty(int(ends[-1]) if n else 0, np.uint8)
    step = _within(lead)
    out[np.repeat(at, lead) + step] = head_bytes[np.repeat(head_at[code], lead) + step]
    shift = np.repeat(at + lead - starts - before[starts], size)
    target = np.arange(len(content)) + shift + before[:-1]
    out[target] = content
    out[target[marks] + 1] = 0x5C
    tail = ends - len(END)
    out[tail[:, None] + np.arange(len(END))] = np.frombuffer(END, np.uint8)
    return out, np.concatenate(([0], ends)), lead, lead + size + added


def format_turns(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``(conv_id, turn, segment, loss_start, loss_end)``, one row per turn; no shuffle.

    ``segment`` is the formatted turn; the bytes in ``[loss_start, loss_end)``
    are under the loss mask (an assistant's text, escaped; empty for other
    roles). A null role or text is empty. A conversation is its segments in
    the order of turn; equal turns are ordered by their bytes, a null turn
    comes first.
    """
    schema = pa.schema(
        [("conv_id", pa.int64()), ("turn", pa.int64()), ("segment", pa.binary())]
        + [("loss_start", pa.int32()), ("loss_end", pa.int32())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 32_000_000):
            roles = batch.column("role").to_pylist()
            buffer, offsets, first, last = assemble(roles, batch.column("text"))
            learned = np.array([r == LEARNED_ROLE.encode() for r in roles])
            segments = pa.Array.from_buffers(
                pa.large_binary(), len(roles), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(buffer)]
            ).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    batch.column("turn"),
                    segments,
                    pa.array(np.where(learned, first, 0).astype(np.int32)),
                    pa.array(np.where(learned, last, 0).astype(np.int32)),
                ],
                schema=schema,
            )

    blank = F.lit(b"")
    return turns.select(
        turns[conv_col].cast("long").alias("conv_id"),
        turns[turn_col].cast("long").alias("turn"),
        F.coalesce(turns[role_col].cast("binary"), blank).alias("role"),
        F.coalesce(turns[text_col].cast("binary"), blank).alias("text"),
    ).mapInArrow(run, "conv_id long, turn long, segment binary, loss_start int, loss_end int")


def read_segment(segment: bytes) -> tuple[bytes, bytes]:
    """``(role, text)`` of a formatted turn."""
    found = _SEGMENT.fullmatch(segment)
    if found is None:
        raise ValueError("not a formatted turn")
    return _role(found[1]), unescape(found[2])


def _points(data: bytes) -> int:
    return int(((np.frombuffer(data, np.uint8) & 0xC0) != 0x80).sum())


def digest(segments: DataFrame) -> DataFrame:
    """Per conversation what reads back from its formatted turns.

    Segments are sorted by conversation inside each partition and streamed, so
    a conversation of any length needs no more memory than one batch. Columns:
    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.
    A null conv_id is a conversation of its own.
    """
    schema = pa.schema(
        [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string())]
        + [("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, open_, done = None, None, []

        def close() -> None:
            n, turns, chars, loss, size = open_
            done.append((current, n, turns.hexdigest(), chars, loss.hexdigest(), size))

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, schema.field(i).type) for i, c in enumerate(zip(*done, strict=True))]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for batch in batches:
            for row in zip(*(batch.column(c) for c in range(4)), strict=True):
                conv, segment, low, high = (v.as_py() for v in row)
                if open_ is None or conv != current:
                    if open_ is not None:
                        close()
                    current, open_ = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = read_segment(segment)
                open_[0] += 1
                open_[1].update(role + b"\n" + text + b"\n")
                if high > low:
                    learned = unescape(segment[low:high])
                    open_[2] += _points(learned)
                    open_[3].update(learned)
                open_[4] += _points(segment)
            if done:
                yield flush()
        if open_ is not None:
            close()
            yield flush()

    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")
    return ordered.select("conv_id", "segment", "loss_start", "loss_end").mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
