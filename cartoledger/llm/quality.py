"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths, computed in numpy over the word
hashes of a document, tell which n-grams occur more than once; the verdict
looks at the share of a document's characters inside such n-grams and inside
repeated lines. No shuffle: each document is judged on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartoledger.llm.common import ngram_hashes, pieces, text_of, word_hashes

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
SYMBOLS = b"#*$%&|<>"
_NO_SYMBOL = bytes(b for b in range(256) if b not in SYMBOLS)

RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, dup_line_share double, dup_ngram_shares array<double>"
)
_ARROW = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("dup_line_share", pa.float64())]
    + [("dup_ngram_shares", pa.list_(pa.float64()))]
)


@dataclass(frozen=True)
class Rules:
    """Limits. ``max_shares``: n-gram length -> largest share of word characters inside repeated n-grams."""

    min_words: int = 20
    repeat_window: int = 8
    max_repeat_percent: int = 30
    max_line_share: float = 0.30
    max_shares: dict[int, float] = field(
        default_factory=lambda: {5: 0.32, 6: 0.31, 7: 0.30, 8: 0.29, 9: 0.28, 10: 0.27}
    )


def _word_chars(data: bytes) -> np.ndarray:
    """Code points of each word: bytes that are not UTF-8 continuation bytes, between blanks."""
    raw = np.frombuffer(data, np.uint8)
    edges = np.diff(BLANK[raw].astype(np.int8), prepend=1, append=1)
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return points[ends] - points[starts]


def _repeated(hashes: np.ndarray, n: int) -> np.ndarray | None:
    """Mask of the words inside an ``n``-gram that occurs at least twice; None if there is none."""
    grams = ngram_hashes(hashes, n)
    if len(grams) < 2:
        return None
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return None
    twice = np.zeros(len(grams), np.int32)
    twice[order[1:][same]] = 1
    twice[order[:-1][same]] = 1
    steps = np.zeros(len(hashes) + 1, np.int32)
    steps[: len(grams)] += twice
    steps[n : n + len(grams)] -= twice
    return np.cumsum(steps[:-1]) > 0


def judge(data: bytes, rules: Rules) -> tuple:
    """All figures of one document, in the order of ``RESULT`` after ``doc_id``."""
    words = data.split()
    n = len(words)
    chars = _word_chars(data) if n else np.zeros(0, np.int64)
    total = int(chars.sum())
    seen: set[bytes] = set()
    dup_lines = dup_chars = 0
    for line in data.split(b"\n"):
        if line in seen:
            dup_lines += 1
            dup_chars += len(b"".join(line.split()).decode("utf-8", "replace"))
        elif line and not line.isspace():
            seen.add(line)
    hashes = word_hashes(words)
    lengths = sorted(rules.max_shares)
    shares = {k: 0.0 for k in lengths}
    repeat_words = 0
    # A repeated long n-gram holds repeated shorter ones: without those, the longer lengths need no look.
    least = _repeated(hashes, min([*lengths, rules.repeat_window]))
    if least is not None:
        for k in {*lengths, rules.repeat_window}:
            mask = _repeated(hashes, k)
            if mask is None:
                continue
            if k in shares:
                shares[k] = float(chars[mask].sum()) / total
            if k == rules.repeat_window:
                repeat_words = int(mask.sum())
    line_share = dup_chars / total if total else 0.0
    failed = n < rules.min_words or 100 * repeat_words > rules.max_repeat_percent * n
    kept = not failed and line_share <= rules.max_line_share and all(shares[k] <= rules.max_shares[k] for k in lengths)
    symbols = len(data.translate(None, _NO_SYMBOL))
    return n, total, symbols, dup_lines, repeat_words, failed, kept, line_share, [shares[k] for k in lengths]


def quality(docs: DataFrame, rules: Rules | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of figures and a verdict per row of ``docs``.

    Words are runs of anything but space and 0x09-0x0D. A null or empty text
    has no word and fails ``min_words``; repeated rows get equal verdicts; an
    empty table gives an empty result; a null id is carried. A very long text
    costs memory in proportion to its own length only.
    """
    rules = rules or Rules()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = [judge(data, rules) for data in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), *zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [c if i == 0 else pa.array(c, _ARROW.field(i).type) for i, c in enumerate(columns)], schema=_ARROW
            )

    return text_of(docs, id_col, text_col).mapInArrow(run, RESULT)


def keep_good(docs: DataFrame, rules: Rules | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns unchanged; no shuffle.

    The verdict is computed beside the row itself, so equal or null ids cannot mix rows up.
    """
    rules = rules or Rules()
    schema = docs.schema
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            texts = batch.column(at).cast(pa.binary())
            yield batch.filter(pa.array([judge(t.as_py() or b"", rules)[6] for t in texts], pa.bool_()))

    return docs.mapInArrow(run, schema)
