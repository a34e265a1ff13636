"""Quality rules: how much of a text repeats itself.

Words become small integers per text; a rolling hash over them, taken in numpy for several n-gram lengths at once
from one prefix sum, finds windows that occur again. What later occurrences cover is measured in characters, as are
lines equal to an earlier line.

Defined results: a null or empty text has no words, so it fails the length rule; a null id is passed through; equal
rows give equal results; other columns are not touched.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cartmill.llm import common

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = re.compile(r"[#*$%&|<>]")

# an odd multiplier has an inverse modulo 2**64, which turns a difference of prefix sums into a window's hash
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


@dataclass(frozen=True)
class RepetitionLimits:
    """Largest accepted percentages of word characters, by n-gram length and for lines, and the base rules.

    ``line_count`` is the largest share of lines with a word that equal an earlier one; it holds from ``least_lines``
    repeated lines on, as a short clean text may repeat one line of three.
    """

    ngrams: dict[int, int] = field(default_factory=lambda: {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10})
    line_chars: int = 20
    line_count: int = 30
    least_lines: int = 2
    min_words: int = 50
    max_repeat_percent: int = 50


def _mixed(ids: np.ndarray) -> np.ndarray:
    """A 64-bit value per word number whose bits look random."""
    z = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def window_hashes(ids: np.ndarray, lengths) -> dict[int, np.ndarray]:
    """Rolling hashes of all windows of the given lengths."""
    n = len(ids)
    with np.errstate(over="ignore"):
        prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_mixed(ids) * _powers(_BASE, n), dtype=np.uint64, out=prefix[1:])
        back = _powers(_BASE_INVERSE, n)
        return {k: (prefix[k:] - prefix[:-k]) * back[: n - k + 1] for k in lengths if n >= k}


def _repeat_words(ids: np.ndarray, k: int = 3) -> int:
    """Words inside k-word windows found twice or more; windows are numbered exactly, not hashed."""
    n = len(ids)
    if n <= k:
        return 0
    width = np.int64(ids.max() + 1)
    number = ids.astype(np.int64)
    for step in range(1, k):
        pair = number[: n - step] * width + ids[step:]
        number = np.unique(pair, return_inverse=True)[1] if step < k - 1 else pair
    _, inverse, counts = np.unique(number, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    return _marks(starts, k, n) if len(starts) else 0


def _marks(starts: np.ndarray, k: int, n: int, weight: np.ndarray | None = None) -> int:
    edge = np.zeros(n + 1, dtype=np.int64)
    edge[starts] = 1
    inside = np.cumsum(edge)
    inside[k:] -= np.cumsum(edge)[:-k]
    covered = inside[:n] > 0
    return int(covered.sum() if weight is None else weight[covered].sum())


def measure(text: str | None, limits: RepetitionLimits) -> tuple:
    """The columns that ``repetition_quality`` adds, for one text."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=n)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
    word_chars = int(sizes.sum())
    lines = dup_lines = dup_line_chars = 0
    seen: set[str] = set()
    for line in text.split("\n"):
        if WORD.search(line) is None:
            continue
        lines += 1
        if line in seen:
            dup_lines += 1
            dup_line_chars += sum(map(len, WORD.findall(line)))
        seen.add(line)
    repeat_words = _repeat_words(ids) if len(numbers) < n else 0
    dup_chars = dict.fromkeys(limits.ngrams, 0)
    if repeat_words:  # longer windows repeat only where three words do
        for k, hashes in window_hashes(ids, limits.ngrams).items():
            first = np.unique(hashes, return_index=True)[1]
            if len(first) < len(hashes):
                later = np.ones(len(hashes), dtype=bool)
                later[first] = False
                dup_chars[k] = _marks(np.flatnonzero(later), k, n, sizes)
    base_failed = n < limits.min_words or 100 * repeat_words > limits.max_repeat_percent * n
    kept = not base_failed and not (
        100 * dup_line_chars > limits.line_chars * word_chars
        or (dup_lines >= limits.least_lines and 100 * dup_lines > limits.line_count * lines)
        or any(100 * dup_chars[k] > share * word_chars for k, share in limits.ngrams.items())
    )
    symbols = len(SYMBOLS.findall(text))
    return (n, word_chars, symbols, dup_lines, repeat_words, dup_line_chars, list(dup_chars.values()), base_failed, kept)


def repetition_quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: RepetitionLimits | None = None
) -> DataFrame:
    """Repetition measures and verdict per row; ``dup_ngram_chars`` follows the order of ``limits.ngrams``."""
    limits = limits or RepetitionLimits()
    long = T.LongType()
    schema = common.schema_of(
        common.field(docs, id_col),
        *[(c, long) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars")],
        ("dup_ngram_chars", T.ArrayType(long)),
        ("base_failed", T.BooleanType()),
        ("kept", T.BooleanType()),
    )

    def rows(batch):
        for key, text in batch:
            yield (key, *measure(text, limits))

    return common.arrow_map(common.doc_rows(docs, id_col, text_col), rows, schema)
