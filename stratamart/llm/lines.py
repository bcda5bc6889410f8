"""Words, lines and repeated windows of one text, as UTF-8 bytes."""

from __future__ import annotations

import numpy as np

#: Counted by the quality rules.
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
_ODD = np.uint64(0x9E3779B97F4A7C15)


def word_ids(words: list[bytes]) -> np.ndarray:
    """Numbers of the words within one text, equal for equal words."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.uint64, len(words))


def _windows(ids: np.ndarray, width: int) -> np.ndarray:
    """A number for each window; equal windows have equal numbers, different ones may by chance."""
    n = len(ids) - width + 1
    mixed = np.zeros(n, np.uint64)
    for j in range(width):
        mixed = mixed * _ODD + ids[j : n + j] + np.uint64(1)
    return mixed


def _exact_windows(ids: np.ndarray, width: int) -> np.ndarray:
    """A number for each window; only equal windows have equal numbers."""
    known = ids
    for j in range(1, width):
        pair = known[:-1] * np.uint64(len(ids) + 1) + ids[j:]
        known = np.unique(pair, return_inverse=True)[1].astype(np.uint64)
    return known


def repeated_words(ids: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Marks the words in windows that are found twice or more, the first included."""
    marks = np.zeros(len(ids), bool)
    if len(ids) <= width:
        return marks
    mixed = np.sort(_windows(ids, width))
    if (mixed[1:] != mixed[:-1]).all():  # equal windows would have equal numbers
        return marks
    _, at, count = np.unique(_exact_windows(ids, width), return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[at] > 1)
    for j in range(width):
        marks[starts + j] = True
    return marks


def count_symbols(text: bytes) -> int:
    return len(text) - len(text.translate(None, SYMBOLS))
