"""Repetition coverage: rolling hashes of several n-gram lengths in numpy.

Per text: the share of its words' characters that lie in n-grams seen earlier in the text, the share taken by
the most frequent short n-gram, and repeated lines; the base rules count first occurrences too. Texts stay where they are:
one map over the scan, no shuffle.

The words of a text are numbered in order of first occurrence; a window's hash is built from the shorter
window's by one multiplication and one addition per position (mod 2^64). Windows with equal hashes are
compared word by word, so a collision cannot count as a repetition.

Defined results: a null or empty text has no words, all counts 0, and fails the base rules; repeated rows get
equal results each; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"
BASE_LENGTH = 5
#: Most of the words' characters that may lie in n-grams seen earlier, by n.
COVERAGE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Most of the words' characters that the most frequent n-gram may take, by n.
TOP = {2: 0.20, 3: 0.18, 4: 0.16}
DUPLICATE_LINES, DUPLICATE_LINE_CHARS = 0.30, 0.20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
    " base_failed boolean, kept boolean, top_share double, repeat_share double, dup_line_share double,"
    " dup_line_char_share double"
)


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """Spread small numbers over 64 bits."""
    x = (numbers.astype(np.uint64) + np.uint64(1)) * _MULTIPLIER
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    return x * np.uint64(0x94D049BB133111EB)


def _groups(hashes: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Start positions of windows found twice or more, and the number of the window's group; None if there are none."""
    ordered = np.sort(hashes)
    if not (ordered[1:] == ordered[:-1]).any():
        return None
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    for k in range(n):
        if not (ids[order[1:] + k] == ids[order[:-1] + k])[same].all():  # a collision: compare the windows themselves
            windows = np.lib.stride_tricks.sliding_window_view(ids, n)
            group = np.unique(windows, axis=0, return_inverse=True)[1].ravel()
            order = np.argsort(group, kind="stable")
            same = group[order[1:]] == group[order[:-1]]
            break
    number = np.concatenate(([0], np.cumsum(~same)))
    twice = np.concatenate(([False], same)) | np.concatenate((same, [False]))
    return (order[twice], number[twice]) if twice.any() else None


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Words inside any of the windows."""
    change = np.bincount(starts, minlength=size + 1) - np.bincount(starts + n, minlength=size + 1)
    return np.cumsum(change[:size]) > 0


def measure(text: str | None) -> tuple:
    """The result row of one text, without its key."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    word_chars = len(text) - sum(map(text.count, SPACES))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    seen: set[str] = set()
    dup_lines = dup_chars = line_chars = 0
    for line in lines:
        line_chars += len(line)
        if line in seen:
            dup_lines += 1
            dup_chars += len(line)
        seen.add(line)
    repeat_words, top, repeat, failed_rule = 0, 0.0, 0.0, False
    if words:
        ids, distinct = pd.factorize(np.array(words, dtype=object))
        lengths = np.array([len(w.decode("utf-8", "surrogatepass")) for w in distinct], dtype=np.int64)[ids]
        one = _mixed(ids)
        rolling = one
        for n in range(2, max(COVERAGE) + 1):
            if len(ids) <= n:
                break
            rolling = rolling[:-1] * _MULTIPLIER + one[n - 1 :]
            found = _groups(rolling, ids, n)
            if found is None:
                break  # a longer window cannot repeat where no shorter one does
            starts, group = found
            first = np.concatenate(([True], group[1:] != group[:-1]))
            if n in TOP:
                width = np.concatenate(([0], np.cumsum(lengths)))
                at = starts[first]
                size = (width[at + n] - width[at]) * np.bincount(group)[group[first]]
                share = size.max() / word_chars
                top = max(top, share)
                failed_rule |= share > TOP[n]
            if n in COVERAGE:
                share = lengths[_covered(starts[~first], n, len(ids))].sum() / word_chars
                repeat = max(repeat, share)
                failed_rule |= share > COVERAGE[n]
                if n == BASE_LENGTH:
                    repeat_words = int(_covered(starts, n, len(ids)).sum())
    line_share = dup_lines / len(lines) if lines else 0.0
    char_share = dup_chars / line_chars if line_chars else 0.0
    failed_rule |= line_share > DUPLICATE_LINES or char_share > DUPLICATE_LINE_CHARS
    failed = len(words) < 10 or 100 * repeat_words > 20 * len(words)
    kept = not (failed or failed_rule)
    return len(words), word_chars, n_symbols, dup_lines, repeat_words, failed, kept, top, repeat, line_share, char_share


def repetition(documents: DataFrame) -> DataFrame:
    """Repetition measures and verdict of every document (doc_id, text)."""
    names = [part.split()[0] for part in SCHEMA.split(", ")][1:]

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = pd.DataFrame([measure(text) for text in batch["text"]], columns=names)
            for name in ("top_share", "repeat_share", "dup_line_share", "dup_line_char_share"):
                rows[name] = rows[name].astype(float).round(6)
            yield pd.concat([batch[["doc_id"]].reset_index(drop=True), rows], axis=1)

    return documents.select("doc_id", "text").mapInPandas(measured, SCHEMA)
