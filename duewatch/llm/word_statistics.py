"""Counts over the words and lines of a text."""

from __future__ import annotations

import numpy as np

from duewatch.llm.text import words_of

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
RUN = 8
FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], run: int = RUN) -> int:
    """Words under a window of ``run`` words that occurs twice or more in the text, exactly.

    Windows are numbered by joining the numbers of two windows of half the length.
    """
    count = len(words) - run + 1
    if count < 2 or run & (run - 1):
        if run & (run - 1):
            raise ValueError("the window must be a power of two")
        return 0
    places: dict[bytes, int] = {}
    numbers = np.fromiter((places.setdefault(w, len(places)) for w in words), np.int64, len(words))
    width = 1
    while width < run:
        joined = numbers[:-width] * np.int64(len(words)) + numbers[width:]
        width *= 2
        _, numbers = np.unique(joined, return_inverse=True)
    often = np.bincount(numbers)[numbers] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(often)
    edges[starts] += 1
    edges[starts + run] -= 1
    return int(np.count_nonzero(np.cumsum(edges[:-1]) > 0))


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in text:
        return 0
    seen: set[bytes] = set()
    found = 0
    for line in text.split(b"\n"):
        if line in seen:
            found += 1
        elif line.strip(SPACES):
            seen.add(line)
    return found


def statistics(text: bytes | None) -> tuple[int, int, int, int, int]:
    """The values of FIELDS; a null text has none of anything."""
    if not text:
        return 0, 0, 0, 0, 0
    words = words_of(text)
    bare = text.translate(None, SPACES)
    return (
        len(words),
        len(bare.decode("utf-8", "replace")),
        len(text) - len(text.translate(None, SYMBOLS)),
        duplicate_lines(text),
        repeated_words(words),
    )
