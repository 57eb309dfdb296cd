"""Words of texts and their rolling hashes, as numpy arrays inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
MIX = np.uint64(0xD6E8FEB86659FD93)
CACHED_WORDS = 400_000  # a worker's table of word hashes is emptied beyond this; it is only a cache

_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


class WordHashes(dict):
    """64-bit hash of each word seen, computed on first use."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHED_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: bytes | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of a UTF-8 text: bytes.split() cuts at exactly these six characters."""
    return text.split() if text else []


def binary_texts(batch, column: str) -> list[bytes | None]:
    """A string column of an Arrow batch or table as UTF-8 bytes, without decoding."""
    import pyarrow as pa

    return batch.column(column).cast(pa.large_binary()).to_pylist()


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values = values * MIX
    return values ^ (values >> np.uint64(29))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        _powers = tuple(
            np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, base, np.uint64))]) for base in (BASE, INVERSE)
        )
    return _powers[0][:n], _powers[1][:n]


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash, modulo 2^64, of each run of ``width`` consecutive word hashes."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    up, down = powers(len(hashes))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * down)])
    return mixed((sums[width:] - sums[:-width]) * up[:count])


def windows_inside(lengths: np.ndarray, width: int) -> np.ndarray:
    """For texts laid end to end: whether the window that starts at a word ends in the same text."""
    total = int(lengths.sum())
    if total < width:
        return np.zeros(0, bool)
    ends = np.repeat(np.cumsum(lengths), lengths)
    return np.arange(width, total + 1) <= ends[: total - width + 1]


def in_groups(texts: list[bytes | None], words: int = 1 << 19) -> Iterator[tuple[int, list[list[bytes]]]]:
    """The split texts in groups of about ``words`` words, each with the place of its first text."""
    group, held, first = [], 0, 0
    for place, text in enumerate(texts):
        group.append(words_of(text))
        held += len(group[-1])
        if held >= words:
            yield first, group
            group, held, first = [], 0, place + 1
    if group:
        yield first, group


def total_bytes(df: DataFrame, text: str) -> int:
    return df.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).head()[0] or 0


def block_of(column: str, blocks: int) -> Column:
    """An even split of rows by a hash of their id; rows without an id share a block."""
    return F.pmod(F.xxhash64(F.col(f"`{column}`")), F.lit(blocks)).cast("int")
