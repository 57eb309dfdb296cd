"""Removal of passages that occur more than once in the corpus.

Every window of ``width`` words of every document gets a Rabin-Karp hash. The
hashes are counted in Spark, and each word under a window counted twice or more
goes. No window is left out and none is sampled.

How the count travels: documents are dealt to even blocks by a hash of their id.
A task sends each distinct hash of a block once, marked if the block holds it
twice, packed by hash range into one binary value per range. A range therefore
receives a passage at most once per block, whatever the number of documents that
share it. Ranges answer each block with the repeated hashes it holds, and blocks
meet these answers in a cogroup, which rests on the same exchange of documents
as the first pass. Windows of equal hash count as equal (63 bits).

Nulls and empty texts have no words and come back unchanged in number; a null id
is a block of its own. Repeated rows repeat each other's windows, so both lose
them. Extra columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import math
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duewatch.llm.text import (
    WordHashes, binary_texts, block_of, in_groups, total_bytes, window_hashes, windows_inside,
)

WIDTH = 35
BLOCK_BYTES = 8 << 20
RANGE_WINDOWS = 2 << 20
ONE = np.uint64(1)


def packed(values: np.ndarray) -> bytes:
    """Ascending 64-bit values as differences, byte plane by byte plane, so that the shuffle's compression works."""
    steps = np.diff(values, prepend=np.uint64(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def marked_distinct(hashes: np.ndarray) -> np.ndarray:
    """Distinct hashes in order; the lowest bit says whether a hash came twice or more."""
    values, counts = np.unique(hashes & ~ONE, return_counts=True)
    return values | (counts > 1).astype(np.uint64)


def hashes_by_range(ranges: int, width: int):
    def run(batches):
        table = WordHashes()
        for batch in batches:
            blocks, texts = batch.column("block").to_numpy(zero_copy_only=False), binary_texts(batch, "text")
            for block in np.unique(blocks):
                own = [texts[i] for i in np.flatnonzero(blocks == block)]
                found = []
                for _, group in in_groups(own):
                    words = table.of([w for doc in group for w in doc])
                    inside = windows_inside(np.array([len(doc) for doc in group]), width)
                    found.append(window_hashes(words, width)[inside])
                values = marked_distinct(np.concatenate(found)) if found else np.empty(0, np.uint64)
                if not len(values):
                    continue
                parts = range_of(values, ranges)
                cuts = np.flatnonzero(np.diff(parts)) + 1
                starts = np.concatenate([[0], cuts])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(parts[starts], pa.int32()),
                        pa.array(np.full(len(starts), block), pa.int32()),
                        pa.array([packed(part) for part in np.split(values, cuts)], pa.binary()),
                    ],
                    names=["part", "block", "hashes"],
                )

    return run


def range_of(values: np.ndarray, ranges: int) -> np.ndarray:
    """Ranges of equal width over the 64-bit values, taken from the upper 32 bits."""
    return (((values >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int32)


def repeated_by_block(table: pa.Table) -> pa.Table:
    """One hash range: to each block, its hashes that came twice or more in all."""
    pieces = [unpacked(data) for data in table.column("hashes").to_pylist()]
    blocks = np.repeat(table.column("block").to_numpy(), [len(p) for p in pieces])
    values = np.concatenate(pieces)
    plain = values & ~ONE
    order = np.argsort(plain, kind="stable")
    plain, blocks, twice = plain[order], blocks[order], (values[order] & ONE).astype(bool)
    starts = np.flatnonzero(np.concatenate([[True], plain[1:] != plain[:-1]]))
    sizes = np.diff(np.append(starts, len(plain)))
    again = np.repeat((sizes > 1) | np.maximum.reduceat(twice, starts), sizes)
    plain, blocks = plain[again], blocks[again]
    order = np.argsort(blocks, kind="stable")
    plain, blocks = plain[order], blocks[order]
    cuts = np.flatnonzero(np.diff(blocks)) + 1
    owners = blocks[np.concatenate([[0], cuts])] if len(blocks) else blocks
    return pa.table(
        {
            "block": pa.array(owners, pa.int32()),
            "hashes": pa.array([packed(p) for p in np.split(plain, cuts)] if len(blocks) else [], pa.binary()),
        }
    )


def covered(starts: np.ndarray, words: int, width: int) -> np.ndarray:
    """Whether each word lies under a window that starts where ``starts`` says."""
    edges = np.zeros(words + 1, np.int64)
    places = np.flatnonzero(starts)
    np.add.at(edges, places, 1)
    np.add.at(edges, places + width, -1)
    return np.cumsum(edges[:-1]) > 0


def cut_block(width: int, carried: list[str], schema: pa.Schema):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        table = WordHashes()
        known = [unpacked(data) for data in answers.column("hashes").to_pylist()]
        repeated = np.unique(np.concatenate(known)) if known else np.empty(0, np.uint64)
        counts, cut, texts, digests = [], [], [], []
        for _, group in in_groups(binary_texts(docs, "text")):
            lengths = np.array([len(doc) for doc in group])
            hashes = window_hashes(table.of([w for doc in group for w in doc]), width) & ~ONE
            hit = windows_inside(lengths, width)
            if len(repeated) and len(hashes):
                places = np.minimum(np.searchsorted(repeated, hashes), len(repeated) - 1)
                hit &= repeated[places] == hashes
            else:
                hit[:] = False
            gone = covered(hit, int(lengths.sum()), width)
            begin = 0
            for doc in group:
                own = gone[begin : begin + len(doc)]
                begin += len(doc)
                kept = b" ".join(compress(doc, ~own) if own.any() else doc)
                counts.append(len(doc))
                cut.append(int(own.sum()))
                texts.append(kept)
                digests.append(hashlib.sha256(kept).hexdigest())
        out = {name: docs.column(name) for name in carried}
        out |= {
            "n_words": pa.array(counts, pa.int64()),
            "n_removed": pa.array(cut, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
        }
        if "kept_text" in schema.names:
            out["kept_text"] = pa.array(texts, pa.binary()).cast(pa.string())
        return pa.table(out).select(schema.names).cast(schema)

    return run


def without_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = WIDTH,
    keep_text: bool = True,
    carry: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
    range_windows: int = RANGE_WINDOWS,
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_sha256 and, if asked for, kept_text.

    With ``carry``, these columns come along in a struct column ``row``. ``block_bytes`` and ``range_windows`` bound what
    one task holds; neither changes the result.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    size = total_bytes(docs, text_column)
    blocks = max(1, math.ceil(size / block_bytes))
    ranges = max(1, math.ceil(size / 6 / range_windows), min(blocks, 12))
    dealt = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"),
        *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []),
        block_of(id_column, blocks).alias("block"),
    ).repartition(blocks, "block")
    answers = (
        dealt.select("block", "text")
        .mapInArrow(hashes_by_range(ranges, width), "part int, block int, hashes binary")
        .groupBy("part")
        .applyInArrow(repeated_by_block, "block int, hashes binary")
    )
    carried = ["id", "row"] if carry else ["id"]
    fields = [*[dealt.schema[c] for c in carried], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
              T.StructField("kept_sha256", T.StringType())]
    schema = T.StructType(fields + [T.StructField("kept_text", T.StringType())] * keep_text)
    cut = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        cut_block(width, carried, to_arrow_schema(schema)), schema
    )
    return cut.withColumnRenamed("id", id_column)


def passages_cut(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents with their columns, the text being what is left of it."""
    carry = [c for c in docs.columns if c != text_column]
    cut = without_repeats(docs, id_column, text_column, carry=carry)
    return cut.select(
        *[F.col("kept_text").alias(c) if c == text_column else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    )
