"""Documents drawn so that their word runs are distributed like those of a target table (importance resampling).

Features are all runs of one to three words, hashed to buckets. Each bucket has a gain, the logarithm of its share in the
target over its share in the documents; a document weighs the sum of its features' gains, looked up in an array with one
entry a bucket. A Gumbel draw from the document's id is added, and the highest scores are drawn without replacement.

How the cutoff is found: scores are written once, and their range is bisected by exact counts, first over the score, then,
among rows that tie there, over the id. One job counts several midpoints, as many as some bisections in a row would ask
for. The drawn rows alone are range-partitioned; a row's rank is its number in its slice and the sizes of the slices
before. No row is sampled, and none meets the others in one task: ties in both score and id are dealt by their row.

Null and empty texts have no features, weigh 0 and are never drawn (they have under ``least_words`` words). A null id draws
as the text ``null`` and sorts before all others. Repeated ids draw the same number; rows that tie on score and id are ranked
in the order in which they stand. Very long texts are one row and are hashed in groups of words. Empty tables give
an empty result; an empty target gives gains by the smoothing alone. Extra columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duewatch.llm.scratch import Scratch
from duewatch.llm.text import binary_texts

BUCKETS = 10_000
RUN_WORDS = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
LEVELS = 4  # bisections by one counting job
SLICE_ROWS = 200_000
GROUP_WORDS = 1 << 18
CACHED_WORDS = 400_000  # a worker's table is emptied beyond this; it is only a cache
LONGEST = 63  # words from this many bytes on are hashed with their runs one by one

# Every ASCII character that is neither letter nor digit ends a word; A-Z become a-z.
WORD_BYTES = bytes(
    b + 32 if ord("A") <= b <= ord("Z") else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def _shift_tables(longest: int) -> np.ndarray:
    """What a crc32 becomes when so many more bytes follow it: one table of 256 entries per length and byte of the crc.

    crc32(a + b) is this shift of crc32(a) by the length of b, xor crc32(b).
    """
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    tables = np.empty((longest + 1, 4, 256), np.uint32)
    tables[0] = [np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)]
    for length in range(longest):
        tables[length + 1] = step[tables[length] & 255] ^ (tables[length] >> np.uint32(8))
    return tables


class RunHashes:
    """crc32 of all runs of consecutive words, joined by one space, of texts laid end to end."""

    def __init__(self):
        self.tables = _shift_tables(LONGEST)
        self.words: dict[bytes, int] = {}  # crc32 and, in the upper bits, the length

    def shifted(self, crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = self.tables[lengths, 0, crcs & 255]
        for k in range(1, 4):
            out = out ^ self.tables[lengths, k, (crcs >> np.uint32(8 * k)) & 255]
        return out

    def of(self, words: list[bytes], owners: np.ndarray, longest_run: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(hashes, owners) of the runs of 1, 2, ... words, none of which leaves its owner's text."""
        known = self.words
        if len(known) > CACHED_WORDS:
            known.clear()
        for word in set(words) - known.keys():
            known[word] = zlib.crc32(word) | len(word) << 32
        packed = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        single, lengths = (packed & 0xFFFFFFFF).astype(np.uint32), packed >> 32
        long = lengths >= LONGEST
        shift = np.where(long, 0, lengths)
        space = np.full(len(words), zlib.crc32(b" "), np.uint32)
        behind = self.shifted(space, shift) ^ single  # crc32 of a space and the word
        found, run = [(single, owners)], single
        for size in range(2, longest_run + 1):
            last = size - 1
            run = self.shifted(run[:-1], shift[last:] + 1) ^ behind[last:]
            if long.any():
                for at in np.flatnonzero(np.convolve(long, np.ones(size, int))[last : len(words)]):
                    run[at] = zlib.crc32(b" ".join(words[at : at + size]))
            inside = owners[last:] == owners[: len(owners) - last]
            found.append((run[inside], owners[last:][inside]))
        return found


def _grouped(texts: list[bytes | None]):
    """(place of the first text, words, owner of each word, words of each text) of groups of texts; a very long text is a
    group of its own."""
    first, words, counts = 0, [], []
    for place, text in enumerate(texts):
        own = text.translate(WORD_BYTES).split() if text else []
        words += own
        counts.append(len(own))
        if len(words) >= GROUP_WORDS or place == len(texts) - 1:
            yield first, words, np.repeat(np.arange(len(counts)), counts), np.array(counts)
            first, words, counts = place + 1, [], []


def _counted(buckets: int, longest_run: int):
    def run(batches):
        hashes, counts = RunHashes(), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, words, owners, _ in _grouped(binary_texts(batch, "text")):
                for found, _ in hashes.of(words, owners, longest_run):
                    counts += np.bincount(found % np.uint32(buckets), minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(held, pa.int64()), "n": pa.array(counts[held], pa.int64())})

    return run


def _weighed(gains: np.ndarray, longest_run: int):
    def run(batches):
        hashes = RunHashes()
        for batch in batches:
            features, weights, sizes = [], [], []
            for _, words, owners, counts in _grouped(binary_texts(batch, "text")):
                n, weight = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
                for found, of in hashes.of(words, owners, longest_run):
                    n += np.bincount(of, minlength=len(counts))
                    np.add.at(weight, of, gains[found % np.uint32(len(gains))])
                features.append(n)
                weights.append(weight)
                sizes.append(counts)
            columns = zip(("n_words", "n_features", "weight"), (sizes, features, weights))
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("id")}
                | {name: pa.array(np.concatenate(x) if x else [], pa.int64()) for name, x in columns}
            )

    return run


def _texts(docs: DataFrame, text_column: str, *others: Column) -> DataFrame:
    return docs.select(*others, F.col(f"`{text_column}`").cast("string").alias("text"))


def bucket_counts(docs: DataFrame, text_column: str = "text", buckets: int = BUCKETS, run_words: int = RUN_WORDS) -> DataFrame:
    """(bucket, n) of the features of all texts; each task sends one row per bucket at most."""
    found = _texts(docs, text_column).mapInArrow(_counted(buckets, run_words), "bucket long, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the documents; one number a bucket."""
    both = docs.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).union(
        target.select("bucket", F.lit(0).cast("long"), "n")
    )
    rows = both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect()  # ``buckets`` rows at most
    source, wanted = np.zeros(buckets), np.zeros(buckets)
    for row in rows:
        source[row["bucket"]], wanted[row["bucket"]] = row["s"], row["t"]
    share = (wanted + 1) * (source.sum() + buckets) / ((source + 1) * (wanted.sum() + buckets))
    return np.floor(1000 * np.log(share)).astype(np.int64)


def gumbel(id_column: str, seed: int) -> Column:
    """floor(-1000 ln(-ln u)), u from the first 32 bits of a hash of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def _cutoff(rows: DataFrame, column: str, wanted: int, descending: bool, levels: int) -> tuple[int, int]:
    """The best value for which at least ``wanted`` rows are as good or better, and how many rows are better than it.

    Bisection of the column's range by exact counts; a job counts the midpoints that ``levels`` bisections would ask for.
    """
    best = (lambda v: F.col(column) >= F.lit(v)) if descending else (lambda v: F.col(column) <= F.lit(v))
    low, high = rows.agg(F.min(column), F.max(column)).head()
    sign = 1 if descending else -1
    # In units of sign * value: enough rows reach ``enough``, too few reach ``few``.
    enough, few = (low, high + 1) if descending else (-high, -low + 1)
    better = 0
    while few - enough > 1:
        span = few - enough
        points = sorted({enough + span * k // (1 << levels) for k in range(1, 1 << levels)} - {enough})
        counts = rows.agg(*[F.count(F.when(best(sign * p), 1)).alias(f"c{n}") for n, p in enumerate(points)]).head()
        for point, count in zip(points, counts):
            if count >= wanted:
                enough = point
            else:
                few, better = point, count
                break
    return sign * enough, better


def _ranked(rows: DataFrame, count: int, scratch: Scratch, slice_rows: int) -> DataFrame:
    """``rows`` with ``rank``, by falling score, then rising id, then row."""
    slices = max(1, -(-count // slice_rows))
    order = [F.desc("score"), F.asc_nulls_first("id"), F.asc("row")]
    sliced = scratch.put(
        rows.repartitionByRange(slices, *order).withColumn("slice", F.spark_partition_id()), "drawn-slices"
    )
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # one row a slice
    offsets = sliced.groupBy("slice").count().withColumn("earlier", F.coalesce(F.sum("count").over(before), F.lit(0)))
    numbered = sliced.withColumn("place", F.row_number().over(Window.partitionBy("slice").orderBy(*order)))
    return numbered.join(offsets, "slice").withColumn("rank", F.col("place") + F.col("earlier"))


def importance_resample(
    docs: DataFrame, target: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    target_column: str = "text", buckets: int = BUCKETS, run_words: int = RUN_WORDS, least_words: int = LEAST_WORDS,
    percent: int = PERCENT, seed: int = SEED, levels: int = LEVELS, slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One row per document: id (a whole number), n_features, weight, score, rank (1, 2, 3, ... of the drawn, else null).

    Of the documents with ``least_words`` words, ``percent`` of a hundred are drawn, rounded down. ``levels`` and
    ``slice_rows`` bound a job's counts and a task's rows; neither changes the result.
    """
    scratch = Scratch(docs.sparkSession)
    gains = bucket_gains(
        bucket_counts(docs, text_column, buckets, run_words), bucket_counts(target, target_column, buckets, run_words), buckets
    )
    source = _texts(docs, text_column, F.col(f"`{id_column}`").cast("long").alias("id"))
    scored = source.mapInArrow(_weighed(gains, run_words), "id long, n_words long, n_features long, weight long")
    scores = scratch.put(
        scored.withColumn("score", F.col("weight") + gumbel("id", seed)).withColumn("row", F.monotonically_increasing_id()),
        "scores",
    )
    able = scores.filter(F.col("n_words") >= least_words)
    wanted = percent * able.count() // 100
    columns = ["id", "n_features", "weight", "score", "rank"]
    undrawn = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return scores.select("*", undrawn).select(*columns).withColumnRenamed("id", id_column)
    score, above = _cutoff(able, "score", wanted, True, levels)
    # Ids among the rows that tie at the cutoff; a null id comes first.
    tied = able.filter(F.col("score") == score)
    nulls = tied.filter("id is null").count()
    reached = (F.col("score") > score) | (F.col("score") == score) & F.col("id").isNull()
    if wanted > above + nulls:
        last, _ = _cutoff(tied.filter("id is not null"), "id", wanted - above - nulls, False, levels)
        reached |= (F.col("score") == score) & (F.col("id") <= last)
    reached = (F.col("n_words") >= least_words) & F.coalesce(reached, F.lit(False))
    ranked = _ranked(scores.filter(reached), wanted, scratch, slice_rows)
    # Rows that tie on score and id at the cutoff may be more than are wanted.
    drawn = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")).cast("long"))
    return (
        drawn.select(*columns).unionByName(scores.filter(~reached).select("*", undrawn).select(*columns))
        .withColumnRenamed("id", id_column)
    )
