"""Expected grades of documents from a cumulative-link regression on graded ratings.

P(grade >= k | text) = 1 / (1 + exp(threshold_k - w . x)), with one weight vector
for all grades and thresholds in increasing order. x holds the logarithmic counts
of a text's words, hashed to DIMENSIONS places with a sign and scaled to unit
length, and six ratios of its characters and words. The expected grade is the sum
of the tail probabilities, and a tail probability selects documents.

Training uses at most MOST_RATED rated rows that are not held out, the first in
the order of a hash of their id, in one task; the model that comes back has
DIMENSIONS weights. All documents are scored, by whole text.

Null and empty texts have no words: x is zero but for its constant ratios. Null
grades and ids are not learned from; of several ratings of a document the highest
counts. With fewer than two grades every tail probability is one. Repeated rows
are scored alike. Extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duewatch.llm.text import words_of
from duewatch.llm.word_statistics import statistics

DIMENSIONS = 1 << 14
RATIOS = 6
MOST_RATED = 12_000
RIDGE = 1e-4
STEPS = 60
KEEP = 0.5
CACHED_WORDS = 300_000


class HashedText:
    """Places and values of a text's features; the places of words are remembered per task up to a bound."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def place(self, word: bytes) -> int:
        found = self.known.get(word)
        if found is None:
            found = self.known[word] = xxhash.xxh32_intdigest(word)
        return found

    def of(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        counts = Counter(words_of(text.lower() if text else None))
        hashed = np.fromiter(map(self.place, counts), np.int64, len(counts))
        values = np.log1p(np.fromiter(counts.values(), float, len(counts)))
        sums = np.bincount(hashed % DIMENSIONS, weights=np.where(hashed >> 31, values, -values), minlength=1)
        places = np.flatnonzero(sums)
        values = sums[places]
        norm = np.sqrt(values @ values) or 1.0
        return (
            np.concatenate([places, np.arange(DIMENSIONS, DIMENSIONS + RATIOS)]),
            np.concatenate([values / norm, ratios(text, len(counts))]),
        )


def ratios(text: bytes | None, distinct: int) -> np.ndarray:
    words, chars, symbols, lines, repeated = statistics(text)
    each = max(words, 1)
    return np.array([
        1.0, np.log1p(words) / 10, np.log1p(symbols / each), repeated / each, chars / each / 10, distinct / each,
    ])


class CumulativeLink:
    """Weights and increasing thresholds; ``grades`` are the rating values, least first."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray, grades: list[int]):
        self.weights, self.thresholds, self.grades = weights, thresholds, grades

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for each grade but the least (rows x grades - 1)."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None] - scores[:, None], -500, 500)))

    def judged(self, text: Column) -> Column:
        """struct(expected, tails) of a text column."""
        model = self

        @F.arrow_udf("struct<expected:double,tails:array<double>>")
        def judge(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            features = HashedText()
            steps = np.diff(np.array(model.grades or [0], float))
            for part in parts:
                scores = np.array([
                    float(model.weights[places] @ values)
                    for places, values in map(features.of, part.cast(pa.large_binary()).to_pylist())
                ])
                tails = model.tails(scores)
                expected = (model.grades[0] if model.grades else 0) + tails @ steps
                yield pa.StructArray.from_arrays(
                    [pa.array(expected, pa.float64()), pa.array(list(tails), pa.list_(pa.float64()))], names=["expected", "tails"]
                )

        return judge(text.cast("string"))


def _fit(batches):
    features, rows, values, places, grades = HashedText(), [], [], [], []
    for batch in batches:
        for text, grade in zip(batch.column("text").cast(pa.large_binary()).to_pylist(), batch.column("grade").to_pylist()):
            where, what = features.of(text)
            rows.append(np.full(len(where), len(grades), np.int32))
            places.append(where.astype(np.int32))
            values.append(what.astype(np.float32))
            grades.append(grade)
    names = sorted(set(grades))
    if len(names) < 2:
        return
    weights, thresholds = cumulative_link(
        np.concatenate(rows), np.concatenate(places), np.concatenate(values),
        np.searchsorted(names, grades), len(names), DIMENSIONS + RATIOS,
    )
    yield pa.RecordBatch.from_arrays(
        [pa.array([weights.tobytes()], pa.binary()), pa.array([thresholds.tobytes()], pa.binary()),
         pa.array([names], pa.list_(pa.int32()))],
        names=["weights", "thresholds", "grades"],
    )


def cumulative_link(rows, places, values, levels, grades: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximum penalised likelihood by gradient steps with per-parameter rates.

    Thresholds are the first one and the logarithms of the gaps, so they stay in order.
    """
    count = len(levels)
    share = np.clip([np.mean(levels >= k) for k in range(1, grades)], 1e-3, 1 - 1e-3)
    start = -np.log(share / (1 - share))
    weights = np.zeros(size)
    cuts = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    squares, cut_squares = np.full(size, 1e-8), np.full(len(cuts), 1e-8)
    index = np.arange(count)
    for step in range(STEPS):
        thresholds = np.concatenate([cuts[:1], cuts[0] + np.cumsum(np.exp(cuts[1:]))])
        scores = np.bincount(rows, weights=values * weights[places], minlength=count)
        above = 1 / (1 + np.exp(np.clip(thresholds[None] - scores[:, None], -30, 30)))
        above = np.column_stack([np.ones(count), above, np.zeros(count)])
        lower, upper = above[index, levels], above[index, levels + 1]
        chance = np.maximum(lower - upper, 1e-9)
        slope_lower, slope_upper = lower * (1 - lower) / chance, upper * (1 - upper) / chance
        by_score = -(slope_lower - slope_upper) / count
        gradient = np.bincount(places, weights=values * by_score[rows], minlength=size) + RIDGE * weights / np.sqrt(count)
        by_cut = np.zeros(grades + 1)
        np.add.at(by_cut, levels, slope_lower / count)
        np.add.at(by_cut, levels + 1, -slope_upper / count)
        by_cut = by_cut[1:grades]
        onto = np.concatenate([[by_cut.sum()], np.exp(cuts[1:]) * np.cumsum(by_cut[::-1])[::-1][1:]])
        squares += gradient**2
        cut_squares += onto**2
        weights -= 0.5 * gradient / np.sqrt(squares)
        cuts -= 0.2 * onto / np.sqrt(cut_squares)
    return weights, np.concatenate([cuts[:1], cuts[0] + np.cumsum(np.exp(cuts[1:]))])


def train_grades(
    docs: DataFrame, ratings: DataFrame, id_column: str = "doc_id", text_column: str = "text", grade_column: str = "grade",
    held_out: Column | None = None, most_rated: int = MOST_RATED,
) -> CumulativeLink:
    """Fit on at most ``most_rated`` rows of ``ratings`` (id, grade as a small integer) that are not ``held_out``."""
    rated = ratings.filter(F.col(f"`{grade_column}`").isNotNull() & F.col(f"`{id_column}`").isNotNull())
    if held_out is not None:
        rated = rated.filter(~held_out)
    chosen = (
        rated.groupBy(F.col(f"`{id_column}`").alias("id")).agg(F.max(F.col(f"`{grade_column}`")).cast("int").alias("grade"))
        .orderBy(F.xxhash64("id"), "id").limit(most_rated)
    )
    # The ids are bounded by most_rated, so the broadcast is.
    sample = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text")).join(
        F.broadcast(chosen), "id"
    )
    fitted = sample.select("text", "grade").repartition(1).mapInArrow(
        _fit, "weights binary, thresholds binary, grades array<int>"
    ).head()
    if fitted is None:
        return CumulativeLink(np.zeros(DIMENSIONS + RATIOS), np.full(1, -500.0), [0, 1])
    return CumulativeLink(np.frombuffer(fitted["weights"]), np.frombuffer(fitted["thresholds"]), list(fitted["grades"]))


def grade_report(
    docs: DataFrame, model: CumulativeLink, id_column: str = "doc_id", text_column: str = "text", keep: float = KEEP
) -> DataFrame:
    """One row per document: id, expected_grade, tail_probabilities (of each grade but the least) and kept, which asks for
    the least but one grade with probability ``keep``."""
    judged = docs.select(F.col(f"`{id_column}`").alias(id_column), model.judged(F.col(f"`{text_column}`")).alias("judged"))
    return judged.select(
        id_column, F.col("judged.expected").alias("expected_grade"), F.col("judged.tails").alias("tail_probabilities"),
        (F.col("judged.tails")[0] >= keep).alias("kept"),
    )
