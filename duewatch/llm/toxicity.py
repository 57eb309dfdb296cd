"""Toxicity of documents: the most insulting word under a string-kernel support vector machine.

Training reads sentences of labelled documents. A sentence carries the label of
its document, and the words of its sentences are the examples: a word counts for
the toxic side by the toxic documents that use it and for the clean side by the
clean documents, weighted so that ordinary words, equally common in both, end up
clean. Subsequence features with gaps make unseen spellings of an insult, with
other endings, missing or inserted characters, score like the ones seen.

A document's raw score is its highest word score, turned into a probability by a
logistic fit on the training documents, each weighted by the labelled documents it
stands for, so that probabilities mean the same at every size. Words are cut as [^\\x20\\x09-\\x0D]+,
lower-cased, and read without outer punctuation; a word with signs inside is also
read without them, and runs of single characters are also read as one word. All
words of a text are scored, long ones over overlapping pieces.

Labels are learned from at most ``MOST_PER_LABEL`` documents of either label, the
first in the order of a hash of their id. Null and empty texts score like texts
whose words are all clean. Labels that are null or whose document is missing are
not used; of several labels of one document the highest counts. Without examples
of both labels, every score is 0. Repeated rows are scored alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duewatch.llm import string_kernel
from duewatch.llm.text import words_of

MOST_PER_LABEL = 6_000
MOST_WORDS = 30_000
LANDMARKS = 256
CLEAN_WEIGHT = 3.0
RIDGE = 1e-5
INSERTED = "xen"  # letters put into known insults for training
INSERTED_WEIGHT = 3.0
THRESHOLD = 0.3
LOWEST = -1.5  # raw score of a text without words
CACHED_WORDS = 300_000
OUTER = ".,;:!?\"'()[]{}«»„“”’-_*#"
INNER = re.compile(r"[\W_]+")


def held_out_rows(id_column: str, parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(F.col(f"`{id_column}`").cast("string")) % parts == part, F.lit(False))


def toxic_units(text: bytes | None) -> set[str]:
    """The distinct strings of a text that are scored."""
    if not text:
        return set()
    words = words_of(text.decode("utf-8", "replace").lower().encode())
    units = set(words)
    singles: list[bytes] = []
    for word in [*words, b"end"] if any(len(w) == 1 for w in units) else []:
        if len(word) == 1:
            singles.append(word)
        else:
            if len(singles) > 2:
                units.add(b"".join(singles))
            singles = []
    return units


def readings(unit: bytes) -> list[str]:
    """A unit's plain form, and its form without inner signs if it has any, cut into pieces if long."""
    word = unit.decode("utf-8", "replace").strip(OUTER)
    forms = [word]
    if not word.isalnum() and (bare := INNER.sub("", word)) != word:
        forms.append(bare)
    size, step = string_kernel.PIECE, string_kernel.PIECE // 2
    return [
        form[i : i + size] for form in forms if form
        for i in (range(0, max(1, len(form) - step), step) if len(form) > size else (0,))
    ]


def misspelled(word: str) -> list[str]:
    """The word with one letter put in, at every inner place."""
    return [word[:i] + letter + word[i:] for i in range(1, len(word)) for letter in INSERTED]


class UnitScores:
    """Scores of units, remembered per task up to a bound."""

    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias, self.known = table, bias, {}

    def highest(self, texts: list[bytes | None]) -> list[float]:
        units = [toxic_units(text) for text in texts]
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        new = list(set().union(*units).difference(self.known))
        for start in range(0, len(new), 8192):
            self._learn(new[start : start + 8192])
        return [max(map(self.known.__getitem__, own), default=LOWEST) for own in units]

    def _learn(self, units: list[bytes]) -> None:
        forms, owners = [], []
        for place, unit in enumerate(units):
            for form in readings(unit):
                forms.append(form)
                owners.append(place)
        best = np.full(len(units), LOWEST)
        order = np.argsort([len(f) for f in forms], kind="stable") if forms else []
        for start in range(0, len(order), 2048):
            part = order[start : start + 2048]
            scores = string_kernel.table_scores([forms[i] for i in part], self.table) + self.bias
            np.maximum.at(best, np.array(owners)[part], scores)
        self.known.update(zip(units, best.tolist()))


def _slices(texts: list, size: int = 256):
    for start in range(0, len(texts), size):
        yield texts[start : start + size]


def _word_counts(batches):
    """Documents of either label per word, summed in each batch before the shuffle."""
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        counts = Counter(), Counter()
        for text, label in zip(texts, batch.column("toxic").to_pylist()):
            counts[label].update({form for unit in toxic_units(text) for form in readings(unit)})
        for label, counted in enumerate(counts):
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counted), pa.string()), pa.array([label] * len(counted), pa.int32()),
                 pa.array(list(counted.values()), pa.int64())],
                names=["word", "toxic", "n"],
            )


def _highest_of(table: np.ndarray, bias: float):
    def run(batches):
        scores = UnitScores(table, bias)
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            found = [s for part in _slices(texts) for s in scores.highest(part)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.float64())], names=["toxic", "raw"])

    return run


def _machine(odds: float):
    """Trains on the word counts of all batches. ``odds``: toxic documents per clean one."""

    def run(batches):
        rows = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if rows is None:
            return
        words = rows.column("word").to_pylist()
        toxic = rows.column("p").to_numpy().astype(float)
        clean = rows.column("q").to_numpy().astype(float) * CLEAN_WEIGHT * odds
        if not toxic.sum() or not clean.sum():
            return
        excess = np.argsort(clean / CLEAN_WEIGHT - toxic, kind="stable")[: LANDMARKS // 2]
        others = np.setdiff1d(np.argsort(-clean, kind="stable")[: LANDMARKS * 8], excess)[::16][: LANDMARKS // 2]
        landmarks = [words[i] for i in np.concatenate([excess, others])]
        sure = [i for i in excess if clean[i] == 0 and toxic[i] >= 3]
        spelled = [(v, toxic[i] * INSERTED_WEIGHT / len(vs)) for i in sure if (vs := misspelled(words[i])) for v in vs]
        words += [v for v, _ in spelled]
        toxic = np.concatenate([toxic, [n for _, n in spelled]])
        clean = np.concatenate([clean, np.zeros(len(spelled))])
        total = toxic.sum() + clean.sum()
        numbers, weights, bias = string_kernel.trained(words, toxic / total, clean / total, landmarks, RIDGE)
        yield pa.RecordBatch.from_arrays(
            [pa.array([numbers.astype(np.int64).tobytes()], pa.binary()),
             pa.array([weights.astype(np.float32).tobytes()], pa.binary()), pa.array([bias])],
            names=["numbers", "weights", "bias"],
        )

    return run


class ToxicityModel:
    """Weights, bias and the logistic link from raw scores to probabilities. A few hundred kilobytes, whatever the input."""

    def __init__(self, table: np.ndarray, bias: float, slope: float, offset: float):
        self.table, self.bias, self.slope, self.offset = table, bias, slope, offset

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.offset, -500, 500)))

    def score(self, text: Column) -> Column:
        model = self

        @F.arrow_udf("double")
        def scored(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            own = UnitScores(model.table, model.bias)
            for part in parts:
                texts = part.cast(pa.large_binary()).to_pylist()
                raw = [s for group in _slices(texts) for s in own.highest(group)]
                yield pa.array(model.probability(np.array(raw, float)), pa.float64())

        return scored(text.cast("string"))


def logistic(raw: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Newton steps with Platt's softened targets. ``weight``: the documents that a row stands for."""
    ones, zeros = (weight * label).sum(), (weight * (1 - label)).sum()
    target = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x, w = np.stack([raw, np.ones(len(raw))], 1), np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (weight * (p - target)))
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def train_toxicity(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
    most_per_label: int = MOST_PER_LABEL,
) -> ToxicityModel:
    """Fit on the labelled rows that are not held out (see ``held_out_rows``)."""
    ids = (
        labels.filter(F.col(f"`{label_column}`").isin(0, 1) & F.col(f"`{id_column}`").isNotNull())
        .filter(~held_out_rows(id_column, 4, 2))
        .groupBy(F.col(f"`{id_column}`").alias("id"))
        .agg(F.max(F.col(f"`{label_column}`")).cast("int").alias("toxic"))
    )
    chosen = [
        ids.filter(F.col("toxic") == label).orderBy(F.xxhash64("id"), "id").limit(most_per_label) for label in (0, 1)
    ]
    # At most 2 x most_per_label ids, so the broadcast is bounded.
    sample = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text")).join(
        F.broadcast(chosen[0].unionByName(chosen[1])), "id"
    )
    sizes = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    none = ToxicityModel(np.zeros(string_kernel.ALPHABET**string_kernel.TAKEN, np.float32), 0.0, 0.0, -500.0)
    if len(sizes) < 2:
        return none
    counted = (
        sample.select("text", "toxic").mapInArrow(_word_counts, "word string, toxic int, n long")
        .groupBy("word").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("p"),
                             F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("q"))
        .orderBy((F.col("p") + F.col("q")).desc(), F.xxhash64("word")).limit(MOST_WORDS)
    )
    # At most MOST_WORDS rows: the machine is trained in one task, and only its weights come back.
    fitted = counted.mapInArrow(_machine(sizes[1] / sizes[0]), "numbers binary, weights binary, bias double").head()
    if not fitted:
        return none
    table = none.table
    table[np.frombuffer(fitted["numbers"], np.int64)] = np.frombuffer(fitted["weights"], np.float32)
    bias = fitted["bias"]
    raw = sample.select("text", "toxic").mapInArrow(_highest_of(table, bias), "toxic int, raw double").toPandas()
    # The sample has another share of toxic documents than the labels where a label is cut.
    stands_for = {row["toxic"]: max(1.0, row["count"] / most_per_label) for row in ids.groupBy("toxic").count().collect()}
    slope, offset = logistic(raw["raw"].to_numpy(), raw["toxic"].to_numpy(float), raw["toxic"].map(stands_for).to_numpy(float))
    return ToxicityModel(table, bias, slope, offset)


def toxicity_report(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, held_out, score and predicted."""
    model = train_toxicity(docs, labels, id_column, text_column)
    scored = docs.select(
        F.col(f"`{id_column}`").alias(id_column), held_out_rows(id_column, 4, 2).alias("held_out"),
        model.score(F.col(f"`{text_column}`")).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def clean_documents(docs: DataFrame, labels: DataFrame, text_column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The documents that are not predicted toxic, with their columns."""
    model = train_toxicity(docs, labels, id_column, text_column)
    names = [F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    scored = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), model.score(F.col(f"`{text_column}`")).alias("score")
    )
    return scored.filter(F.col("score") < THRESHOLD).select(*names)
