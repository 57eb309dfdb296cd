"""Regularised second-order boosted trees, grown by Spark aggregations.

Each tree takes one aggregation per level: every row adds its gradient and hessian to the cell (model, node, feature, bin),
Spark sums the cells, and running sums over the bins give the gain of each split,

    T(GL)^2 / (HL + l2) + T(GR)^2 / (HR + l2) - T(G)^2 / (H + l2),    T(G) = sign(G) max(|G| - l1, 0),

of which a split needs ``gamma`` at least. Categories are ordered by G / (H + l2) and split into two sets. A leaf is worth
-T(G) / (H + l2) times the learning rate. Columns are drawn per tree, rows per tree by a hash of their number.

Several models, such as the folds of several trials, grow in the same jobs: one pass over the rows serves all of them.
Rows hold their features as bin numbers; margins are written anew after some trees, and the trees since then are applied
on the way. The driver sees one row per model, open node and feature, and the trees.

Gradients are rounded to multiples of 2^-24 before they are summed, so that sums, and with them the trees, do not depend
on how rows are dealt to tasks (to half a billion rows; beyond that to the last bits of a double).

Bins: a numeric feature is cut at its quantiles, at all of its values if there are fewer; a category is a bin, the
``bins`` most frequent ones by themselves and all others, unseen ones and nulls among them, together. At scoring, null and
unreadable numbers go right, as do numbers beyond all cuts.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duewatch.session import fresh_path, removed

BINS = 256
KEPT_TREES = 10  # margins are written again once a model has so many new trees
CHUNK_ROWS = 1 << 16
LEAST_GROUPS, MOST_GROUPS = 256, 2048  # groups of cells a task of the split search is worth, and as many as it gets at most
UNIT = float(1 << 24)
DEFAULTS = {
    "learning_rate": 0.3, "max_depth": 6, "gamma": 0.0, "subsample": 1.0, "colsample_bytree": 1.0, "reg_alpha": 0.0,
    "reg_lambda": 1.0, "min_child_weight": 1.0,
}


@dataclass(frozen=True)
class Binning:
    """How features become bin numbers: ascending cuts of a numeric feature, bins by category of another one."""

    features: list[str]
    cuts: list[list[float] | None]
    categories: list[dict[str, int] | None]

    @property
    def width(self) -> int:
        """One more than the largest bin number."""
        return 1 + max([len(c if c is not None else k) for c, k in zip(self.cuts, self.categories)], default=0)

    def columns(self) -> list[Column]:
        """Numbers as doubles and categories as text, in order."""
        return [
            F.col(f"`{name}`").try_cast("double") if cuts is not None else F.col(f"`{name}`").cast("string")
            for name, cuts in zip(self.features, self.cuts)
        ]

    def numbered(self, columns: Sequence[pa.Array]) -> np.ndarray:
        """(rows, features) bin numbers."""
        out = np.empty((len(columns[0]) if columns else 0, len(columns)), np.int16)
        for place, (values, cuts, known) in enumerate(zip(columns, self.cuts, self.categories)):
            if cuts is not None:
                numbers = values.cast(pa.float64()).fill_null(math.nan).to_numpy(zero_copy_only=False)
                out[:, place] = np.searchsorted(np.asarray(cuts, float), numbers, "left")  # NaN is beyond all cuts
            else:
                coded = values.dictionary_encode()
                codes = np.array([known.get(v, len(known)) for v in coded.dictionary.to_pylist()] + [len(known)], np.int16)
                out[:, place] = codes[coded.indices.fill_null(len(codes) - 1).to_numpy(zero_copy_only=False)]
        return out


def learn_bins(rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], bins: int = BINS) -> Binning:
    """Cuts of all numeric features from one aggregation, and the most frequent categories from another."""
    cuts: list = []
    if numeric:
        shares = F.array(*[F.lit(n / bins) for n in range(1, bins + 1)])
        quantiles = [
            F.percentile_approx(F.col(f"`{name}`").try_cast("double"), shares, F.lit(100 * bins)).alias(f"c{place}")
            for place, name in enumerate(numeric)
        ]
        cuts = [sorted({v for v in found or [] if not math.isnan(v)}) for found in rows.agg(*quantiles).head()]
    known: list[dict[str, int]] = [{} for _ in categorical]
    if categorical:
        listed = [
            F.struct(F.lit(place).alias("place"), F.col(f"`{name}`").cast("string").alias("value"))
            for place, name in enumerate(categorical)
        ]
        counts = rows.select(F.inline(F.array(*listed))).where("value is not null").groupBy("place", "value").count()
        order = Window.partitionBy("place").orderBy(F.desc("count"), "value")
        frequent = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= bins)
        for row in frequent.orderBy("place", "rank").collect():  # ``bins`` rows per feature at most
            known[row["place"]][row["value"]] = len(known[row["place"]])
    return Binning(
        [*numeric, *categorical], [*cuts, *[None] * len(categorical)], [*[None] * len(numeric), *known]
    )


@dataclass
class Tree:
    """Nodes as parallel lists. ``feature`` is -1 at a leaf; ``left_bins`` has the bins that go left, as the last of them
    for a numeric feature and as a list for categories. ``cover`` is the sum of hessians of the rows that came by."""

    feature: list[int] = field(default_factory=list)
    left_bins: list = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, value: float, cover: float) -> int:
        for column, item in (
            (self.feature, -1), (self.left_bins, 0), (self.left, 0), (self.right, 0), (self.value, value), (self.cover, cover),
            (self.gain, 0.0),
        ):
            column.append(item)
        return len(self.feature) - 1

    def places(self, bins: np.ndarray) -> np.ndarray:
        """The node in which each row ends."""
        feature, left, right = (np.asarray(x, np.int64) for x in (self.feature, self.left, self.right))
        upto = np.array([b if isinstance(b, int) else -1 for b in self.left_bins], np.int64)
        sets = [n for n, b in enumerate(self.left_bins) if not isinstance(b, int)]
        width = int(bins.max(initial=0)) + 1
        members = np.zeros((len(sets) + 1, width), bool)
        member_of = np.full(len(feature), len(sets))
        for place, node in enumerate(sets):
            members[place, [b for b in self.left_bins[node] if b < width]] = True
            member_of[node] = place
        at = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        while len(rows):
            rows = rows[feature[at[rows]] >= 0]
            node = at[rows]
            own = bins[rows, feature[node]]
            at[rows] = np.where((own <= upto[node]) | members[member_of[node], own], left[node], right[node])
        return at

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return np.asarray(self.value)[self.places(bins)]


@dataclass
class BoostedTrees:
    """A fitted model. ``base`` is the margin without any tree."""

    binning: Binning
    base: float
    trees: list[Tree]
    columns: list[int]

    @property
    def features(self) -> list[str]:
        return [self.binning.features[c] for c in self.columns]

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return self.base + sum((tree.margins(bins) for tree in self.trees), np.zeros(len(bins)))

    def gains(self) -> dict[str, float]:
        """Total gain of each feature's splits."""
        found = dict.fromkeys(self.features, 0.0)
        for tree in self.trees:
            for feature, gain in zip(tree.feature, tree.gain):
                if feature >= 0:
                    found[self.binning.features[feature]] += gain
        return found

    def save(self, spark: SparkSession, path: str) -> None:
        record = {
            "binning": vars(self.binning), "base": self.base, "trees": [vars(t) for t in self.trees], "columns": self.columns,
        }
        spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        record = json.loads(spark.read.text(path).head()["value"])
        return cls(
            Binning(**record["binning"]), record["base"], [Tree(**t) for t in record["trees"]], record["columns"]
        )


def probabilities(model: BoostedTrees) -> Column:
    """The probability of label 1 for a row with the model's features as columns."""
    needed = sorted({f for tree in model.trees for f in tree.feature if f >= 0} | set(model.columns[:1]))
    columns = model.binning.columns()

    def run(*values):
        arrays = {place: pa.Array.from_pandas(v) for place, v in zip(needed, values)}
        rows = len(values[0])
        filled = [arrays.get(place, pa.nulls(rows, pa.float64() if cuts is not None else pa.string()))
                  for place, cuts in enumerate(model.binning.cuts)]
        import pandas as pd

        return pd.Series(1 / (1 + np.exp(-model.margins(model.binning.numbered(filled)))))

    return F.pandas_udf(run, "double")(*[columns[place] for place in needed])


@dataclass
class Fit:
    """One model to grow: its parameters, the features it may use (all, if None) and the fold it leaves out (none, if None)."""

    parameters: dict
    columns: list[int] | None = None
    held_out: int | None = None
    seed: int = 42

    def value(self, name: str) -> float:
        return self.parameters.get(name, DEFAULTS[name])


def uniform(numbers: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) for each row number, by a mixing hash."""
    with np.errstate(over="ignore"):
        z = numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0xD1342543DE82EF95 % 2**64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
        z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)) * 2.0**-53


class _Growing:
    """A model on its way: the finished trees, the current one and its open nodes."""

    def __init__(self, fit: Fit, base: float, features: int, trees: int):
        self.fit, self.base, self.wanted = fit, base, trees
        self.columns = list(range(features)) if fit.columns is None else list(fit.columns)
        self.trees: list[Tree] = []
        self.written = 0  # trees whose values the written margins hold
        self.begin()

    def begin(self) -> None:
        self.tree, self.open, self.depth = None, [0], 0
        drawn = max(1, int(self.fit.value("colsample_bytree") * len(self.columns)))
        source = random.Random(f"{self.fit.seed}/{len(self.trees)}")
        self.drawn = sorted(source.sample(self.columns, drawn))

    @property
    def done(self) -> bool:
        return len(self.trees) >= self.wanted

    def weight(self, g: float, h: float) -> float:
        shrunk = math.copysign(max(abs(g) - self.fit.value("reg_alpha"), 0.0), g)
        down = h + self.fit.value("reg_lambda")
        return -self.fit.value("learning_rate") * shrunk / down if down > 0 else 0.0

    def grow(self, splits: dict[int, list]) -> None:
        """Split the open nodes by the best of their rows (one row per feature), and open what they lead to."""
        if self.tree is None:
            self.tree = Tree()
            first = splits[0][0] if splits.get(0) else None
            self.tree.add(self.weight(first["g"], first["h"]) if first else 0.0, first["h"] if first else 0.0)
        tree, following = self.tree, []
        for node in self.open:
            good = [s for s in splits.get(node, []) if s["gain"] is not None and s["gain"] > 0 and s["gain"] >= self.fit.value("gamma")]
            if not good:
                continue
            best = min(good, key=lambda s: (-s["gain"], s["feature"]))
            tree.feature[node], tree.gain[node] = best["feature"], best["gain"]
            side = best["best"]
            tree.left_bins[node] = side["bin"] if side["members"] is None else sorted(side["members"])
            right = best["g"] - side["gl"], best["h"] - side["hl"]
            tree.left[node] = tree.add(self.weight(side["gl"], side["hl"]), side["hl"])
            tree.right[node] = tree.add(self.weight(*right), right[1])
            following += [tree.left[node], tree.right[node]]
        self.open, self.depth = following, self.depth + 1
        if not following or self.depth >= int(self.fit.value("max_depth")):
            self.trees.append(tree)
            self.begin()


def _numbers(column, kind) -> np.ndarray:
    """The numbers in a binary column without nulls, whose values lie one behind the other in its buffer."""
    _, places, data = column.buffers()
    if not len(column) or data is None:
        return np.empty(0, kind)
    ends = np.frombuffer(places, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(memoryview(data)[ends[0] : ends[-1]], kind)


def _decoded(batch, features: int, models: int) -> tuple:
    size = batch.num_rows

    return (
        batch.column("number").to_numpy(zero_copy_only=False), batch.column("label").to_numpy(zero_copy_only=False),
        batch.column("fold").to_numpy(zero_copy_only=False), _numbers(batch.column("bins"), np.int16).reshape(size, features),
        _numbers(batch.column("margins"), np.float64).reshape(size, models),
    )


def _chunks(batches, features: int, models: int):
    """Decoded batches put together, so that few partial sums leave a task."""
    waiting, rows = [], 0
    for batch in batches:
        waiting.append(_decoded(batch, features, models))
        rows += batch.num_rows
        if rows >= CHUNK_ROWS:
            yield [np.concatenate(parts) for parts in zip(*waiting)]
            waiting, rows = [], 0
    if waiting:
        yield [np.concatenate(parts) for parts in zip(*waiting)]


def _cells(growing: list[tuple], features: int, models: int, width: int):
    """Sums of gradients and hessians by (model, node, feature, bin), of the open nodes' rows."""

    def run(batches):
        for numbers, labels, folds, bins, margins in _chunks(batches, features, models):
            for model, fit, fresh, tree, open_nodes, drawn, place in growing:
                kept = np.ones(len(labels), bool) if fit.held_out is None else folds != fit.held_out
                rate = fit.value("subsample")
                if rate < 1:
                    kept &= uniform(numbers, hash((fit.seed, place))) < rate
                at = np.zeros(len(labels), np.int64) if tree is None else tree.places(bins)
                order = np.full(max(open_nodes) + 1, -1)
                order[open_nodes] = np.arange(len(open_nodes))
                nodes = np.where(at < len(order), order[np.minimum(at, len(order) - 1)], -1)
                rows = np.flatnonzero(kept & (nodes >= 0))
                if not len(rows):
                    continue
                own, nodes = bins[rows], nodes[rows] * width
                margin = margins[rows, model] + sum((t.margins(own) for t in fresh), np.zeros(len(rows)))
                p = 1 / (1 + np.exp(-margin))
                g, h = np.rint((p - labels[rows]) * UNIT), np.rint(p * (1 - p) * UNIT)
                found = []
                for feature in drawn:
                    keys = nodes + own[:, feature]
                    counts = np.bincount(keys, minlength=len(open_nodes) * width)
                    cells = np.flatnonzero(counts)
                    found.append((
                        np.full(len(cells), feature), cells, np.bincount(keys, g, len(counts))[cells],
                        np.bincount(keys, h, len(counts))[cells],
                    ))
                of, cells, g, h = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_pydict({
                    "model": pa.array(np.full(len(of), model), pa.int32()),
                    "node": pa.array(np.asarray(open_nodes)[cells // width], pa.int32()),
                    "feature": pa.array(of, pa.int32()),
                    "bin": pa.array(cells % width, pa.int32()),
                    "g": pa.array(g, pa.float64()),
                    "h": pa.array(h, pa.float64()),
                })

    return run


def _parts(groups: int, cores: int) -> int:
    """Tasks for the split search of (model, node, feature) groups, far fewer than Spark's default while there are
    few groups: each task of a level writes a file per partition."""
    return max(1, math.ceil(groups / MOST_GROUPS), min(cores, math.ceil(groups / LEAST_GROUPS)))


def _best_splits_sql(fits: Sequence[Fit], categorical: Sequence[bool]) -> str:
    """For each (model, node, feature) of ``cells``: sums of the node, and gain, sums and bins of the left side of the best split.

    One text for all levels, so that a level costs little planning.
    """

    def of_model(name: str) -> str:
        return f"array({', '.join(f'{float(fit.value(name))!r}D' for fit in fits)})[model]"

    def score(g: str, h: str) -> str:
        return f"coalesce(try_divide(pow(greatest(abs({g}) - l1, 0D), 2D), {h} + l2), 0D)"

    sets = [str(place) for place, is_set in enumerate(categorical) if is_set]
    is_set = f"feature IN ({', '.join(sets)})" if sets else "false"
    members = f"CASE WHEN {is_set} THEN collect_list(bin) OVER upto END" if sets else "CAST(NULL AS array<int>)"
    return f"""
    WITH summed AS (
        SELECT model, node, feature, bin, sum(g) / {UNIT!r}D AS g, sum(h) / {UNIT!r}D AS h, {of_model('reg_alpha')} AS l1,
            {of_model('reg_lambda')} AS l2, {of_model('min_child_weight')} AS least
        FROM {{cells}} GROUP BY model, node, feature, bin
    ), ordered AS (
        SELECT *, CASE WHEN {is_set} THEN coalesce(try_divide(g, h + l2), 0D) ELSE 0D END AS key FROM summed
    ), sides AS (
        SELECT model, node, feature, bin, l1, l2, least, sum(g) OVER whole AS g, sum(h) OVER whole AS h, sum(g) OVER upto AS gl,
            sum(h) OVER upto AS hl, {members} AS members
        FROM ordered WINDOW whole AS (PARTITION BY model, node, feature),
            upto AS (PARTITION BY model, node, feature ORDER BY key, bin ROWS UNBOUNDED PRECEDING)
    ), rated AS (
        SELECT *, CASE WHEN hl >= least AND h - hl >= least AND h - hl > 0
            THEN {score('gl', 'hl')} + {score('(g - gl)', '(h - hl)')} - {score('g', 'h')} END AS gain FROM sides
    )
    SELECT model, node, feature, first(g) AS g, first(h) AS h, max(gain) AS gain,
        max_by(struct(bin, gl, hl, members), struct(gain, -bin)) AS best
    FROM rated GROUP BY model, node, feature"""


def binned_rows(numbered: DataFrame, binning: Binning) -> DataFrame:
    """(number, label, fold, bins) of rows with ``number``, ``label`` and ``fold``."""
    names = [f"f{place}" for place in range(len(binning.features))]
    chosen = numbered.select(
        F.col("number").cast("long"), F.col("label").cast("int"), F.col("fold").cast("int"),
        *[column.alias(name) for column, name in zip(binning.columns(), names)],
    )

    def run(batches):
        for batch in batches:
            bins = binning.numbered([batch.column(name) for name in names])
            data, step = bins.tobytes(), 2 * bins.shape[1]
            parts = [data[at : at + step] for at in range(0, len(data), step)] if step else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("number"), batch.column("label"), batch.column("fold"), pa.array(parts, pa.binary())],
                names=["number", "label", "fold", "bins"],
            )

    return chosen.mapInArrow(run, "number long, label int, fold int, bins binary")


STATE = "number long, label int, fold int, bins binary, margins binary"


def _with_margins(rows: DataFrame, fresh: list[tuple[float, list[Tree]]], features: int, first: bool) -> DataFrame:
    """Rows with the margins of all models, the new trees added."""

    def run(batches):
        for batch in batches:
            if first:
                size = batch.num_rows
                bins = _numbers(batch.column("bins"), np.int16).reshape(size, features)
                margins = np.tile([base for base, _ in fresh], (size, 1))
            else:
                *_, bins, margins = _decoded(batch, features, len(fresh))
                margins = margins.copy()
            for model, (_, trees) in enumerate(fresh):
                for tree in trees:
                    margins[:, model] += tree.margins(bins)
            data, step = margins.astype(np.float64).tobytes(), 8 * len(fresh)
            parts = [data[at : at + step] for at in range(0, len(data), step)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in ("number", "label", "fold", "bins")] + [pa.array(parts, pa.binary())],
                names=["number", "label", "fold", "bins", "margins"],
            )

    return rows.mapInArrow(run, STATE)


def grow_models(rows: DataFrame, binning: Binning, fits: Sequence[Fit], trees: int, kept_trees: int = KEPT_TREES) -> list[BoostedTrees]:
    """Models for all ``fits`` from binned rows (``binned_rows``, written), grown side by side in the same jobs."""
    spark, features, cores = rows.sparkSession, len(binning.features), rows.sparkSession.sparkContext.defaultParallelism
    counts = {(r["fold"], r["label"]): r["count"] for r in rows.groupBy("fold", "label").count().collect()}  # folds x labels
    growing = []
    for fit in fits:
        own = {key: n for key, n in counts.items() if fit.held_out is None or key[0] != fit.held_out}
        total, ones = sum(own.values()), sum(n for (_, label), n in own.items() if label == 1)
        if not total:
            raise ValueError("no complete rows to train on")
        share = min(max(ones / total, 1e-6), 1 - 1e-6)
        growing.append(_Growing(fit, math.log(share / (1 - share)), features, trees))

    def write(source: DataFrame, first: bool) -> str:
        path = fresh_path(spark, "margins")
        fresh = [(m.base, m.trees[m.written :]) for m in growing]
        _with_margins(source, fresh, features, first).write.parquet(path)
        for model in growing:
            model.written = len(model.trees)
        return path

    path = write(rows, True)
    state = spark.read.schema(STATE).parquet(path)
    best_splits = _best_splits_sql(fits, [known is not None for known in binning.categories])
    while any(not model.done for model in growing):
        active = [
            (number, m.fit, m.trees[m.written :], m.tree, m.open, m.drawn, len(m.trees))
            for number, m in enumerate(growing) if not m.done
        ]
        cells = state.mapInArrow(
            _cells(active, features, len(growing), binning.width),
            "model int, node int, feature int, bin int, g double, h double",
        ).repartition(_parts(sum(len(nodes) * len(drawn) for *_, nodes, drawn, _ in active), cores), "model", "node", "feature")
        found: dict[int, dict[int, list]] = {}
        for row in spark.sql(best_splits, cells=cells).collect():  # models x open nodes x features
            found.setdefault(row["model"], {}).setdefault(row["node"], []).append(row)
        for number, *_ in active:
            growing[number].grow(found.get(number, {}))
        if any(not m.done for m in growing) and max(len(m.trees) - m.written for m in growing) >= kept_trees:
            old, path = path, write(state, False)
            state = spark.read.schema(STATE).parquet(path)
            removed(spark, old)
    removed(spark, path)
    return [BoostedTrees(binning, m.base, m.trees, m.columns) for m in growing]


def first_gains(model: BoostedTrees, df: DataFrame, parameters: dict) -> DataFrame:
    """(feature, gain): the gain of the best split of all rows by each feature, before any tree; null where none is allowed."""
    spark, binning = df.sparkSession, model.binning
    numbered = df.withColumn("number", F.monotonically_increasing_id()).withColumn("fold", F.lit(0))
    rows = _with_margins(binned_rows(numbered, binning), [(model.base, [])], len(binning.features), True)
    fit = Fit(parameters | {"subsample": 1.0})
    active = [(0, fit, [], None, [0], range(len(binning.features)), 0)]
    cells = rows.mapInArrow(
        _cells(active, len(binning.features), 1, binning.width), "model int, node int, feature int, bin int, g double, h double"
    )
    splits = spark.sql(_best_splits_sql([fit], [known is not None for known in binning.categories]), cells=cells)
    return splits.select(F.get(F.array(*[F.lit(f) for f in binning.features]), F.col("feature")).alias("feature"), "gain")


def held_out_scores(rows: DataFrame, models: Sequence[BoostedTrees], fits: Sequence[Fit], trials: Sequence[int]) -> DataFrame:
    """(trial, fold, label, default_probability) of the rows that each model has left out, from one pass."""
    features = len(models[0].binning.features)

    def run(batches):
        for batch in batches:
            bins = _numbers(batch.column("bins"), np.int16).reshape(batch.num_rows, features)
            folds, labels = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("fold", "label"))
            for model, fit, trial in zip(models, fits, trials):
                own = folds == fit.held_out
                if own.any():
                    scores = 1 / (1 + np.exp(-model.margins(bins[own])))
                    yield pa.RecordBatch.from_pydict({
                        "trial": pa.array(np.full(len(scores), trial), pa.int32()), "fold": pa.array(folds[own], pa.int32()),
                        "label": pa.array(labels[own], pa.int32()), "default_probability": pa.array(scores, pa.float64()),
                    })

    return rows.mapInArrow(run, "trial int, fold int, label int, default_probability double")
