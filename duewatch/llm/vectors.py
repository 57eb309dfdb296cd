"""Near duplicates among embeddings: spherical k-means cells and blocked cosine products within them.

Vectors that are equal in every component are one class. Of a length with many
classes, only those that can have a partner go on, in groups that no pair of
similar vectors crosses (see ``screening``); the classes of a shorter list are one
group. A large group has cells of its own. Centres are fitted on a bounded sample; every class then has a
home cell, the nearest centre's. It is also sent, as a guest, to each
lower-numbered cell that can be the home of a partner, so that a pair whose homes
differ meets once, in the lower one, and no pair is lost. A partner y of x lies
within sqrt(2 - 2 * threshold). With x at home in i and y in j, (x - y).(c_i - c_j)
is at least x.c_i - x.c_j, hence that is at most this distance times |c_i - c_j|.

Within a cell, homes are compared with homes and guests by products of bounded
blocks (see ``blocks``), in double precision. A product of blocks gives, per
vector, its number of links and the least vector it is connected to in there;
pairs are no rows. Components are then joined in Spark.

Vectors that are null, zero, or hold null or non-finite components link with
nothing; so do rows without an id, which have no component and are kept. Repeated rows are equal vectors and link with each other.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duewatch.llm import screening
from duewatch.llm.blocks import blocked, paired
from duewatch.llm.components import connected_components
from duewatch.llm.scratch import Scratch

THRESHOLD = 0.95
CELL = 2048  # classes per cell aimed at
MOST_CELLS = 1024  # of a vector length; bounds the centres every task gets
SCREENED = 8192  # classes of a length from which they are screened first
SAMPLE = 8192  # classes the centres are fitted on, the first in the order of their hash
ROUNDS = 10
BLOCK = 1024
BLOCK_BYTES = 1 << 19  # bounds the blocks of long vectors
SLACK = 1e-9  # for rounding


def _units(column, rows: int, narrow: bool) -> np.ndarray:
    """Unit vectors in double precision. ``narrow``: the column holds single-precision vectors of any length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends, kind = np.frombuffer(column.buffers()[1], np.int32), np.dtype(np.float32 if narrow else np.float64)
    start, end = int(ends[column.offset]), int(ends[column.offset + rows])
    values = np.frombuffer(column.buffers()[2], kind, (end - start) // kind.itemsize, start).reshape(rows, -1)
    if narrow:
        values = values.astype(np.float64)
        values /= np.sqrt(np.einsum("ij,ij->i", values, values))[:, None]
    return values


def _prepared(narrow: bool):
    def run(batches):
        for batch in batches:
            yield _prepared_batch(batch, narrow)

    return run


def _plain(vectors: pa.Array, kind: type) -> np.ndarray | None:
    """The vectors as rows, if all have one length and only ordinary components."""
    flat = vectors.flatten()
    if not len(vectors) or vectors.null_count or flat.null_count or not len(flat) or len(flat) % len(vectors):
        return None
    sizes = np.diff(vectors.offsets.to_numpy())
    if (sizes != sizes[0]).any():
        return None
    own = flat.to_numpy().astype(kind, copy=False).reshape(len(vectors), -1)
    squares = np.einsum("ij,ij->i", own, own, dtype=np.float64)
    return own if (np.isfinite(squares) & (squares > 1e-200)).all() else None


def _prepared_batch(batch: pa.RecordBatch, narrow: bool) -> pa.RecordBatch:
    keys, sizes, data = [], [], []
    plain = _plain(batch.column("vector"), np.float32 if narrow else np.float64)
    if plain is not None:
        wide = plain.astype(np.float64)
        units = plain if narrow else np.stack([own / float(np.sqrt(own @ own)) for own in wide])
        hashed, data = (wide + 0.0).tobytes(), units.tobytes()
        step, held = 8 * plain.shape[1], units.itemsize * plain.shape[1]
        keys = [xxhash.xxh3_64_intdigest(hashed[i : i + step]) - (1 << 63) for i in range(0, len(hashed), step)]
        sizes = np.full(len(plain), plain.shape[1], np.int32)
        ends = np.arange(len(plain) + 1, dtype=np.int32) * held
        unit = pa.Array.from_buffers(pa.binary(), len(plain), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(keys, pa.int64()), pa.array(sizes), unit], names=["id", "key", "size", "unit"]
        )
    for values in batch.column("vector").to_pylist():
        own = np.array(values, np.float64) if values and None not in values else np.empty(0)
        norm = float(np.sqrt(own @ own)) if len(own) and np.isfinite(own).all() else 0.0
        if not norm or not math.isfinite(norm):
            scale = np.abs(own).max(initial=0.0) if len(own) and np.isfinite(own).all() else 0.0
            own = own / scale if scale else own[:0]
            norm = float(np.sqrt(own @ own))
        if not norm:
            keys.append(None), sizes.append(None), data.append(None)
            continue
        keys.append(xxhash.xxh3_64_intdigest((own + 0.0).tobytes()) - (1 << 63))
        sizes.append(len(own))
        data.append((own.astype(np.float32) if narrow else own / norm).tobytes())
    return pa.RecordBatch.from_arrays(
        [batch.column("id"), pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()), pa.array(data, pa.binary())],
        names=["id", "key", "size", "unit"],
    )


def spherical_centres(units: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of unit length; starts from evenly spaced rows, and an empty cell keeps its centre."""
    centres = units[np.linspace(0, len(units) - 1, cells).astype(int)].copy()
    for _ in range(rounds):
        home = (units @ centres.T).argmax(axis=1)
        order = np.argsort(home, kind="stable")
        places, starts = np.unique(home[order], return_index=True)
        sums = np.add.reduceat(units[order], starts, axis=0)
        norms = np.linalg.norm(sums, axis=1)
        good = norms > 1e-12
        centres[places[good]] = sums[good] / norms[good, None]
    return centres


def _fitted(narrow: bool):
    """Centres of one group from its sample."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("draw", "ascending"), ("key", "ascending")]).slice(0, SAMPLE)
        units = _units(table.column("unit"), table.num_rows, narrow)
        centres = spherical_centres(units, min(table.column("cells")[0].as_py(), len(units)))
        group = {name: table.column(name).slice(0, 1) for name in ("size", "root")}
        return pa.table(group | {"centres": pa.array([centres.tobytes()], pa.binary())})

    return run


def guests_of(near: np.ndarray, home: np.ndarray, apart: np.ndarray, threshold: float) -> np.ndarray:
    """Which lower cells (columns) can be the home of a partner of each row. ``apart``: distances between centres."""
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    best = near[np.arange(len(home)), home]
    return (best[:, None] - near <= reach * apart[home] + SLACK) & (np.arange(near.shape[1]) < home[:, None])


def _dealt(centres: dict[tuple[int, int], np.ndarray], threshold: float, narrow: bool):
    """``centres``: of each large group."""

    def run(batches):
        apart = {
            group: np.sqrt(np.maximum(0, 2 - 2 * np.clip(own @ own.T, -1, 1))) + SLACK for group, own in centres.items()
        }
        for batch in batches:
            groups = np.stack([batch.column(name).to_numpy() for name in ("size", "root")], axis=1)
            for group in map(tuple, np.unique(groups, axis=0).tolist()):
                part = batch.take(pa.array(np.flatnonzero((groups == group).all(axis=1))))
                units = _units(part.column("unit"), part.num_rows, narrow)
                near = units @ centres[group].T
                home = near.argmax(axis=1)
                sent = guests_of(near, home, apart[group], threshold)
                sent[np.arange(len(home)), home] = True
                rows, cells = np.nonzero(sent)
                for start in range(0, len(rows), 8192):
                    place, cell = rows[start : start + 8192], cells[start : start + 8192]
                    taken = part.take(pa.array(place))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell.astype(np.int32)), pa.array(cell == home[place]), *taken.columns],
                        names=["part", "home", *batch.schema.names],
                    )

    return run


def _linked(same: bool, threshold: float, narrow: bool):
    """For each vector with links in a pair of blocks: their number, copies counted, and the least class it reaches."""

    def side(rows):
        return rows.field("key").to_numpy(), rows.field("n").to_numpy(), _units(rows.field("unit"), len(rows), narrow)

    def run(batches):
        for batch in batches:
            keys, counts, roots = [], [], []
            for place in range(batch.num_rows):
                ka, na, a = side(batch.column("left")[place].values)
                kb, nb, b = side(batch.column("right")[place].values)
                alike = a @ b.T >= threshold
                itself = same and batch.column("i")[place] == batch.column("j")[place]
                if itself:
                    alike &= ka[:, None] != kb[None]
                x, y = alike.any(axis=1), alike.any(axis=0)
                if not x.any():
                    continue
                alike, ka, na, kb, nb = alike[np.ix_(x, y)], ka[x], na[x], kb[y], nb[y]
                ra, rb = ka.copy(), kb.copy()
                while True:
                    rows = np.minimum(ra, np.where(alike, rb[None], np.iinfo(np.int64).max).min(axis=1))
                    columns = np.minimum(rb, np.where(alike, rows[:, None], np.iinfo(np.int64).max).min(axis=0))
                    if (rows == ra).all() and (columns == rb).all():
                        break
                    ra, rb = rows, columns
                keys.append(ka), counts.append((alike * nb[None]).sum(axis=1)), roots.append(ra)
                if not itself:
                    keys.append(kb), counts.append((alike * na[:, None]).sum(axis=0)), roots.append(rb)
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(part).astype(np.int64)) for part in (keys, counts, roots)],
                    names=["key", "links", "root"],
                )

    return run


def _screened(vectors: DataFrame, classes: DataFrame, scratch: Scratch, threshold: float, narrow: bool) -> DataFrame:
    """(size, key, unit, root) of the vectors to be compared, with their group, the root."""
    kinds = [(row["size"], row["total"]) for row in classes.groupBy("size").agg(F.count(F.lit(1)).alias("total")).collect()]
    plans = {size: found for size, total in kinds if total >= SCREENED and (found := screening.plan(total, size, threshold))}
    vectors = vectors.select("size", "key", "unit")
    whole = vectors.filter(~F.col("size").isin(list(plans))).withColumn("root", F.lit(0).cast("long"))
    if not plans:
        return whole
    links = []
    for table in range(max(tables for _, tables, _ in plans.values())):
        own = {size: found for size, found in plans.items() if table < found[1]}
        rows = vectors.filter(F.col("size").isin(list(own))).mapInArrow(
            screening.sent(own, table, lambda column, rows: _units(column, rows, narrow)), screening.SENT_SCHEMA
        )
        reducers = math.ceil(sum(parts for _, _, parts in own.values()) / screening.PARTS)
        links.append(
            scratch.put(rows.repartition(reducers, "part").mapInArrow(screening.met(threshold), "a long, b long"), "met")
        )
    roots = connected_components(reduce(DataFrame.unionByName, links), scratch)
    scratch.drop(*links)
    members = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    some = vectors.filter(F.col("size").isin(list(plans))).join(members.withColumnRenamed("node", "key"), "key")
    return whole.unionByName(some)


def _large(classes: DataFrame) -> DataFrame:
    """(size, root, total, cells) of the groups that are divided into cells."""
    groups = classes.groupBy("size", "root").agg(F.count(F.lit(1)).alias("total")).filter(F.col("total") >= 2 * CELL)
    cell = F.greatest(F.lit(CELL), F.sum("total").over(Window.partitionBy("size")) / MOST_CELLS)
    return groups.withColumn("cells", F.floor(F.col("total") / cell).cast("int")).filter("cells > 1")


def _centres(classes: DataFrame, large: DataFrame, narrow: bool) -> dict[tuple[int, int], np.ndarray]:
    """Of each large group, its centres."""
    draws = 1 << 30
    sample = (
        classes.withColumn("draw", F.pmod(F.xxhash64("key"), F.lit(draws))).join(F.broadcast(large), ["size", "root"])
        .filter(F.col("draw") <= 2 * SAMPLE * draws / F.col("total"))
        .select("size", "root", "key", "draw", "unit", "cells")
    )
    found = sample.groupBy("size", "root").applyInArrow(_fitted(narrow), "size int, root long, centres binary").collect()
    return {(row["size"], row["root"]): np.frombuffer(row["centres"]).reshape(-1, row["size"]) for row in found}


def _block_counts(rows: DataFrame) -> DataFrame:
    """Blocks of each cell: of BLOCK vectors, fewer where they are long."""
    held = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_BYTES) / (8 * F.first("size")))))
    return rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / held).cast("int").alias("blocks"))


def similar_vectors(
    rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``rows``: id, n_links, component_id and kept."""
    scratch = Scratch(rows.sparkSession, swept=True)
    narrow = rows.schema[vector_column].dataType.simpleString() == "array<float>"
    source = rows.select(
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{vector_column}`").cast(f"array<{'float' if narrow else 'double'}>").alias("vector"),
    )
    id_type = source.schema["id"].dataType.simpleString()
    vectors = scratch.put(source.mapInArrow(_prepared(narrow), f"id {id_type}, key long, size int, unit binary"), "vectors")
    named = vectors.filter(F.col("size").isNotNull() & F.col("id").isNotNull())
    classes = scratch.put(
        named.groupBy("size", "key").agg(F.min("id").alias("doc"), F.count(F.lit(1)).alias("n")), "classes"
    )
    rows = scratch.put(vectors.select("id", "key"), "rows")
    compared = scratch.put(
        _screened(named, classes, scratch, threshold, narrow).groupBy("size", "root", "key").agg(
            F.count(F.lit(1)).alias("n"), F.first("unit").alias("unit")
        ),
        "compared",
    )
    scratch.drop(vectors)
    large = scratch.put(_large(compared), "large")
    group, columns = ["size", "root"], ["part", "home", "size", "root", "key", "n", "unit"]
    divided = compared.join(F.broadcast(large), group, "left_semi").select(*columns[2:]).mapInArrow(
        _dealt(_centres(compared, large, narrow), threshold, narrow),
        "part int, home boolean, size int, root long, key long, n long, unit binary",
    )
    undivided = compared.join(F.broadcast(large), group, "left_anti").withColumns({"part": F.lit(0), "home": F.lit(True)})
    dealt = scratch.put(
        undivided.select(*columns).unionByName(divided).withColumn("cell", F.struct("size", "root", "part")), "cells"
    )
    scratch.drop(compared)
    homes, guests = dealt.filter("home"), dealt.filter("not home")
    columns = ["key", "n", "unit"]
    home_lists = scratch.put(blocked(homes, "cell", "key", columns, BLOCK, _block_counts(homes)), "homes")
    guest_lists = scratch.put(blocked(guests, "cell", "key", columns, BLOCK, _block_counts(guests)), "guests")
    found = "key long, links long, root long"
    linked = scratch.put(
        paired(home_lists, home_lists, "cell", same=True).mapInArrow(_linked(True, threshold, narrow), found).unionByName(
            paired(home_lists, guest_lists, "cell", same=False).mapInArrow(_linked(False, threshold, narrow), found)
        ),
        "linked",
    )
    scratch.drop(dealt, home_lists, guest_lists)
    roots = connected_components(linked.select(F.col("key").alias("a"), F.col("root").alias("b")), scratch)
    grouped = classes.select("key", "doc", "n").join(roots.withColumnRenamed("node", "key"), "key", "left").select(
        "key", "doc", "n", F.coalesce("root", "key").alias("root")
    )
    leaders = grouped.groupBy("root").agg(F.min("doc").alias("leader"))
    links = linked.groupBy("key").agg(F.sum("links").alias("links"))
    final = scratch.put(
        grouped.join(leaders, "root").join(links, "key", "left").select(
            "key", "leader", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links")
        ),
        "components",
    )
    scratch.drop(linked, classes)
    named = F.col("id").isNotNull()
    own = F.coalesce(F.when(named, F.col("leader")), F.col("id"))
    return rows.join(final, "key", "left").select(
        F.col("id").alias(id_column), F.coalesce(F.when(named, F.col("links")), F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"), F.coalesce(F.col("id") == own, F.lit(True)).alias("kept"),
    )


def representatives(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """One row of each group of similar vectors, with its columns; rows without an id stay."""
    kept = similar_vectors(rows, id_column, vector_column).filter("kept").select(F.col(f"`{id_column}`").alias(f"{id_column} kept")).distinct()
    return rows.join(kept, F.col(f"`{id_column}`").eqNullSafe(F.col(f"`{id_column} kept`")), "left_semi")
