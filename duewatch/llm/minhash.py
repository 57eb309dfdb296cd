"""Near duplicates by HyperMinHash: documents whose sets of five-word shingles have a Jaccard similarity of 0.75 or more.

A set is sketched SKETCHES times. Each sketch deals the shingle hashes to four
buckets and keeps, of each bucket's least value, the number of leading zeros and
ten bits after them: a register of 16 bits, so a sketch is 64 bits, and these
are the banding key. A pair at similarity 0.75 shares no key with probability
(1 - 0.75^4)^40, about 3 in 10 million, and less above.

1. Documents of equal sets become one class, aggregated before the shuffle.
2. In each group of classes with an equal key, every class is compared with the
   least one. Compared means: the registers' collision-corrected estimate is not
   under ESTIMATE, then the full sets are joined and the link is confirmed.
3. Confirmed links give components. Classes of groups that still span several
   components are gathered into crowds, connected by the groups they share, so
   that each class is in one crowd. All pairs of a crowd that share a key and are
   in different components are compared, block by block inside tasks: registers
   first, then the full sets. Only links that join components become rows.

So pairs within a component that is already known are never formed, whatever the
size of a group of copies, and no candidate is dropped. Sets are compared as
sets of 64-bit shingle hashes.

Documents with fewer than five words have their whole sequence as one shingle.
Null and empty texts have no shingles and link with nothing. Rows without an id
link with nothing, have no component and are kept. Repeated rows share a class;
rows that repeat the id of the kept document are kept with it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duewatch.llm.blocks import block_counts, blocked, paired
from duewatch.llm.components import connected_components
from duewatch.llm.scratch import Scratch
from duewatch.llm.text import WordHashes, binary_texts, in_groups, mixed, window_hashes

SHINGLE = 5
PERCENT = 75
SKETCHES = 40
BUCKETS = 4
MANTISSA = 10
REGISTERS = SKETCHES * BUCKETS
COLLISION = 0.5 * 2.0**-MANTISSA  # two unrelated registers agree about so often
ESTIMATE = 0.55  # six standard deviations of 160 registers below 0.75
BLOCK = 512
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def multipliers() -> np.ndarray:
    """One odd factor per sketch, by a fixed rule."""
    return mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def lowered(texts: list[bytes | None]) -> list[bytes | None]:
    """With A-Z in lower case; bytes.lower() changes no other character."""
    return [text and text.lower() for text in texts]


def shingle_sets(group: list[list[bytes]], table: WordHashes) -> list[np.ndarray]:
    """The distinct shingle hashes, in order, of each document of a group."""
    lengths = np.array([len(doc) for doc in group])
    words = table.of([w for doc in group for w in doc])
    hashes = window_hashes(words, SHINGLE)
    sets, begin = [], 0
    for size in lengths:
        if size >= SHINGLE:
            own = hashes[begin : begin + size - SHINGLE + 1]
            sets.append(np.unique(own))
        elif size:
            short = window_hashes(words[begin : begin + size], int(size))
            sets.append(mixed(short + np.uint64(size)))
        else:
            sets.append(np.empty(0, np.uint64))
        begin += size
    return sets


def registers(values: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of bucket minima; 0 stands for an empty bucket."""
    empty = values == EMPTY
    # frexp gives the binary exponent; the float's 53 bits are enough for the mantissa bits kept.
    fraction, exponent = np.frexp(np.maximum(values, np.uint64(1)).astype(np.float64))
    zeros = np.clip(64 - exponent, 0, 62).astype(np.uint16)
    mantissa = ((fraction - 0.5) * (1 << (MANTISSA + 1))).astype(np.uint16) & np.uint16((1 << MANTISSA) - 1)
    return np.where(empty, np.uint16(0), ((zeros + np.uint16(1)) << np.uint16(MANTISSA)) | mantissa)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Registers (documents x REGISTERS) of sets that are not empty."""
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    hashes = np.concatenate(sets)
    least = np.empty((len(sets), REGISTERS), np.uint64)
    for sketch, factor in enumerate(multipliers()):
        values = hashes * factor
        bucket = values >> np.uint64(62)
        values = (values << np.uint64(2)) ^ (values >> np.uint64(40))
        for place in range(BUCKETS):
            least[:, sketch * BUCKETS + place] = np.minimum.reduceat(
                np.where(bucket == place, values, EMPTY), starts
            )
    return registers(least)


def _signatures(batches):
    table = WordHashes()
    for batch in batches:
        ids = batch.column("id")
        for first, group in in_groups(lowered(binary_texts(batch, "text")), 1 << 18):
            sets = shingle_sets(group, table)
            full = [i for i, s in enumerate(sets) if len(s)]
            found = sketches([sets[i] for i in full]) if full else np.empty((0, REGISTERS), np.uint16)
            keys: list[int | None] = [None] * len(sets)
            rows: list[bytes | None] = [None] * len(sets)
            for place, i in enumerate(full):
                keys[i] = xxhash.xxh3_64_intdigest(sets[i].tobytes()) - (1 << 63)
                rows[i] = found[place].tobytes()
            yield pa.RecordBatch.from_arrays(
                [ids.slice(first, len(group)), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(keys, pa.int64()), pa.array(rows, pa.binary())],
                names=["id", "n_shingles", "key", "regs"],
            )


def _bands(batches):
    seeds = mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64))
    for batch in batches:
        if not batch.num_rows:
            continue
        regs = np.frombuffer(b"".join(batch.column("regs").to_pylist()), np.uint64).reshape(-1, SKETCHES)
        keys = np.repeat(batch.column("key").to_numpy(zero_copy_only=False), SKETCHES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(mixed(regs ^ seeds).ravel().view(np.int64)), pa.array(keys)], names=["band", "key"]
        )


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates of register rows, broadcast against each other."""
    used = np.count_nonzero((a != 0) | (b != 0), axis=-1)
    equal = np.count_nonzero((a == b) & (a != 0), axis=-1)
    return (equal / np.maximum(used, 1) - COLLISION) / (1 - COLLISION)


def _passing(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("ra", "rb"))
        good = pa.array(estimates(a, b) >= ESTIMATE)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(good), batch.column("b").filter(good)], names=["a", "b"])


def _across(percent: int):
    """Confirmed links of two blocks that join different components."""

    def side(rows):
        regs = np.frombuffer(b"".join(rows.field("regs").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        lists = rows.field("shingles")
        flat, offsets = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        sets = [flat[x:y].view(np.uint64) for x, y in zip(offsets, offsets[1:])]
        return rows.field("key").to_numpy(), rows.field("root").to_numpy(), regs, sets

    def run(batches):
        for batch in batches:
            for place in range(batch.num_rows):
                ka, ca, a, sa = side(batch.column("left")[place].values)
                kb, cb, b, sb = side(batch.column("right")[place].values)
                found = list(_joining(ka, ca, a, sa, kb, cb, b, sb, percent))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"]
                )

    return run


def _joining(ka, ca, a, sa, kb, cb, b, sb, percent: int):
    joined = {int(c): int(c) for c in np.concatenate([ca, cb])}

    def find(c):
        while joined[c] != c:
            joined[c] = c = joined[joined[c]]
        return c

    keys_a, keys_b = a.view(np.uint64), b.view(np.uint64)
    for i in range(len(ka)):
        near = (keys_b == keys_a[i]).any(axis=1) & (cb != ca[i])
        others = np.flatnonzero(near)
        for j in others[estimates(a[i], b[others]) >= ESTIMATE].tolist():
            x, y = find(int(ca[i])), find(int(cb[j]))
            if x != y and _alike(sa[i], sb[j], percent):
                joined[max(x, y)] = min(x, y)
                yield int(ka[i]), int(kb[j])


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Of two ordered arrays of distinct hashes."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    small, large = (a, b) if len(a) < len(b) else (b, a)
    place = np.minimum(np.searchsorted(large, small), len(large) - 1)
    shared = int(np.count_nonzero(large[place] == small))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _sets(batches):
    table = WordHashes()
    for batch in batches:
        wanted = batch.column("key").to_pylist()
        for first, group in in_groups(lowered(binary_texts(batch, "text")), 1 << 18):
            sets = shingle_sets(group, table)
            keys = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None for s in sets]
            good = [i for i in range(len(sets)) if keys[i] == wanted[first + i]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[i] for i in good], pa.int64()),
                 pa.array([sets[i].view(np.int64) for i in good], pa.list_(pa.int64()))],
                names=["key", "shingles"],
            )


def _full_sets(keys: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(key, shingles) of the classes with these keys, from the whole text of a document of each."""
    wanted = classes.join(keys.distinct(), "key").select("key", F.col("doc").alias("id"))
    read = docs.join(wanted, "id").select("key", "text").mapInArrow(_sets, "key long, shingles array<long>")
    return read.groupBy("key").agg(F.first("shingles").alias("shingles"))


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) of class keys whose full sets are alike, written."""
    regs = classes.select("key", "regs")
    likely = scratch.put(
        pairs.join(regs.toDF("a", "ra"), "a").join(regs.toDF("b", "rb"), "b")
        .select("a", "b", "ra", "rb").mapInArrow(_passing, "a long, b long"),
        "pairs",
    )
    sets = scratch.put(_full_sets(likely.select(F.explode(F.array("a", "b")).alias("key")), classes, docs), "sets")
    both = likely.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    alike = shared * 100 >= (F.size("sa") + F.size("sb") - shared) * percent
    links = scratch.put(both.filter(alike).select("a", "b"), "links")
    scratch.drop(likely, sets)
    return links


def _edges(roots: DataFrame) -> DataFrame:
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b"))


def _undecided(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(band, key, root) of the groups whose members, without the first round's lead, are in several components."""
    rest = members.filter("n > 2 and key <> lead").join(roots.withColumnRenamed("node", "key"), "key", "left").select(
        "band", "key", F.coalesce("root", "key").alias("root")
    )
    several = rest.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y")
    return rest.join(several.select("band"), "band")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id and kept."""
    scratch = Scratch(docs.sparkSession)
    docs = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    id_type = docs.schema["id"].dataType.simpleString()
    signed = scratch.put(
        docs.mapInArrow(_signatures, f"id {id_type}, n_shingles long, key long, regs binary"), "signatures"
    )
    classes = scratch.put(
        signed.filter("key is not null and id is not null").groupBy("key").agg(
            F.min("id").alias("doc"), F.first("regs").alias("regs")
        ),
        "classes",
    )
    bands = classes.select("key", "regs").mapInArrow(_bands, "band long, key long")
    crowds = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("lead")).filter("n > 1")
    members = scratch.put(bands.join(crowds, "band"), "members")

    first = members.filter("key <> lead").select(F.col("lead").alias("a"), F.col("key").alias("b")).distinct()
    links = _confirmed(first, classes, docs, percent, scratch)
    roots = connected_components(links, scratch)

    rest = scratch.put(_undecided(members, roots), "rest")
    leads = rest.groupBy("band").agg(F.min("key").alias("a"))
    crowded = connected_components(rest.join(leads, "band").select("a", F.col("key").alias("b")), scratch)
    open_keys = rest.select("key", "root").distinct().join(
        crowded.select(F.col("node").alias("key"), F.col("root").alias("crowd")), "key", "left"
    ).select("key", "root", F.coalesce("crowd", "key").alias("crowd"))
    sets = scratch.put(_full_sets(open_keys.select("key"), classes, docs), "sets")
    rows = open_keys.join(classes.select("key", "regs"), "key").join(sets, "key")
    lists = scratch.put(
        blocked(rows, "crowd", "key", ["key", "root", "regs", "shingles"], BLOCK, block_counts(open_keys, "crowd", BLOCK)),
        "lists",
    )
    more = scratch.put(
        paired(lists, lists, "crowd", same=True).select("left", "right").mapInArrow(_across(percent), "a long, b long"), "links"
    )
    roots = connected_components(_edges(roots).unionByName(more), scratch)
    grouped = classes.select("key", "doc").join(roots.withColumnRenamed("node", "key"), "key", "left").select(
        "key", "doc", F.coalesce("root", "key").alias("root")
    )
    leaders = grouped.groupBy("root").agg(F.min("doc").alias("leader"))
    final = scratch.put(grouped.join(leaders, "root").select("key", "leader"), "components")
    scratch.drop(members, links, rest, sets, lists, more, classes)
    own = F.coalesce(F.when(F.col("id").isNotNull(), F.col("leader")), F.col("id"))
    return signed.select("id", "n_shingles", "key").join(final, "key", "left").select(
        F.col("id").alias(id_column), "n_shingles", own.alias("component_id"),
        F.coalesce(F.col("id") == own, F.lit(True)).alias("kept"),
    )


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One document of each group, with its columns; rows without an id stay."""
    kept = near_duplicates(docs, id_column, text_column).filter("kept").select(F.col(f"`{id_column}`").alias(f"{id_column} kept")).distinct()
    return docs.join(kept, F.col(f"`{id_column}`").eqNullSafe(F.col(f"`{id_column} kept`")), "left_semi")
