"""Which tokens of two tokenizers cover the same bytes of a text, and how often each pair of ids does in the corpus.

The byte-level tokenizer (A) reads a space and the text, the SentencePiece model (B) the text, to which it adds that
space itself. The byte offsets at which both end a token cut their ids into groups: each side's ends go into a dictionary
from end to index, the common keys of both are sorted, and consecutive ones slice both lists. Every A id of a group is
linked with every B id of it.

Neither tokenizer lets a token cross from a character that is no white space into a space, so a text's groups are those
of its space-led chunks laid end to end, and a task aligns each distinct chunk once. Chunks whose bytes a tokenizer
changes send their document to the plain way, the whole text at once.

How counts travel: a task gathers its documents in blocks of bounded size and writes, with each block, the distinct
pairs it holds and the number of its documents that hold them. Spark sums these over blocks, joins the sums back to the
blocks' pairs, and blocks meet their answers in a cogroup. A pair held by a third of all documents is one row per block.

A text has no tokens, and zeros, if it is null or empty or if the joined bytes of A or of B are not the space and the
text. Repeated rows and ids count each by itself; null ids are kept. Very long texts are one row and are never cut: a
group's links are kept as distinct pairs with their number. Ties: all links whose count is the highest count as best.
Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duewatch.llm.scratch import Scratch
from duewatch.llm.tokens import ByteLevel

MARK = "▁"
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")

# Python's \s covers every character that either tokenizer takes for white space, so no run of it is ever cut.
CUT = re.compile(r"(?<=\S)(?= )")
RUN = re.compile(r"\s ")

CACHED_CHUNKS, CACHED_CHARACTERS = 300_000, 16 << 20  # a task's table is emptied beyond these; it is only a cache
GROUP_CHUNKS = 1 << 18  # so many chunks are looked up at once
BLOCK_PAIRS = 2_000_000  # a block ends at so many pairs of a document; one document is never split
WHOLE_PRODUCT = 64  # groups with more links are kept as distinct pairs


class Pieces:
    """Ids and their bytes by a SentencePiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(n) for n in range(self.model.get_piece_size())]
        if any(MARK in piece.lstrip(MARK) for piece in pieces):
            raise ValueError("the model has pieces that cross whitespace markers")
        self.bytes = {n: self._bytes(n, piece) for n, piece in enumerate(pieces)}
        # A mark with nothing behind it, at the end of a text; the library encodes an empty chunk as nothing.
        self.lone = self.model.encode("a ")[len(self.model.encode("a")) :]

    def _bytes(self, number: int, piece: str) -> bytes:
        if self.model.is_byte(number):
            return bytes([int(BYTE_PIECE.fullmatch(piece)[1], 16)])
        return piece.replace(MARK, " ").encode()

    def encode(self, chunks: list[str]) -> list[list[int]]:
        found = self.model.encode(chunks, num_threads=1) if chunks else []
        return [ids if chunk else self.lone for chunk, ids in zip(chunks, found)]


def aligned_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The byte offsets at which both sides end a token, and how many tokens of each side end there or before.

    Each side's ends are put into a dictionary from end to index; the common keys are sorted.
    """
    a_index = dict(zip(a_ends.tolist(), range(1, len(a_ends) + 1)))
    b_index = dict(zip(b_ends.tolist(), range(1, len(b_ends) + 1)))
    common = sorted(a_index.keys() & b_index.keys())
    places = [np.fromiter(map(index.__getitem__, common), np.int64, len(common)) for index in (a_index, b_index)]
    return np.array(common, np.int64), *places


class Growing:
    """A numpy array that values are appended to."""

    def __init__(self, *shape: int):
        self.size, self.data = 0, np.empty((1 << 12, *shape), np.int64)

    def extend(self, values: np.ndarray) -> None:
        while self.size + len(values) > len(self.data):
            self.data = np.concatenate([self.data, np.empty_like(self.data)])
        self.data[self.size : self.size + len(values)] = values
        self.size += len(values)


class AlignedChunks:
    """For each distinct chunk of a task: numbers of ids, groups and links, the groups as text, and its linked pairs.

    A pair is the A id times ``width`` plus the B id. ``failed`` chunks have other bytes than the text. New chunks are
    aligned many at a time, laid end to end: both sides end a token at the end of each.
    """

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.width = len(self.b.bytes)
        self.lengths = [np.array([len(side.get(i, b"")) for i in range(max(side) + 1)]) for side in (self.a.bytes, self.b.bytes)]
        # An id as text with what stands behind it: A ids within and at the end of their side of a group, then B ids.
        a, b = len(self.lengths[0]), len(self.lengths[1])
        self.written = [f"{i}{end}" for ids, ends in ((a, ",|"), (b, ",;")) for end in ends for i in range(ids)]
        self.starts = (0, a, 2 * a, 2 * a + b)
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.characters = 0
        self.texts: list[str] = []
        self.sizes = Growing(7)  # n_a, n_b, n_groups, n_links, failed, first pair, number of pairs
        self.pairs, self.times = Growing(), Growing()

    def chunks(self, text: str) -> list[str]:
        """The text in chunks that a space precedes; the first one is preceded by the added space."""
        if RUN.search(text) or text[0] == " ":
            return [chunk[1:] for chunk in CUT.split(" " + text)]
        return text.split(" ")

    def learn(self, chunks: set[str]) -> None:
        if len(self.places) > CACHED_CHUNKS or self.characters > CACHED_CHARACTERS:
            self.clear()
        new = [chunk for chunk in chunks if chunk not in self.places]
        self.characters += sum(map(len, new))
        # Those that end in white space, or are empty, stand at the end of a text: the next one would change their ids.
        inner = [chunk for chunk in new if chunk and not chunk[-1].isspace()]
        for start in range(0, len(inner), 4096):
            some = inner[start : start + 4096]
            a_ids = self.a.encode(" " + " ".join(some))
            self.add(some, a_ids, self.b.encode(some))
        for chunk in new:
            if not chunk or chunk[-1].isspace():
                self.add([chunk], self.a.encode(" " + chunk), self.b.encode([chunk]))

    def add(self, chunks: list[str], a_list: list[int], b_lists: list[list[int]]) -> None:
        """Align new chunks, given A's ids of all of them and B's of each."""
        encoded = [(" " + chunk).encode() for chunk in chunks]
        b_list = list(chain.from_iterable(b_lists))
        sides = [b"".join(map(side.__getitem__, ids)) for side, ids in ((self.a.bytes, a_list), (self.b.bytes, b_list))]
        failed = any(side != b"".join(encoded) for side in sides)
        if failed and len(chunks) > 1:
            half = len(chunks) // 2
            for part, lists in ((chunks[:half], b_lists[:half]), (chunks[half:], b_lists[half:])):
                self.add(part, self.a.encode(" " + " ".join(part)), lists)
            return
        first = len(self.texts)
        self.places.update(zip(chunks, range(first, first + len(chunks))))
        if failed:
            self.sizes.extend(np.array([[0, 0, 0, 0, 1, self.pairs.size, 0]]))
            self.texts.append("")
            return
        a_ids, b_ids = np.array(a_list, np.int64), np.array(b_list, np.int64)
        ends, a_to, b_to = aligned_ends(np.cumsum(self.lengths[0][a_ids]), np.cumsum(self.lengths[1][b_ids]))
        a_from, b_from = (np.concatenate([[0], to[:-1]]) for to in (a_to, b_to))
        n_a, n_b = a_to - a_from, b_to - b_from
        # The chunk of each group, and the first group of each chunk.
        last = np.searchsorted(ends, np.cumsum([len(data) for data in encoded])) + 1
        groups = np.diff(last, prepend=0)
        starts = last - groups
        pairs, times, held = self._links(a_ids, b_ids, a_from, b_from, n_a, n_b)
        firsts = self.pairs.size + np.concatenate([[0], np.cumsum(held)])
        sums = [np.add.reduceat(values, starts) for values in (n_a, n_b, n_a * n_b, held)]
        self.sizes.extend(np.stack(
            [sums[0], sums[1], groups, sums[2], np.zeros(len(chunks), np.int64), firsts[starts], sums[3]], axis=1
        ))
        self.pairs.extend(pairs)
        self.times.extend(times)
        self._write(a_ids, b_ids, a_from, b_from, n_a, n_b, starts, last)

    def _links(self, a_ids, b_ids, a_from, b_from, n_a, n_b):
        """Pairs of all groups with their number, and the number of pairs of each group."""
        held = n_a * n_b
        small = held <= WHOLE_PRODUCT
        if small.all():
            group, step = np.repeat(np.arange(len(held)), held), _ranges(np.zeros(len(held), np.int64), held)
            pairs = a_ids[a_from[group] + step // n_b[group]] * self.width + b_ids[b_from[group] + step % n_b[group]]
            return pairs, np.ones(len(pairs), np.int64), held
        parts, counts = [], []
        for group in range(len(held)):
            own = [ids[start : start + n] for ids, start, n in ((a_ids, a_from[group], n_a[group]), (b_ids, b_from[group], n_b[group]))]
            (i, n), (j, m) = (np.unique(side, return_counts=True) for side in own)
            parts.append(np.add.outer(i * self.width, j).ravel())
            counts.append(np.multiply.outer(n, m).ravel())
        return np.concatenate(parts), np.concatenate(counts), np.array([len(part) for part in parts])

    def _write(self, a_ids, b_ids, a_from, b_from, n_a, n_b, starts, last) -> None:
        """The groups of each chunk as text, each group with a semicolon behind it."""
        codes = np.empty(len(a_ids) + len(b_ids), np.int64)
        begin = a_from + b_from
        for ids, n, at, inside, closing in (
            (a_ids, n_a, begin, self.starts[0], self.starts[1]), (b_ids, n_b, begin + n_a, self.starts[2], self.starts[3])
        ):
            codes[_ranges(at, n)] = ids + inside
            codes[at + n - 1] += closing - inside
        words = list(map(self.written.__getitem__, codes.tolist()))
        bounds = np.append(begin, len(codes))
        for low, high in zip(bounds[starts].tolist(), bounds[last].tolist()):
            self.texts.append("".join(words[low:high]))


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of [start, start + length) one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def _counted(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their weights."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(weights, starts)


def _aligned(table: AlignedChunks, texts: list[str | None]):
    """(n_a, n_b, n_groups, n_links) and groups as text of each text, and (text, pair, times) of its distinct pairs."""
    split = [table.chunks(text) if text else [] for text in texts]
    table.learn(set(chain.from_iterable(split)))
    lengths = np.array([len(s) for s in split], np.int64)
    places = np.fromiter(map(table.places.__getitem__, chain.from_iterable(split)), np.int64, int(lengths.sum()))
    # A text with a chunk of other bytes is looked at whole, as one chunk that is not kept.
    sizes = table.sizes.data[: table.sizes.size]
    owners = np.repeat(np.arange(len(texts)), lengths)
    failed = np.unique(owners[sizes[places, 4] > 0])
    if len(failed):
        keep = ~np.isin(owners, failed)
        whole = []
        for text in failed:
            whole.append(len(table.texts))
            table.add([texts[text]], table.a.encode(" " + texts[text]), [table.b.model.encode(texts[text])])
        places, owners = np.concatenate([places[keep], whole]), np.concatenate([owners[keep], failed])
        order = np.argsort(owners, kind="stable")
        places, owners = places[order], owners[order]
        lengths = np.bincount(owners, minlength=len(texts))
        sizes = table.sizes.data[: table.sizes.size]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(sizes[places, :4], axis=0)])
    totals = sums[ends[1:]] - sums[ends[:-1]]
    listed, own = table.texts, places.tolist()
    bounds = ends.tolist()
    groups = ["".join(map(listed.__getitem__, own[a:b]))[:-1] for a, b in zip(bounds[:-1], bounds[1:])]
    held, times = _counted(owners * len(listed) + places, np.ones(len(places), np.int64))
    owners, places = np.divmod(held, len(listed))
    at = _ranges(sizes[places, 5], sizes[places, 6])
    owners, times = (np.repeat(x, sizes[places, 6]) for x in (owners, times))
    pairs = len(table.a.bytes) * table.width + table.width
    held, times = _counted(owners * pairs + table.pairs.data[at], times * table.times.data[at])
    return totals, groups, *np.divmod(held, pairs), times


def _blocks(a_path: str, b_path: str, keep: bool, block_pairs: int):
    def run(batches):
        from pyspark import TaskContext

        table = AlignedChunks(a_path, b_path)
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        for batch in batches:
            owners, texts = batch.column("id"), batch.column("text").to_pylist()
            start, waiting = 0, 0
            for place, text in enumerate(texts, 1):
                waiting += text.count(" ") + 1 if text else 0
                if waiting >= GROUP_CHUNKS or place == len(texts):
                    held.append((owners.slice(start, place - start), *_aligned(table, texts[start:place])))
                    start, waiting = place, 0
                    if sum(len(group[4]) for group in held) >= block_pairs:
                        yield _block(number, held, keep)
                        number, held = number + 1, []
        if held:
            yield _block(number, held, keep)

    return run


def _block(number: int, held: list[tuple], keep: bool) -> pa.RecordBatch:
    """The rows of a block's documents, and a last row with the block's distinct pairs."""
    firsts = np.cumsum([0] + [len(group[0]) for group in held])
    rows = int(firsts[-1])
    totals = np.concatenate([group[1] for group in held])
    texts = list(chain.from_iterable(group[2] for group in held))
    owners = np.concatenate([group[3] + first for group, first in zip(held, firsts)])
    pairs, at, documents = np.unique(np.concatenate([group[4] for group in held]), return_inverse=True, return_counts=True)
    times = np.concatenate([group[5] for group in held])
    offsets = np.append(np.searchsorted(owners, np.arange(rows + 1)), len(owners)).astype(np.int32)

    def lists(values, kind):
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))

    def last(values, kind):
        return pa.array([None] * rows + [values], pa.list_(kind))

    columns = {
        "block": pa.array(np.full(rows + 1, number), pa.int64()),
        "id": pa.chunked_array([group[0] for group in held] + [pa.nulls(1, held[0][0].type)]).combine_chunks(),
    }
    for n, name in enumerate(("n_a", "n_b", "n_groups", "n_links")):
        columns[name] = pa.array([*totals[:, n].tolist(), None], pa.int64())
    digests = [hashlib.sha256(text.encode()).hexdigest() if text else "" for text in texts]
    columns["groups_sha256"] = pa.array([*digests, None], pa.string())
    if keep:
        columns["groups"] = pa.array([*texts, None], pa.string())
    columns |= {
        "at": lists(at, pa.int32()), "times": lists(times, pa.int64()), "pairs": last(pairs, pa.int64()),
        "documents": last(documents, pa.int64()),
    }
    return pa.RecordBatch.from_pydict(columns)


def _totals(names: list[str]):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        at = answers.column("place").to_numpy()
        counts, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        counts[at], best[at] = answers.column("count").to_numpy(), answers.column("best").to_numpy().astype(np.int64)
        out = {name: docs.column(name) for name in names}
        places, times = (docs.column(c).combine_chunks() for c in ("at", "times"))
        ends = np.concatenate([[0], np.cumsum(places.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
        places, times = places.flatten().to_numpy(), times.flatten().to_numpy()
        for name, values in (("n_best", best), ("count_sum", counts)):
            sums = np.concatenate([[0], np.cumsum(values[places] * times)])
            out[name] = pa.array(sums[ends[1:]] - sums[ends[:-1]], pa.int64())
        return pa.table(out)

    return run


def align_documents(
    docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text", keep: bool = True,
    block_pairs: int = BLOCK_PAIRS,
) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best (links whose count is the highest of their A id),
    count_sum (over links), groups_sha256 and, if asked for, groups (``a1,a2|b1;a3|b2,b3``).

    A pair's count is the number of documents that hold it linked. ``block_pairs`` bounds what a task holds.
    """
    scratch = Scratch(docs.sparkSession)
    source = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"] + ["groups"] * keep
    kinds = f"id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string" + ", groups string" * keep
    written = scratch.put(
        source.mapInArrow(
            _blocks(a_path, b_path, keep, block_pairs),
            f"block long, {kinds}, at array<int>, times array<long>, pairs array<long>, documents array<long>",
        ),
        "aligned-blocks",
    )
    width = _piece_count(b_path)
    held = written.filter("pairs is not null").select(
        "block", F.posexplode(F.arrays_zip("pairs", "documents")).alias("place", "held")
    ).select("block", "place", F.col("held.pairs").alias("pair"), F.col("held.documents").alias("documents"))
    counts = scratch.put(held.groupBy("pair").agg(F.sum("documents").alias("count")), "aligned-counts")
    a_id = F.floor(F.col("pair") / F.lit(width)).alias("a_id")
    # One row per A id: the vocabulary bounds what is broadcast.
    highest = counts.groupBy(a_id).agg(F.max("count").alias("highest"))
    rated = counts.withColumn("a_id", a_id).join(F.broadcast(highest), "a_id").select(
        "pair", "count", (F.col("count") == F.col("highest")).alias("best")
    )
    answers = held.join(rated, "pair").select("block", "place", "count", "best")
    documents = written.filter("pairs is null").select(F.col("block").alias("block"), *names, "at", "times")
    aligned = documents.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _totals(names), f"{kinds}, n_best long, count_sum long"
    )
    columns = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"] + ["groups"] * keep
    return aligned.select(*columns).withColumnRenamed("id", id_column)


def _piece_count(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()
