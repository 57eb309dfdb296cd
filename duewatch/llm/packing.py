"""Documents packed into token sequences of bounded length, as few as can be found.

Each document becomes its token ids and an end id. One that is longer than a
sequence is cut into full pieces, the remainder being its first piece. A full
piece is a sequence. The others are packed by bin completion (see ``bins``) over
the number of pieces of each length: at most ``capacity - 1`` counts reach the
driver, whatever the corpus, and the plan has at most one filling per length that
it uses up. Spark numbers the pieces of each length, in slices so that a frequent
length is no single task, and a piece's number finds its place in the plan.

Null and empty texts are a single end id. Repeated rows and ids are packed each
by itself. Extra columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duewatch.llm.bins import fewest_bins
from duewatch.llm.scratch import Scratch
from duewatch.llm.tokens import ByteLevelIds

CAPACITY = 1024
END = 2
SLICE = 50_000


def _pieces(path: str, end: int, capacity: int):
    def run(batches):
        ids = ByteLevelIds(path)
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            owners, texts = batch.column("id"), batch.column("text").to_pylist()
            for begin in range(0, len(texts), 512):
                places, numbers, starts, parts = [], [], [], []
                for place, text in enumerate(texts[begin : begin + 512]):
                    data = ids.of(text or "") + last
                    head = (len(data) // 4) % capacity or capacity
                    cuts = [0, *range(4 * min(head, len(data) // 4), len(data), 4 * capacity)]
                    for number, cut in enumerate(cuts):
                        places.append(begin + place)
                        numbers.append(number)
                        starts.append(cut // 4)
                        parts.append(data[cut : cuts[number + 1] if number + 1 < len(cuts) else len(data)])
                yield pa.RecordBatch.from_arrays(
                    [owners.take(pa.array(places, pa.int64())), pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()),
                     pa.array([len(p) // 4 for p in parts], pa.int64()), pa.array(parts, pa.binary())],
                    names=["id", "piece", "start", "length", "ids"],
                )

    return run


def placements(counts: np.ndarray, capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, end number, first sequence, pieces per sequence, offset) rows for numbered pieces."""
    taken = np.zeros(capacity, np.int64)
    rows, sequence = [], 0
    for filling, times in fewest_bins(counts, capacity):
        offset = 0
        for size in dict.fromkeys(filling):
            per = filling.count(size)
            rows.append((size, int(taken[size]), int(taken[size]) + per * times, sequence, per, offset))
            taken[size] += per * times
            offset += per * size
        sequence += times
    return rows


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY,
    end: int = END, keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset and, if asked for, ids (binary,
    little-endian 32-bit)."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    source = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    cut = source.mapInArrow(
        _pieces(tokenizer_path, end, capacity), f"id {id_type}, piece int, start long, length long, ids binary"
    ).withColumn("ids_crc32", F.crc32("ids"))
    pieces = scratch.put(cut if keep_ids else cut.drop("ids"), "pieces")

    tallies = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}  # capacity rows at most
    counts = np.zeros(capacity, np.int64)
    for length, count in tallies.items():
        if length < capacity:
            counts[length] = count
    sequences = 0
    rows = placements(counts, capacity)
    for _, first, stop, start, per, _ in rows:
        sequences = max(sequences, start + (stop - first) // per)
    # Capacity bounds the plan: a filling per length at most, and lengths that differ in each.
    plan = spark.createDataFrame(rows, "length long, low long, high long, sequence long, per long, place long")

    slices = F.greatest(F.lit(1), F.ceil(F.col("count") / SLICE)).cast("int")
    # Full pieces are a sequence each; they are numbered like the others.
    sizes = pieces.groupBy("length").count().select("length", slices.alias("slices"))
    dealt = pieces.join(F.broadcast(sizes), "length").withColumn("slice", F.pmod(F.xxhash64("id", "piece"), F.col("slices")))
    tally = dealt.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tally.withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = Window.partitionBy("length", "slice").orderBy("id", "piece", "start")
    numbered = (
        dealt.withColumn("row", F.row_number().over(within) - 1).join(offsets, ["length", "slice"])
        .withColumn("number", F.col("row") + F.col("earlier"))
    )
    full = numbered.filter(F.col("length") >= capacity).select(
        *pieces.columns, (F.col("number") + sequences).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    step = F.col("number") - F.col("low")
    short = numbered.filter(F.col("length") < capacity).join(F.broadcast(plan), "length").filter(
        (F.col("number") >= F.col("low")) & (F.col("number") < F.col("high"))
    ).select(
        *pieces.columns, (F.col("sequence") + F.floor(step / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("place") + step % F.col("per") * F.col("length")).alias("offset"),
    )
    return full.unionByName(short).withColumnRenamed("id", id_column)
