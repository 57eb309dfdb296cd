"""SentencePiece ids of whole texts through a table of distinct marked words.

The library turns spaces into whitespace markers and puts one in front. No piece
of the model holds a marker after another character, so no piece crosses from a
word into the next, and the ids of a text are the ids of its marked words laid
end to end. Each task segments the distinct marked words it meets once, in one
call per batch of texts, and keeps ids and decoded text in its table; a text is
then joined from the table by position. A model with pieces that do cross is
refused. Words over LONGEST characters are segmented where they stand.

Null and empty texts have no ids and decode to an empty text. Repeated rows and
ids are encoded each by itself. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
MARKED = re.compile(f"{MARK}+[^{MARK}]*")
LONGEST = 64
CACHED_WORDS = 250_000  # a task's table is emptied beyond this; it is only a cache


class MarkedWords:
    """Entries (number of ids, ids as decimals joined by commas, decoded text) of marked words without their first mark."""

    def __init__(self, model: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        for piece in range(self.model.get_piece_size()):
            if MARK in self.model.id_to_piece(piece).lstrip(MARK):
                raise ValueError("the model has pieces that cross whitespace markers")
        # A mark with nothing behind it, at the end of a text; the library encodes an empty word as nothing.
        lone = self.model.encode("a ")[len(self.model.encode("a")) :]
        self.lone = len(lone), ",".join(map(str, lone)), ""
        self.table: dict[str, tuple[int, str, str]] = {}

    def split(self, text: str) -> list[str]:
        """The marked words of a text, each without its first mark, further marks being spaces."""
        if not text:
            return []
        if MARK not in text:
            words = text.split(" ")
            if "" not in words:
                return words
        return [word[1:].replace(MARK, " ") for word in MARKED.findall(MARK + text.replace(" ", MARK))]

    def learn(self, words: set[str]) -> None:
        if len(self.table) > CACHED_WORDS:
            self.table.clear()
        new = [word for word in words if word not in self.table and len(word) <= LONGEST]
        self.table.update(zip(new, self.segmented(new)))

    def segmented(self, words: list[str]) -> list[tuple[int, str, str]]:
        # The library puts the first mark back in front of each.
        ids = self.model.encode(words, num_threads=1) if words else []
        decoded = self.model.decode(ids, num_threads=1) if words else []
        return [
            (len(own), ",".join(map(str, own)), text) if word else self.lone for word, own, text in zip(words, ids, decoded)
        ]

    def entries(self, words: list[str]) -> list[tuple[int, str, str]]:
        found = [self.table.get(word) for word in words]
        return [entry or self.segmented([word])[0] for entry, word in zip(found, words)]


def _encoded(model: str, keep: bool):
    def run(batches):
        table = MarkedWords(model)
        for batch in batches:
            owners, texts = batch.column("id"), batch.column("text").to_pylist()
            for begin in range(0, len(texts), 128):
                split = [table.split(text or "") for text in texts[begin : begin + 128]]
                table.learn(set().union(*split))
                counts, ids, decoded = [], [], []
                for words in split:
                    entries = table.entries(words)
                    counts.append(sum(e[0] for e in entries))
                    ids.append(",".join([e[1] for e in entries]))
                    decoded.append(" ".join([e[2] for e in entries]))
                columns = {
                    "id": owners.slice(begin, len(split)),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in ids]),
                    "decoded_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded]),
                }
                if keep:
                    values = [np.fromstring(x, np.int32, sep=",") if x else np.empty(0, np.int32) for x in ids]
                    columns |= {"ids": pa.array(values, pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.string())}
                yield pa.RecordBatch.from_pydict(columns)

    return run


def encode_documents(
    docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text", keep: bool = True
) -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids and decoded."""
    source = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    extra = ", ids array<int>, decoded string" if keep else ""
    return source.mapInArrow(
        _encoded(model, keep), f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string{extra}"
    ).withColumnRenamed("id", id_column)
