"""Token ids by a byte-level BPE tokenizer, each distinct space-led word of a task being encoded once.

The words go through a compiled merge table made of the same file; its ids are those of the file's own library, which
encodes the texts that hold a special token.
"""

from __future__ import annotations

import json
import os
import re
import struct

import numpy as np

CACHED_WORDS = 400_000  # a worker's tables are emptied beyond this; they are only a cache
LONGEST = 64  # words beyond this are encoded anew each time

# A cut before a space that follows another character is always a cut between pre-tokens. Python's \s covers
# every character that the tokenizer may take for white space, so no run of white space is ever cut.
CUT = re.compile(r"(?<=\S)(?= )")
RUN = re.compile(r"\s ")


# Fixed value: how byte-level tokenizers of this kind cut a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable ones stand for themselves, the others for
    the characters from 256 on, in order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class ByteLevel:
    """Ids and their bytes by a byte-level BPE file whose ids follow the order of its merges."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        first = len(model["vocab"]) - len(merges) - len({t["content"] for t in spec["added_tokens"]} & set(model["vocab"]))
        plain = (
            model["type"] == "BPE" and spec["normalizer"] is None and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True) and not cut.get("add_prefix_space")
            and all(model["vocab"][token] == first + n for n, token in enumerate(merges))
        )
        if not plain:
            raise ValueError("the file is no plain byte-level BPE with ids in the order of its merges")
        letters, special = byte_characters(), {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(map(letters.__getitem__, t)): n for t, n in model["vocab"].items() if t not in special}
        # Without special tokens, so that their strings are plain text.
        self.encode = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.bytes = {n: token for token, n in ranks.items()}


class ByteLevelIds:
    """Ids as little-endian 32-bit values of whole texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.table = ByteLevel(path)
        self.words: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def of(self, text: str) -> bytes:
        if not text:
            return b""
        if any(token in text for token in self.special):
            return self.whole(text)
        if RUN.search(text):
            first, *rest = CUT.split(text)
            rest = [part[1:] for part in rest]
        else:
            first, *rest = text.split(" ")
        words = self.words
        if len(words) > CACHED_WORDS:
            words.clear()
        try:
            return self.encode(first) + b"".join(map(words.__getitem__, rest))
        except KeyError:
            missing = {word for word in rest if word not in words}
            found = dict(self.encoded(list(missing)))
            words.update((word, ids) for word, ids in found.items() if len(word) <= LONGEST)
            return self.encode(first) + b"".join([found[w] if w in found else words[w] for w in rest])

    def encoded(self, missing: list[str]):
        """Words with the ids they have behind a space."""
        yield from ((word, self.encode(" " + word)) for word in missing)

    def encode(self, chunk: str) -> bytes:
        ids = self.table.encode(chunk)
        return struct.pack(f"<{len(ids)}I", *ids)
