"""Spans of texts that look like secrets, by DataFrame functions alone.

Three base kinds are patterns: an assignment to a name such as ``token``, an access key, a long run of lower-case hex
digits. The others come from entropy: for each class of characters, every run of the class is a candidate, a window
slides over it one character at a time, and the counts of the window's characters change by the one that leaves and the
one that enters. Windows of high Shannon entropy merge into spans. Candidates on the allow-list are suppressed, as are
spans without both a letter and a digit and spans inside a base one.

Entropy is held exactly: with n the count of a character, the window's sum of n log2 n is kept as whole numbers of
2^-20 bits, so that no rounding depends on where a run begins.

How places are found: the text between the matches of a kind and the matches themselves have lengths, and a running sum
over a document's matches gives each one's place, in code points. Texts never leave their task; lengths and short spans
do, keyed by row. Work is in proportion to the text but for ``found`` spans in one run, whose list is copied as it grows.

Null and empty texts have no spans: zeros, the digest of an empty string, an empty list. Repeated rows and ids are scanned
each by itself, null ids are kept. Spans that start together are listed in the order of the base kinds and the classes. Very
long texts are one row. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The patterns of the base kinds. Java matches (?i) by ASCII letters.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the runs of [A-Z0-9] behind the first AKIA in them, of 20 characters or more in all
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6


class CharacterClass(NamedTuple):
    """Runs of ``alphabet`` are candidates; windows of ``width`` characters with ``bits`` of entropy are found."""

    name: str
    alphabet: str
    width: int
    bits: float


LETTERS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
CLASSES = (
    CharacterClass("entropy_hex", DIGITS + "abcdefABCDEF", 24, 3.0),
    CharacterClass("entropy_base64", DIGITS + LETTERS + LETTERS.upper() + "+/=_-", 24, 4.0),
)
BASE_KINDS = ("assign", "access", "hex")
BASE = len(BASE_KINDS)

# Candidates that are no secrets: identifiers of fixed form, digests of lock files, counting and placeholder strings.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^sha(1|256|384|512)[-=]",
    r"(?i)example|placeholder|changeme|your_|x{6,}",
    r"(?i)0123456789|abcdefghij|1234567890",
    r"^[a-z]+([-_/][a-z]+)*([-_/][0-9]{1,4})?$",
)
UNIT = 1 << 20


def scaled(count: int) -> int:
    """n log2 n in whole units."""
    return round(UNIT * count * math.log2(count)) if count > 1 else 0


def most_repetition(width: int, bits: float) -> int:
    """The sum of n log2 n, in units, up to which a window's entropy is ``bits`` or more: H = log2 W - sum / W."""
    return math.floor(UNIT * width * (math.log2(width) - bits))


def character_codes(run: Column, kind: CharacterClass) -> Column:
    """The places, from 1, of a run's characters in the class's alphabet."""
    return F.transform(F.split(run, ""), lambda c: F.instr(F.lit(kind.alphabet), c))


def windows_found(codes: Column, kind: CharacterClass) -> Column:
    """Start and end, from 0 and exclusive, of the merged windows of high entropy in a run, given as character codes."""
    width = kind.width
    tables = F.array(*[F.lit(scaled(n)).cast("long") for n in range(width + 1)])
    span = "struct<low:int,high:int>"
    # Each step has the code that enters and the one that leaves, 0 while the window fills.
    moves = F.slice(F.arrays_zip(
        codes.alias("entering"), F.concat(F.array_repeat(F.lit(0), width), codes).alias("leaving")
    ), F.lit(1), F.size(codes))
    start = F.struct(
        F.array_repeat(F.lit(0), len(kind.alphabet) + 1).alias("counts"),  # at 0, what leaves a window that is not full
        F.lit(0).cast("long").alias("sum"),
        F.lit(0).alias("size"),
        F.lit(0).alias("low"),
        F.lit(0).alias("high"),
        F.array().cast(f"array<{span}>").alias("spans"),
    )

    def step(state: Column, move: Column) -> Column:
        entering, leaving = move["entering"], move["leaving"]
        out = F.get(state["counts"], leaving)
        fewer = F.when(leaving > 0, F.get(tables, out - 1) - F.get(tables, out)).otherwise(F.lit(0).cast("long"))
        before = F.get(state["counts"], entering) - F.when(leaving == entering, 1).otherwise(0)
        total = state["sum"] + fewer + F.get(tables, before + 1) - F.get(tables, before)
        counts = F.transform(
            state["counts"],
            lambda n, k: n + F.when(k == entering, 1).otherwise(0) - F.when((k == leaving) & (k > 0), 1).otherwise(0),
        )
        size = state["size"] + 1
        first = size - width
        hit = (first >= 0) & (total <= most_repetition(width, kind.bits))
        apart = hit & (state["high"] > 0) & (first > state["high"])
        return F.struct(
            counts.alias("counts"),
            total.alias("sum"),
            size.alias("size"),
            F.when(hit & ((state["high"] == 0) | apart), first).otherwise(state["low"]).alias("low"),
            F.when(hit, size).otherwise(state["high"]).alias("high"),
            F.when(apart, F.concat(state["spans"], last(state))).otherwise(state["spans"]).alias("spans"),
        )

    def last(state: Column) -> Column:
        return F.array(F.struct(state["low"].alias("low"), state["high"].alias("high"))).cast(f"array<{span}>")

    def ended(state: Column) -> Column:
        return F.when(state["high"] > 0, F.concat(state["spans"], last(state))).otherwise(state["spans"])

    return F.aggregate(moves, start, step, ended)


def _gaps(text: Column, pattern: str, when: Column) -> Column:
    """The code points before, between and behind the matches of a pattern; null where ``when`` does not hold."""
    return F.when(when, F.transform(F.split(text, pattern, -1), lambda part: F.length(part)))


def _matches(text: Column, pattern: str, gaps: Column, value: int = 0) -> Column:
    """(gap, size, value) of each match: the code points between it and the match before, its own, and its group ``value``."""
    some = F.size(gaps) > 1
    runs = F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    values = F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(value))) if value else runs
    return F.transform(
        F.coalesce(F.arrays_zip(runs.alias("run"), values.alias("value")), F.array()),
        lambda match, at: F.struct(
            F.get(gaps, at).alias("gap"), F.length(match["run"]).alias("size"), match["value"].alias("value")
        ),
    )


def _class_pattern(kind: CharacterClass) -> str:
    return "[" + "".join("\\" + c if c in "-]^\\" else c for c in kind.alphabet) + f"]{{{kind.width},}}"


def _may_assign(lowered: Column) -> Column:
    """Whether a text can hold an assignment at all, so that the pattern runs over few texts."""
    named = [F.contains(lowered, F.lit(name)) for name in ("passw", "secret", "token", "apikey", "api_key")]
    return reduce(Column.__or__, named) & (F.contains(lowered, F.lit("=")) | F.contains(lowered, F.lit(":")))


def secret_spans(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", classes: Sequence[CharacterClass] = CLASSES,
    allowed: Sequence[str] = ALLOWED,
) -> DataFrame:
    """(row, id, kind, start, end): one row per span and one without kind per document, ``row`` being a number per document.

    ``kind`` is the place in the list of base kinds and classes; places are code points, the end exclusive.
    """
    given = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    patterns = [ASSIGN, ACCESS, HEX, *map(_class_pattern, classes)]

    def gaps(number: int) -> str:
        return f"gaps{number}"

    # Where the text has no run of all classes' characters, it has none of one class's or of hex digits.
    any_run = f"[{''.join(sorted({re.escape(c) for kind in classes for c in kind.alphabet} | set('0123456789abcdef')))}]"
    shortest = min([24, *[kind.width for kind in classes]])
    run = F.col("text").rlike(f"(?<!{any_run}){any_run}{{{shortest}}}")
    text = F.col("text")
    tested = (
        docs.select(F.col(f"`{id_column}`").alias("id"), given.alias("text"))
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("lowered", F.lower("text"))
        .select(
            "row", "id", "text", _may_assign(F.col("lowered")).alias("assigns"), F.contains(text, F.lit("AKIA")).alias("access"),
            run.alias("run"),
        )
        .select(
            "row", "id", "text", *[
                _gaps(text, pattern, F.col("assigns" if n == 0 else "access" if n == 1 else "run")).alias(gaps(n))
                for n, pattern in enumerate(patterns)
            ],
        )
    )
    lists = [_matches(text, pattern, F.col(gaps(n)), 2 if n == 0 else 0) for n, pattern in enumerate(patterns)]

    def listed(kind: int, matches: Column) -> Column:
        return F.transform(
            matches,
            lambda match, at: F.struct(
                F.lit(kind).alias("kind"), at.alias("at"), match["gap"].alias("gap"), match["size"].alias("size"),
                match["value"].alias("value"),
            ),
        )

    found = tested.select(
        "row", "id", F.explode_outer(F.concat(*[listed(k, matches) for k, matches in enumerate(lists)])).alias("match")
    ).select("row", "id", "match.*")
    value = F.col("value")
    good = F.when(F.col("kind") > 0, F.lit(True)).otherwise(F.length(value) >= LEAST_VALUE)
    whole = F.array(F.struct(F.lit(0).alias("low"), F.col("size").alias("high")))
    suspect = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    for pattern in allowed:
        suspect &= ~value.rlike(pattern)
    codes, spans = F.lit(None).cast("array<int>"), F.when((F.col("kind") < BASE) & good, whole)
    for number, kind in enumerate(classes, BASE):
        codes = F.when((F.col("kind") == number) & suspect, character_codes(value, kind)).otherwise(codes)
        inside = F.filter(
            windows_found(F.col("codes"), kind),
            lambda s: F.substring(value, s["low"] + 1, s["high"] - s["low"]).rlike("[0-9].*[A-Za-z]|[A-Za-z].*[0-9]"),
        )
        spans = F.when((F.col("kind") == number) & F.col("codes").isNotNull(), inside).otherwise(spans)
    # The running sum needs all matches of a kind; the texts of the candidates stay behind.
    sizes = found.withColumn("codes", codes).select("row", "id", "kind", "at", "gap", "size", spans.alias("spans"))
    so_far = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ends = F.sum(F.col("gap") + F.col("size")).over(so_far)
    placed = sizes.withColumn("first", ends - F.col("size")).select(
        "row", "id", "kind", F.explode_outer("spans").alias("span"), "first"
    )
    placed = placed.select(
        "row", "id", F.when(F.col("span").isNotNull(), F.col("kind")).alias("kind"),
        (F.col("first") + F.col("span.low")).alias("start"), (F.col("first") + F.col("span.high")).alias("end"),
    )
    # The longest base span that starts no later; base kinds come first among spans that start together.
    reach = F.max(F.when(F.col("kind") < BASE, F.col("end"))).over(
        Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        placed.withColumn("reach", reach)
        .withColumn("kind", F.when((F.col("kind") < BASE) | (F.col("end") > F.coalesce("reach", F.lit(0))), F.col("kind")))
        .select("row", "id", "kind", "start", "end")
    )


def scan_secrets(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", classes: Sequence[CharacterClass] = CLASSES,
    allowed: Sequence[str] = ALLOWED,
) -> DataFrame:
    """One row per document: id, n_assign, n_access, n_hex, base_sha256, spans (``kind:start:end``, by start, then kind)."""
    names = F.array(*[F.lit(name) for name in (*BASE_KINDS, *(c.name for c in classes))])
    spans = secret_spans(docs, id_column, text_column, classes, allowed)
    held = spans.groupBy("row").agg(
        F.first("id").alias("id"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{name}") for k, name in enumerate(BASE_KINDS)],
        F.array_sort(
            F.collect_list(F.when(F.col("kind").isNotNull(), F.struct("start", "kind", "end")))
        ).alias("found"),
    )

    def written(found: Column) -> Column:
        texts = F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
        return F.array_join(texts, ",")

    return held.select(
        F.col("id").alias(id_column), "n_assign", "n_access", "n_hex",
        F.sha2(written(F.filter("found", lambda s: s["kind"] < BASE)), 256).alias("base_sha256"),
        written(F.col("found")).alias("spans"),
    )
