"""Main texts of web pages after the removal of each site's template.

Every element subtree is hashed, and Spark counts per host beside how many
different texts a hash occurs: those of the rest of the main part (the article,
with those beside it, or main element with the most text, else the whole page). Subtrees beside at least ``LEAST_PAGES``
different texts, whatever share of a host's pages that is, are its template and
are deleted, within the main part too. A text of which most would go that way is an edited copy, and nothing of it
is deleted. Exact copies of a page are one text, however many there are. What is
left gives the text, without elements that are marked as menus, headers, footers,
sidebars, notices, adverts, forms or comments. Within an article, labels that may
name a section of it (see ``markup.SECTION_WORDS``) mark nothing.

Equal rows are dropped in every task before the shuffle, and counted by (host,
hash, text), so a host with a third of all pages spreads over all tasks. A page finds its template subtrees by a
join on (host, hash), of those only that lie in the part its text comes from; what menus and footers hold is counted but
needs no deletion. The pages themselves are shuffled once, compressed one by one.

Pages without html have an empty text. Pages without a url form one host. Rows
that repeat each other get the same text. Extra columns are not read.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duewatch.llm.markup import block_texts, deletable, digested_main, main_part, parsed, subtrees, template_of
from duewatch.llm.scratch import Scratch

LEAST_PAGES = 3  # with different texts


def _subtrees(batches):
    for batch in batches:
        pages, digests, beside, inside = [], [], [], []
        for place, text in enumerate(batch.column("html").to_pylist()):
            root = parsed(text or "")
            main = digested_main(root)
            own = subtrees(root, main)
            in_text = deletable(main or root, main is not None)
            pages.extend([place] * len(own))
            digests.extend(own)
            beside.extend(own.values())
            inside.extend(digest in in_text for digest in own)
        taken = pa.array(pages, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("key").take(taken), batch.column("host").take(taken), pa.array(digests, pa.int64()),
             pa.array(beside, pa.int64()), pa.array(inside, pa.bool_())],
            names=["key", "host", "digest", "beside", "inside"],
        )


def _packed(batches):
    for batch in batches:
        html = [zlib.compress((text or "").encode()) for text in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("page_id"), batch.column("url"), pa.array(html, pa.binary())],
            names=["key", "page_id", "url", "html"],
        )


def _texts(batches):
    for batch in batches:
        texts = []
        for packed, deleted in zip(batch.column("html").to_pylist(), batch.column("deleted").to_pylist()):
            root = parsed(zlib.decompress(packed).decode())
            own = set(deleted or ())
            main = digested_main(root) if own else main_part(root)
            if own:
                own = template_of(main or root, main is not None, own)
            texts.append("\n\n".join(block_texts(main or root, main is not None, own)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def main_texts(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
    least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """One row per page: id, url, text and n_chars."""
    scratch = Scratch(pages.sparkSession)
    source = pages.select(
        F.col(f"`{id_column}`").alias("page_id"), F.col(f"`{url_column}`").cast("string").alias("url"),
        F.col(f"`{html_column}`").cast("string").alias("html"),
    )
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    keyed = source.withColumn("host", host).withColumn("key", F.xxhash64("page_id", "url", "html"))
    found = scratch.put(
        keyed.select("key", "host", "html").mapInArrow(
            _subtrees, "key long, host string, digest long, beside long, inside boolean"
        ), "subtrees"
    )
    template = (
        found.filter("beside is not null").select("host", "digest", "beside").distinct()
        .groupBy("host", "digest").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_pages)
        .select("host", "digest")
    )
    deleted = scratch.put(
        found.filter("inside").join(template, ["host", "digest"]).groupBy("key").agg(F.collect_set("digest").alias("deleted")),
        "deleted",
    )
    scratch.drop(found)
    id_type = source.schema["page_id"].dataType.simpleString()
    packed = keyed.select("key", "page_id", "url", "html").mapInArrow(
        _packed, f"key long, page_id {id_type}, url string, html binary"
    )
    # The same plan at every size; the lists of a small table would be broadcast, those of a large one are too many for it.
    texts = packed.join(deleted.hint("merge"), "key", "left").select(
        "page_id", "url", "html", "deleted"
    ).mapInArrow(_texts, f"page_id {id_type}, url string, text string")
    return texts.select(
        F.col("page_id").alias(id_column), F.col("url").alias(url_column), "text", F.length("text").cast("long").alias("n_chars")
    )
