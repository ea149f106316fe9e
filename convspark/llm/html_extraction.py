"""Main text of web pages: marked articles, and beyond them what a host's suffix array doesn't find repeated."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, stash, table
from .html_blocks import ARTICLE, OPEN, blocks

_STREAM = ["host", "s1", "s2"]


def host_of(url: Column) -> Column:
    """The host of an address, lower-cased; an address without one, or a null, is the empty host."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def _parsed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """A page with a marked article has its text; of any other, the blocks that the markup leaves open are candidates.
    Both have the stream of what stands outside an article."""
    for pages in batches:
        rows = []
        for html in pages:
            found = blocks(html)
            marked = any(part == ARTICLE for part, _ in found)
            rest = [(part, text) for part, text in found if part != ARTICLE]
            rows.append(("\n\n".join(text for part, text in found if part == ARTICLE) if marked else None, [text for _, text in rest], [part == OPEN and not marked for part, _ in rest]))
        yield pd.DataFrame(rows, columns=["article", "rest", "open"])


def _pages(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Pages with article, rest (blocks), open (which of them are candidates) and the key of their stream."""
    parse = F.pandas_udf(_parsed, "article string, rest array<string>, open array<boolean>")
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), parse(F.coalesce(html_col, F.lit(""))).alias("x")).select("page_id", "url", host_of(F.col("url")).alias("host"), "x.*")
    return p.withColumn("s1", F.xxhash64("rest", "open")).withColumn("s2", F.xxhash64(F.lit(1), "open", "rest"))


def repeated_tokens(streams: DataFrame, min_tokens: int = 8) -> DataFrame:
    """(host, s1, s2, at): tokens of streams (host, s1, s2, tokens) inside a substring of at least ``min_tokens`` tokens
    that another stream of the host has too.

    A suffix array of all hosts' streams by prefix doubling: suffixes are ranked by their first 1, 2, 4 ... tokens, as
    ranks of pairs of ranks, sorted over ranges; the host is the first thing that the order looks at. Suffixes whose first
    tokens no other stream of the host has leave after each step, as no longer run of theirs is repeated. Suffixes of equal
    rank in the end share ``min_tokens`` tokens (its longest common prefix with a neighbour in the array is that long),
    and every maximal repeated run is the union of such starts' windows. A host or token may hold any share of all rows:
    ranks are aggregated before they are sorted, and joined back to the suffixes.
    """
    if min_tokens & (min_tokens - 1):
        raise ValueError("min_tokens is a power of two")
    tokens = F.posexplode(F.transform("tokens", lambda t: F.struct(F.xxhash64(t).alias("a"), F.xxhash64(F.lit(1), t).alias("b"))))
    live = stash(streams.select(*_STREAM, tokens.alias("at", "t")).select(*_STREAM, "at", "t.a", "t.b"))
    size, key = 1, ["a", "b"]
    while True:
        of = F.struct("s1", "s2")
        shared = live.groupBy("host", *key).agg(F.min(of).alias("x"), F.max(of).alias("y")).where("x <> y").select("host", *key)
        ordered = stash(shared.repartitionByRange("host", *key).sortWithinPartitions("host", *key).withColumn("rank", F.monotonically_increasing_id()))
        live = live.join(ordered, ["host", *key]).select(*_STREAM, "at", "rank")
        if size == min_tokens:
            return live.select(*_STREAM, F.explode(F.sequence("at", F.col("at") + min_tokens - 1)).alias("at")).distinct()
        w = Window.partitionBy(*_STREAM).orderBy("at").rangeBetween(size, size)
        live = stash(live.withColumn("next", F.first("rank").over(w)).where("next IS NOT NULL").withColumnsRenamed({"rank": "a", "next": "b"}))
        size *= 2


def main_text(pages: DataFrame, min_tokens: int = 8, salts: int = 16, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of each page: page_id, url, text; blocks are joined by an empty line.

    Markup decides where it can: an element that is or names an article is the page's text, without the menus, headers,
    footers, sidebars, notices, adverts, forms and reader comments inside it (see ``html_blocks``), however often other
    pages repeat it, as copies and quotations are text. The rest of each page is its token stream. Streams that are the
    same on a host count once, so that copies of a page don't make it boilerplate. Of a page without a marked article, the
    blocks that no element marks as anything else are its text, but for what is covered by token runs which other streams
    of its host repeat (see ``uncovered``); what is left of a block is kept, in one piece. Pages of a host thus tell which wording is theirs.

    Null and empty html gives an empty text; a null address is a page of the host without a name; null ids, equal ids and
    repeated rows stay as they are; other columns are not looked at; an empty table gives an empty one. A page is parsed in
    time linear in its length, twice: once for its stream, once for its text, so that no text is written on the way.
    """
    small_batches(pages.sparkSession)
    parsed = _pages(pages, id_col, url_col, html_col)
    streams = parsed.where(F.size("rest") > 0).select(*_STREAM, "rest", "open")
    streams = stash(streams.groupBy(*_STREAM).agg(F.first("rest").alias("rest"), F.first("open").alias("open")))
    tokens = F.flatten(F.transform("rest", lambda t: F.split(t, " ")))
    covered = repeated_tokens(streams.select(*_STREAM, tokens.alias("tokens")), min_tokens)
    asks = streams.where(F.exists("open", lambda x: x)).select(*_STREAM)
    covered = stash(covered.join(asks, _STREAM, "left_semi").groupBy(*_STREAM).agg(F.array_sort(F.collect_list("at")).alias("covered")))
    # Copies of a page share a stream: they are dealt to several keys, and so is what is known of the stream.
    salted = covered.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    out = parsed.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int")).join(salted, [*_STREAM, "salt"], "left")
    return out.select("page_id", "url", F.coalesce("article", _kept(F.col("rest"), F.col("open"), F.col("covered"), min_tokens), F.lit("")).alias("text"))


def uncovered(words: list[str], covered: list[bool], min_tokens: int) -> list[str]:
    """A block's words without its covered runs of at least ``min_tokens``; a block that is covered whole goes. Shorter
    runs stay: a repeated run may reach a word or two into the text beside it by chance."""
    if all(covered):
        return []
    left: list[str] = []
    for gone, run in groupby(zip(words, covered), key=lambda x: x[1]):
        run = [w for w, _ in run]
        left += [] if gone and len(run) >= min_tokens else run
    return left


def _kept(rest: Column, is_open: Column, covered: Column, min_tokens: int) -> Column:
    """Open blocks without their covered tokens; where none is covered, the JVM joins them."""

    def left(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = []
            for found, flags, gone in zip(*batch):
                at, kept, gone = 0, [], set(() if gone is None else gone)
                for text, flag in zip(found, flags):
                    words = text.split(" ")
                    if flag:
                        kept.append(" ".join(uncovered(words, [k in gone for k in range(at, at + len(words))], min_tokens)))
                    at += len(words)
                texts.append("\n\n".join(t for t in kept if t))
            yield pd.Series(texts, dtype=object)

    whole = F.array_join(F.transform(F.filter(F.arrays_zip(rest.alias("t"), is_open.alias("o")), lambda x: x["o"]), lambda x: x["t"]), "\n\n")
    return F.when(covered.isNull(), whole).otherwise(F.pandas_udf(left, "string")(rest, is_open, covered))


def op11_html_extraction(spark, sf_dir):
    out = main_text(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
