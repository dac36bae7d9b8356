"""HTML extraction by equivalence classes of tokens across the pages of a host.

Tokens are elements with their paths and stretches of text with theirs. Tokens that occur equally often on every page
of a host form an equivalence class; occurrence vectors are compared by a signature that Spark adds up over the pages,
so no task holds a host. Classes of some size that most pages share are valid: nested by their paths they are the
host's template, and what lies between their tokens are its slots. The innermost element of the template whose slots
hold the host's prose and headline is the main slot; all of its text is extracted, without the parts in it that stand
aside. Where a host has no template (one page, say), the page's own article, main part or body is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from munimetrics.llm.common import cut_lineage, rows_of
from munimetrics.llm.htmlwalk import Element, Text, judged

#: A class is valid with so many tokens that so large a share of the host's pages hold.
CLASS_TOKENS = 3
CLASS_PAGES = 0.5
#: Share of a host's prose, and of its headlines, that the main slot holds at least.
MAIN_SHARE = 0.8


def _hash(text: str) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(text.encode("utf-8", "replace"))).view(np.int64))


def _tokens(source: str) -> Iterator[tuple]:
    """``(kind, token, n, depth, size, headline, around)`` of a page: elements (kind 0) and text that is not aside (1)."""
    elements: dict[str, list] = {}
    texts: dict[tuple, int] = {}
    for part, aside in judged(source):
        if isinstance(part, Element):
            if not aside:
                held = elements.setdefault(part.path, [0, part.path.count("/"), part.name])
                held[0] += 1
        elif not aside:
            text = " ".join(part.text.split())
            if text:
                key = (tuple(e.path for e in part.stack), text, bool(part.stack) and part.stack[-1].name == "h1")
                texts[key] = texts.get(key, 0) + 1
    for path, (n, depth, name) in elements.items():
        rank = {"article": 2, "main": 1}.get(name, 0)
        yield 0, _hash(path), n, depth, rank, False, []
    for (paths, text, headline), n in texts.items():
        yield 1, _hash(f"{paths[-1] if paths else ''}\n{text}"), n, 0, n * len(text), headline, [_hash(p) for p in dict.fromkeys(paths)]


def main_slots(pages: DataFrame) -> DataFrame:
    """``(host, slot)`` from ``pages(host, key, html)``: the path hash of the element that holds the main text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "key", "kind", "token", "n", "depth", "size", "headline", "around"]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.list_(pa.int64())]
        for part in rows_of(batches, 64):
            rows = []
            for host, key, source in zip(*(c.to_pylist() for c in part.columns)):
                rows.append((host, key, 2, 0, 1, 0, 0, False, []))
                rows += [(host, key, *token) for token in _tokens(source or "")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    shape = "host string, key long, kind int, token long, n long, depth int, size long, headline boolean, around array<long>"
    rows = cut_lineage(pages.select("host", "key", "html").mapInArrow(run, shape))
    counts = rows.groupBy("host", "kind", "token").agg(
        F.count("*").alias("support"), F.sum("n").alias("total"), F.bit_xor(F.xxhash64("key", "n")).alias("vector"),
        F.max("depth").alias("depth"), F.max(F.when(F.col("kind") == 0, F.col("size"))).alias("rank"),
    )
    of_host = counts.filter("kind = 2").select("host", F.col("support").alias("pages")).filter("pages > 1")
    tokens = cut_lineage(
        counts.filter("kind < 2 AND support > 1").join(of_host, "host").filter(F.col("support") >= CLASS_PAGES * F.col("pages"))
    )
    classes = tokens.groupBy("host", "support", "vector").agg(F.count("*").alias("tokens")).filter(F.col("tokens") >= CLASS_TOKENS)
    template = cut_lineage(tokens.join(classes, ["host", "support", "vector"]))
    constant = template.filter("kind = 1").select("host", "token")
    slots = rows.filter("kind = 1").join(constant, ["host", "token"], "left_anti").select(
        "host", "size", F.when(F.col("headline"), 1).otherwise(0).alias("headline"), F.explode(F.concat("around", F.array(F.lit(0).cast("long")))).alias("element")
    )
    prose = cut_lineage(slots.groupBy("host", "element").agg(F.sum("size").alias("size"), F.sum("headline").alias("headlines")))
    whole = prose.filter("element = 0").select("host", F.col("size").alias("all_size"), F.col("headlines").alias("all_headlines"))
    once = template.filter("kind = 0 AND total = support").select("host", F.col("token").alias("element"), "depth", "rank")
    fit = once.join(prose, ["host", "element"]).join(whole, "host").filter(
        (F.col("size") >= MAIN_SHARE * F.col("all_size")) & (F.col("headlines") >= MAIN_SHARE * F.col("all_headlines"))
    )
    return fit.groupBy("host").agg(F.max_by("element", F.struct("rank", "depth", "element")).alias("slot"))


def main_text(source: str, slot: int | None) -> str:
    """The blocks of the main part of a page, one per line."""
    parts = judged(source)
    chosen: set[int] = set()
    for wanted in (lambda e: slot is not None and _hash(e.path) == slot, lambda e: e.name == "article", lambda e: e.name == "main", lambda e: e.name == "body"):
        chosen = {p.number for p, aside in parts if isinstance(p, Element) and not aside and wanted(p)}
        if chosen:
            break
    blocks: dict[int, list[str]] = {}
    for part, aside in parts:
        if isinstance(part, Text) and not aside:
            if not chosen or any(e.number in chosen for e in part.stack):
                blocks.setdefault(part.block, []).append(part.text)
    lines = (" ".join("".join(b).split()) for _, b in sorted(blocks.items()))
    return "\n".join(line for line in lines if line)


def host_of(url):
    """Host of an address in lower case, without port and credentials; null and malformed addresses share one."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, text, n_chars)`` per row of ``pages``.

    A null page has an empty text; a null address belongs to the host of those without one. Repeated rows count as
    pages of their own and give repeated rows. Text that pages share is kept if it stands in the main part. White
    space of a block, of any kind, becomes one space; a line break tag is white space. An empty table gives none.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).withColumn("host", host_of(F.col("url")))
    keyed = rows.withColumn("key", F.xxhash64("id", "url"))
    slots = cut_lineage(main_slots(keyed))
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows_of(batches, 256):
            texts = [main_text(s or "", slot) for s, slot in zip(part.column("html").to_pylist(), part.column("slot").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["id", "url", "text", "n_chars"],
            )

    joined = rows.join(slots, "host", "left").select("id", "url", "html", "slot")
    return joined.mapInArrow(run, f"id {kind}, url string, text string, n_chars long")
