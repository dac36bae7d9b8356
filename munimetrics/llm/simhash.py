"""SimHash near-dedup: fingerprints embedded as bit counts of segments, joined on a grid, then verified exactly.

The 64 bits are cut into 32 segments of two bits. A segment is embedded as its bit count 0, 1 or 2, kept in
thermometer code (00, 01, 11), so that the Manhattan distance of two embeddings is the number of differing
thermometer bits. That distance never exceeds the Hamming distance of the fingerprints. If it is at most three over
all segments, it is at most one over one of the two halves; the grid has one cell per count vector of a half, a
fingerprint stands in its own cell of either half and looks into the cells one step away.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from munimetrics.llm.common import byte_texts, cut_lineage
from munimetrics.llm.components import components

SHINGLE = 3
SEED = 42
RADIUS = 3
_BLOCK = 1 << 16
_LOW = 0x5555555555555555
_HALF = 0xFFFFFFFF


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of the word shingles of a text, as an unsigned number; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        starts, ends = [0], [len(joined)]
    else:
        stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        begins = np.concatenate(([0], stops[:-1] + 1))
        starts, ends = begins[: len(words) - shingle + 1].tolist(), stops[shingle - 1 :].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), _BLOCK):
        hashes = [digest(joined[s:e], seed) for s, e in zip(starts[at : at + _BLOCK], ends[at : at + _BLOCK])]
        bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(id, print)`` per row; ``print`` is the fingerprint as a signed long. Null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in byte_texts(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["id", "print"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"id {kind}, print long")


def thermometer(bits: Column) -> Column:
    """Per two-bit segment its bit count, as 00, 01 or 11."""
    high = F.shiftrightunsigned(bits, 1)
    low = F.lit(_LOW)
    return bits.bitwiseOR(high).bitwiseAND(low).bitwiseOR(F.shiftleft(bits.bitwiseAND(high).bitwiseAND(low), 1))


def _steps(cell: Column) -> Column:
    """The cell itself and those one step away: a thermometer bit flips, the code stays valid."""
    flips = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: cell.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    valid = F.filter(
        flips,
        lambda y: F.shiftrightunsigned(y, 1).bitwiseAND(F.bitwise_not(y)).bitwiseAND(F.lit(_LOW & _HALF)) == F.lit(0),
    )
    return F.concat(F.array(cell), valid)


def near_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs ``(a, b)``, ``a < b``, of the distinct fingerprints ``prints(print)`` that differ in at most ``radius`` bits.

    Complete for a radius up to three. A set of fingerprints all within three bits of each other has at most 128
    members, so a group of near copies cannot produce all its pairs.
    """
    if radius > 3:
        raise ValueError("the grid finds distances up to 3")
    embedded = prints.select("print", thermometer(F.col("print")).alias("code"))
    halves = F.array(
        F.struct(F.lit(0).alias("half"), F.col("code").bitwiseAND(F.lit(_HALF)).alias("cell")),
        F.struct(F.lit(1).alias("half"), F.shiftrightunsigned("code", 32).alias("cell")),
    )
    home = embedded.select("print", "code", F.inline(halves))
    home = cut_lineage(home)
    looks = home.select(
        F.col("print").alias("other"), F.col("code").alias("other_code"), "half", F.explode(_steps(F.col("cell"))).alias("cell")
    )
    close = (
        (F.bit_count(F.col("code").bitwiseXOR(F.col("other_code"))) <= radius)
        & (F.bit_count(F.col("print").bitwiseXOR(F.col("other"))) <= radius)
        & (F.col("print") < F.col("other"))
    )
    same = [home["half"] == looks["half"], home["cell"] == looks["cell"]]
    pairs = home.join(looks, same[0] & same[1] & close)
    return pairs.select(F.col("print").alias("a"), F.col("other").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """``(id, print, component_id, links)`` per row of ``docs``.

    ``component_id`` is the smallest identifier that can be reached over links of at most ``radius`` bits, equal
    fingerprints included; ``links`` counts the other fingerprints within the radius. A text without words (or
    null) has fingerprint zero and is linked like any other. Repeated rows give repeated rows. A null identifier
    never names a component unless its whole component has none. Empty tables give empty results. Only
    ``id_col`` and ``text_col`` are read, so other columns may have any name.
    """
    rows = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    prints = rows.groupBy("print").agg(F.min("id").alias("least"))
    links = cut_lineage(near_links(rows.select("print").distinct(), radius))
    roots = components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    known = (
        prints.join(roots, prints["print"] == roots["node"], "left")
        .select("print", "least", F.coalesce("root", "print").alias("root"))
        .join(degree, F.col("print") == degree["node"], "left")
        .select("print", "least", "root", F.coalesce("links", F.lit(0)).alias("links"))
    )
    known = cut_lineage(known)
    # Only components of several fingerprints need another look at their members.
    several = known.filter("links > 0").groupBy("root").agg(F.min("least").alias("component"))
    named = known.join(several, "root", "left").select(
        "print", F.coalesce("component", "least").alias("component_id"), "links"
    )
    return rows.join(named, "print", "left").select("id", "print", "component_id", "links")


def hexadecimal(prints: Column) -> Column:
    return F.lower(F.lpad(F.hex(prints), 16, "0"))
