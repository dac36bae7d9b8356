"""Corpus pipeline: language ID, exact dedup, near-dedup, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before has kept. All but the last return the
columns of ``documents``. Decisions name a row by its ``doc_id``, which may be null or repeated, and its normalised text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from munimetrics.llm import bytecnn, decontam, exactdedup, packing, queries, simhash
from munimetrics.llm.common import WHITE, cut_lineage


def _row(identifier: Column, sha: Column) -> Column:
    """What names a row; orders by identifier, rows without one come last."""
    return F.struct(identifier.isNull().alias("unnamed"), F.coalesce(identifier, F.lit(0)).alias("doc_id"), F.unhex(sha).alias("sha"))


def _keyed(docs: DataFrame) -> DataFrame:
    # A replacement works on the bytes; translate makes an object of every character.
    text = reduce(lambda t, white: F.replace(t, F.lit(white), F.lit("")), WHITE.decode(), F.coalesce(F.col("text"), F.lit("")))
    return docs.withColumn("_row", _row(F.col("doc_id"), F.sha2(text.cast("binary"), 256)))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which no language can be told (no text, no letter) go; the network learns from all folds.

    Without a labelled row there is no network: all texts that hold a letter stay.
    """
    queries.share_package(spark)
    network = bytecnn.fit(docs, held=-1)
    if network is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = bytecnn.identify(docs, network, lang_out="_language", score_out="_share")
    return found.filter(F.col("_language") != bytecnn.UNDETERMINED).select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original stays, then the smallest ``doc_id``; only rows that repeat both collapse."""
    queries.share_package(spark)
    kept = exactdedup.exact_duplicates(docs).filter("kept").select(_row(F.col("id"), F.col("sha")).alias("_row")).distinct()
    return _keyed(docs).join(kept, "_row", "left_semi").dropDuplicates(["_row"]).select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group linked by fingerprints the smallest ``doc_id`` stays."""
    queries.share_package(spark)
    rows = _keyed(docs)
    gone = simhash.near_duplicates(rows, "_row").filter("id <> component_id").select(F.col("id").alias("_row")).distinct()
    return rows.join(gone, "_row", "left_anti").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage aligned with a benchmark item go."""
    queries.share_package(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = _keyed(docs)
    gone = decontam.contaminated(rows, items, "_row").select(F.col("id").alias("_row")).distinct()
    return rows.join(gone, "_row", "left_anti").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence of 2048 tokens."""
    queries.share_package(spark)
    pieces = packing.pack(docs, queries.tokenizer_path("word_bpe_49k.json"))
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("decontaminate", decontamination_stage),
    ("pack", packing_stage),
]

#: The stages learn, fingerprint, align and pack: SQL cannot express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's rows are written to the shared folder and read again as the next one's."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
