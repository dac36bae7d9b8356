"""The operators bound to the benchmark tables, with the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from munimetrics.llm import archives, bytecnn, dac, decontam, exactdedup, lmscore, packing, quality, simhash, templates
from munimetrics.llm import align, chat, vectorcodes
from munimetrics.llm.common import crc_fold

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _bound(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query

    return add


def share_package(spark: SparkSession) -> None:
    """Let the session's Python workers import this package from where it lies, unless they have it installed."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (root, paths) if p)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@_bound("op1_simhash_near_dedup")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.near_duplicates(_table(spark, folder, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"), simhash.hexadecimal(F.col("print")).alias("fingerprint"), "component_id", "links"
    )


@_bound("op2_decontaminate")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    hits = decontam.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return hits.withColumnsRenamed({"id": "doc_id", "item": "item_id"})


@_bound("op3_pack_sequences")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(_table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@_bound(
    "op4_exact_dedup",
    r"""
    WITH plain AS (
        SELECT doc_id, coalesce(length(text), 0) AS points,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
        FROM documents
    ), owned AS (
        SELECT norm, count(*) AS group_size, first(doc_id ORDER BY points DESC, doc_id) AS keep_id
        FROM plain GROUP BY norm
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
    FROM plain JOIN owned USING (norm)
    """,
)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    rows = exactdedup.exact_duplicates(_table(spark, folder, "documents"))
    return rows.withColumnsRenamed({"id": "doc_id", "sha": "text_sha256"})


@_bound("op5_language_id")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = bytecnn.identify(docs.select("doc_id", "text"), bytecnn.fit(docs))
    return found.select(
        "doc_id", (crc_fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


@_bound(
    "op6_warc_archive",
    """
    WITH told AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
        FROM pages
    ), owned AS (
        SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS owner FROM told
    )
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN owner IS NULL OR owner = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN owner <> page_id THEN owner END AS refers_to
    FROM owned
    """,
)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    found = archives.read_warc(spark, archives.convert(spark, archives.write_arc(_table(spark, folder, "pages"))))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_bound("op8_token_files")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    path = dac.write_tokens(_table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return dac.read_tokens(spark, path).withColumnRenamed("id", "doc_id")


@_bound("op9_context_tree_score")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return lmscore.score(_table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@_bound("op10_quality")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    rows = quality.classify(docs, _table(spark, folder, "labels"))
    return rows.select(
        F.col("id").alias("doc_id"), (crc_fold(F.col("id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@_bound("op7_extract_text")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return templates.extract(_table(spark, folder, "pages")).withColumnRenamed("id", "page_id")


#: A conversation that says the control strings themselves; its number is that of no row.
PROBE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def _chat_sql() -> str:
    plain = "regexp_replace(coalesce({}, ''), '" + chat.DEFAULT.marked.pattern + "', '" + r"\1\2\\\3" + "', 'g')"
    probe = ", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in PROBE)
    return f"""
    WITH told AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT * FROM (VALUES {probe}) AS probe(conv_id, turn, role, text)
    ), joined AS (
        SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
               coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
               CAST(sum(length({plain.format("role")}) + length({plain.format("text")})) AS BIGINT) AS plain
        FROM told GROUP BY conv_id
    )
    SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
           {len(chat.BEGIN)} + {len(chat.OPEN + chat.CLOSE + chat.STOP)} * n_turns + plain AS formatted_chars
    FROM joined
    """


@_bound("op11_chat_format", _chat_sql())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(PROBE, rows.schema))
    return chat.read_back(chat.format_conversations(rows)).withColumnRenamed("id", "conv_id")


@_bound("op12_cross_tokenizer")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    rows, _ = align.align(_table(spark, folder, "documents"), *paths)
    return rows.withColumnRenamed("id", "doc_id")


def _codes_sql(parts: int = vectorcodes.PARTS, entries: int = vectorcodes.ENTRIES, rounds: int = vectorcodes.ROUNDS) -> str:
    """The rounds of assignment and averaging written out one after the other."""
    steps = [
        f"""WITH kept AS (
        SELECT vec_id, label, embedding FROM embeddings
        WHERE len(embedding) = (SELECT count(*) FROM (SELECT unnest(embedding) AS x) WHERE isfinite(x))
    ), spread AS (
        SELECT vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS i, len(embedding) // {parts} AS width FROM kept
    ), component AS MATERIALIZED (
        SELECT vec_id, i // width AS part, i % width AS position, CAST(floor({vectorcodes.SCALE} * x::DOUBLE) AS BIGINT) AS v FROM spread
    ), book0 AS MATERIALIZED (
        SELECT part, entry, position, v AS c FROM component JOIN (
            SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {entries}
        ) USING (vec_id)
    )"""
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""near{r} AS MATERIALIZED (
        SELECT vec_id, part, entry, d FROM (
            SELECT vec_id, part, entry, CAST(sum((v - c) * (v - c)) AS BIGINT) AS d
            FROM component JOIN book{r} USING (part, position) GROUP BY ALL
        ) QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1
    )"""
        )
        if r < rounds:
            steps.append(
                f"""book{r + 1} AS MATERIALIZED (
        SELECT part, entry, position, CAST(CASE WHEN n IS NULL THEN c ELSE (s - (s % n + n) % n) // n END AS BIGINT) AS c
        FROM book{r} LEFT JOIN (
            SELECT part, entry, position, sum(v) AS s, count(*) AS n
            FROM component JOIN near{r} USING (vec_id, part) GROUP BY ALL
        ) USING (part, entry, position)
    )"""
            )
    return ", ".join(steps) + f""", coded AS (
        SELECT vec_id, string_agg(lpad(to_hex(entry), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
        FROM near{rounds} GROUP BY vec_id
    )
    SELECT vec_id, lower(code) AS code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, position)) FROM book{rounds}) AS codebooks_sha256
    FROM coded JOIN kept USING (vec_id)
    """


@_bound("op13_vector_codes", _codes_sql())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = vectorcodes.compress(_table(spark, folder, "embeddings"))
    return vectorcodes.label_errors(coded).select(
        F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(vectorcodes.digest(books[-1]) if books else None).cast("string").alias("codebooks_sha256"),
    )
