import gzip
import random
import zlib

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries as registered
from munimetrics.llm import archives, dac, packing, queries
from munimetrics.llm.files import members
from munimetrics.llm.tokens import TextEncoder

TEXTS = ["", "one two", " lead", "trail ", "a  b", "a   b", "x\n y", "x \ny", "tab\t t", "it's we'll DON'T", "ÀÉ ﬁ ß 漢字 🙂🙂 é", "3.14 1,000",
         "a b c", "\n\n", "end\n ", "w" * 300, "so… “quoted”—dash", " ", "x   y"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("plain", [False, True])
def test_chunks_encode_like_whole_texts(name, plain):
    whole, own = Tokenizer.from_file(queries.tokenizer_path(name)), TextEncoder(queries.tokenizer_path(name), plain, 40)
    whole.encode_special_tokens = plain
    docs = pd.read_parquet("/root/testdata/sf0.001/documents.parquet").text.str[:3000].tolist()
    signs = list("aAbzIi .,!?'\n\t  $1②éÉŉſİıǅΣςß漢ﬁ\u0301\u0307\u200d \x00\x1c\x85\xa0🙂<|>")
    signs += ["<|endoftext|>", "<|startoftext|>", " the ", " Hello,", "ALİ, GEL", "\n\n"]
    rng = random.Random(3)
    texts = [None] + TEXTS + docs + ["".join(rng.choices(signs, k=rng.randrange(14))) for _ in range(30_000)]
    for start in range(0, len(texts), 4000):  # several batches: later ones know words of earlier ones
        part = texts[start : start + 4000]
        ids, starts, ends = own.encode(pa.array(part, pa.string()))
        for text, s, e in zip(part, starts, ends):
            assert ids[s:e].tolist() == whole.encode(text or "", add_special_tokens=False).ids, text


@pytest.mark.parametrize("start", ["a", "é", "Б", "ß", "あ", "ع", "İ", "ǅ", "\u0345"])
def test_letters_of_many_blocks_before_every_sign(start):
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        own = TextEncoder(queries.tokenizer_path(name))
        texts = [f"{start}{chr(c)}{s} x" for c in range(ord(start), ord(start) + 60) for s in ".,;:!?%&*$#|'-"]
        ids, starts, ends = own.encode(pa.array(texts))
        assert [ids[s:e].tolist() for s, e in zip(starts, ends)] == [e.ids for e in own.tokenizer.encode_batch(texts)]


def test_files_follow_by_number(spark):
    names = [f"file:/x/part-{n:05d}-c000.txt" for n in (99_999, 100_000, 100_001, 10_001, 2)]
    frame = spark.createDataFrame([(n, 10**i) for i, n in enumerate(names)], "path string, tokens long")
    got = {r[0]: r[1] for r in frame.select("path", dac.tokens_before(F.col("path"), F.col("tokens"))).collect()}
    assert [got[n] for n in names] == [11_000, 11_001, 11_011, 10_000, 0]


def test_token_files_split_rows_without_identifier(spark):
    rows = [(None if n % 3 else n, f"text number {n % 50}") for n in range(600)]
    path = dac.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), queries.tokenizer_path("byte_bpe_50k.json"))
    got = dac.read_tokens(spark, path).collect()
    assert len(got) == 600 and sum(r.id is None for r in got) == 400
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    parts = [[i for s in dac.segments(r.content) for i in s.identifiers] for r in dac.read_files(spark, path).collect()]
    assert max(map(len, parts)) < 300


def whole_ids(folder, name, end):
    tokenizer = Tokenizer.from_file(queries.tokenizer_path(name))
    docs = pd.read_parquet(f"{folder}/documents.parquet").sort_values("doc_id")
    return {d: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [end], "<u4") for d, t in zip(docs.doc_id, docs.text)}


def check_packed(rows, want):
    covered, filled = {}, {}
    for r in rows:
        assert zlib.crc32(want[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(want[r.doc_id])
        covered.setdefault(r.doc_id, []).append((r.start, r.length))
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces, total in [(p, len(want[d])) for d, p in covered.items()] + [(p, None) for p in filled.values()]:
        at = 0
        for start, length in sorted(pieces):
            assert start == at and length > 0
            at += length
        assert at == total if total else at <= 2048
    assert covered.keys() == want.keys()
    return [sum(n for _, n in p) for p in filled.values()]


def test_op3_covers_every_token_once(spark, folder):
    sums = check_packed(queries.op3(spark, folder).collect(), whole_ids(folder, "word_bpe_49k.json", 1))
    assert sum(s < 2048 for s in sums) <= 1


def test_sum_of_squares_rule_against_trying_every_level():
    rng = np.random.default_rng(2)
    packer, level = packing.Packer(32), np.zeros(33, int)
    for number in range(600):
        size = int(rng.integers(1, 32))
        best = []
        for fill in range(0, 33 - size):
            if fill == 0 or level[fill]:
                tried = level.copy()
                tried[fill] -= fill > 0
                tried[fill + size] += fill + size < 32
                best.append(((tried**2).sum(), -fill, tried))
        level = min(best, key=lambda b: b[:2])[2]
        list(packer.put(number, np.zeros(size, "<u4").tobytes()))
        assert (packer.level == level).all()


def test_packing_edge_cases(spark):
    rows = [(1, None, 1), (2, "", 2), (2, "", 2), (None, "hello world", None), (3, "long text here " * 30_000, 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, length int")
    got = packing.pack(frame, queries.tokenizer_path("word_bpe_49k.json")).toPandas()
    assert got[got.id == 2].length.tolist() == [1, 1] and got[got.id == 3].length.sum() == 90_001
    assert packing.pack(frame.limit(0), queries.tokenizer_path("word_bpe_49k.json")).count() == 0
    assert [packing.padded_length(n) for n in (1, 3, 64, 2048)] == [1, 2048, 64, 2048]


def test_op8_round_trip(spark, folder):
    at = 0
    got = {r.doc_id: r for r in queries.op8(spark, folder).collect()}
    for d, ids in whole_ids(folder, "byte_bpe_50k.json", 2).items():
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_any_token_is_read_directly():
    rng = np.random.default_rng(6)
    for top in (1, 256, 60_000, 2**32):
        ids = rng.integers(0, top, 5000, dtype=np.uint64).astype("<u4")
        ends = np.array([0, 7, 1000, 5000])
        segment = dac.Segment(b"pad" + dac.encode_segment([5, None, 7, -8], ends, ids), 3)
        assert segment.identifiers == [5, None, 7, -8]
        for place in [0, 1, 511, 512, 513, 4999, *rng.integers(0, 5000, 50).tolist()]:
            assert segment.token(place) == ids[place]
        for start, end in [(0, 0), (0, 5000), (3, 4), (509, 1200), (4990, 5000)]:
            assert (segment.slice(start, end) == ids[start:end]).all()


def test_token_files_edge_cases(spark):
    rows = [(3, None, "x"), (1, "one", "x"), (None, "none", "x"), (1, "one", "x"), (2, "long " * 100_000, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, path string")
    path = dac.write_tokens(frame, queries.tokenizer_path("byte_bpe_50k.json"), segment_tokens=50)
    got = dac.read_tokens(spark, path).orderBy("start").collect()
    assert [r.id for r in got] == [None, 1, 1, 2, 3] and got[-1].n_tokens == 1
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    empty = dac.write_tokens(frame.limit(0), queries.tokenizer_path("byte_bpe_50k.json"))
    assert dac.read_tokens(spark, empty).count() == 0


def test_op6_against_sql(spark, folder):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    want = connection.execute(queries.SQL["op6_warc_archive"]).fetchall()
    got = queries.op6(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_archive_edge_cases(spark):
    page = "<p>" + "ä" * 60 + "\r\n\r\nWARC/1.1\n\n</p>"
    rows = [(4, "http://a b/\nc", page), (2, None, page), (9, "http://x/", page), (5, "u", None), (6, "u", ""), (7, "u", "short"), (8, "u", "short"),
            (None, "u", page), (3, "u", "y" * 2_000_000), (2, None, page)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = archives.read_warc(spark, archives.convert(spark, archives.write_arc(frame))).collect()
    assert len(got) == len(rows)
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in got if r.payload_bytes == len(page.encode())) == [
        (0, "revisit", 2), (2, "response", None), (2, "response", None), (4, "revisit", 2), (9, "revisit", 2)]
    assert {r.page_id: r.record_type for r in got if r.payload_bytes < 100} == dict.fromkeys((5, 6, 7, 8), "response")
    empty = archives.convert(spark, archives.write_arc(frame.limit(0)))
    assert archives.read_warc(spark, empty).count() == 0


def test_arc_lengths_and_versions_are_obeyed():
    for version in (1, 2):
        block = b"HTTP/1.1 200 OK\r\n\r\nline\n\nhttp://fake 0.0.0.0 20010101000000 text/html 9\n"
        data = archives.arc_head(version, "n") + archives._arc_record(version, "http://e/", "20010203040506", "text/html", block, "n") * 2
        found = list(archives.parse_arc(iter([data])))
        assert [(r.url, r.date, r.block) for r in found] == [("http://e/", "20010203040506", block)] * 2
        with pytest.raises(ValueError):
            list(archives.parse_arc(iter([data[:-5]])))
    assert archives.warc_date("20010203040506") == "2001-02-03T04:05:06Z" and archives.warc_date("20010203") == "2001-02-03T00:00:00Z"
    assert list(members(gzip.compress(b"a") + b"\0" + gzip.compress(b"") + b"\0\0")) == [b"a", b""]


def test_pipeline_stages_against_brute_force(spark, folder):
    import re

    from test_dedup import plain_groups, plain_print

    assert {"pipeline"} <= set(registered()) and "pipeline" not in oracle_sql() and len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    start = docs.toPandas()
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, folder))
        assert docs.columns == list(start.columns)
        kept[name] = set(docs.toPandas().doc_id)
    assert kept["language_id"] == set(start.doc_id)
    first = start.assign(k=start.text.map(lambda t: re.sub(r"[\x20\x09-\x0D]", "", t)), n=-start.text.str.len()).sort_values(["n", "doc_id"])
    assert kept["exact_dedup"] == set(first.drop_duplicates("k").doc_id)
    rows = [(d, plain_print(t)) for d, t in zip(start.doc_id, start.text) if d in kept["exact_dedup"]]
    assert kept["simhash_near_dedup"] == {d for d, g in plain_groups(rows) if d == g}
    bench = pd.read_parquet(f"{folder}/benchmark.parquet").text
    clean = {d for d, t in zip(start.doc_id, start.text) if not any(" ".join(b.lower().split()) in " ".join(t.lower().split()) for b in bench)}
    assert kept["decontaminate"] == kept["simhash_near_dedup"] & clean
    packed = corpus_pipeline.run(spark, folder).collect()
    ids = whole_ids(folder, "word_bpe_49k.json", 1)
    check_packed(packed, {d: ids[d] for d in kept["decontaminate"]})


def test_pipeline_stages_keep_rows_without_or_with_repeated_ids(spark, tmp_path):
    rng = np.random.default_rng(8)
    words = [" ".join(f"w{k}" for k in rng.integers(0, 5000, 60)) for _ in range(6)]
    rows = [(None, words[0]), (None, words[1]), (None, words[1]), (4, words[2]), (4, words[3]), (4, words[3] + " "), (5, words[2]),
            (None, words[2]), (None, words[4]), (6, words[5]), (None, words[5] + " ."), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.createDataFrame([(1, words[4])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    held = lambda df: sorted((r.doc_id or 0, (r.text or "").strip()) for r in df.collect())
    exact = corpus_pipeline.cut_lineage(corpus_pipeline.exact_stage(spark, docs, str(tmp_path)))
    assert held(exact) == sorted([(0, ""), (0, words[0]), (0, words[1]), (4, words[2]), (4, words[3]), (0, words[4]), (6, words[5]), (0, words[5] + " .")])
    assert exact.columns == docs.columns
    near = held(corpus_pipeline.near_stage(spark, docs.filter("text is not null"), str(tmp_path)))
    assert (0, words[5]) not in near and (6, words[5]) in near and (0, words[0]) in near and (0, words[1]) in near
    clean = held(corpus_pipeline.decontamination_stage(spark, exact, str(tmp_path)))
    assert clean == [r for r in held(exact) if r[1] != words[4]]


def test_language_stage_without_labels_keeps_texts_with_a_letter(spark, folder):
    rows = [(1, "words here", None), (2, "123 !?", None), (3, None, None), (4, "漢字", None)]
    kept = corpus_pipeline.language_stage(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), folder)
    assert {r.doc_id for r in kept.collect()} == {1, 4}
