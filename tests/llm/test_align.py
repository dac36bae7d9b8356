import hashlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from munimetrics.llm import align, queries

A, B = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")


def byte_characters():
    """From the vocabulary alone: the 256 entries of one character, told apart by what single bytes encode to."""
    return {c: b for c, b in align.byte_level_characters().items()}


def brute_force(rows):
    """Token by token in plain Python."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    characters, out, holds = byte_characters(), [], Counter()
    for name, text in rows:
        groups = []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            spelled_a = [bytes(characters[c] for c in a.id_to_token(i)) for i in ids_a]
            spelled_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
            if b"".join(spelled_a) == b"".join(spelled_b) == b" " + text.encode():
                ends_a, ends_b = np.cumsum([len(s) for s in spelled_a]).tolist(), np.cumsum([len(s) for s in spelled_b]).tolist()
                at_a = at_b = 0
                for end in sorted(set(ends_a) & set(ends_b)):
                    to_a, to_b = ends_a.index(end, at_a) + 1, ends_b.index(end, at_b) + 1
                    groups.append((ids_a[at_a:to_a], ids_b[at_b:to_b]))
                    at_a, at_b = to_a, to_b
        links = [(x, y) for own, other in groups for x in own for y in other]
        holds.update(set(links))
        out.append((name, groups, links))
    best = defaultdict(int)
    for (x, _), n in holds.items():
        best[x] = max(best[x], n)
    result = []
    for name, groups, links in out:
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        result.append(
            (name, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
             sum(holds[p] == best[p[0]] for p in links), sum(holds[p] for p in links),
             hashlib.sha256(told.encode()).hexdigest() if told else "")
        )
    return result, holds


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v if v is not None else 0) for v in r))


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_op12_against_token_by_token(spark, folder):
    docs = pd.read_parquet(f"{folder}/documents.parquet")
    want, _ = brute_force(list(zip(docs.doc_id.tolist(), docs.text)))
    got = queries.op12(spark, folder)
    assert got.columns == COLUMNS
    assert order(map(tuple, got.collect())) == order(want)


ODD = ["", None, "a", " a", "a ", "  two  spaces ", "line\nbreak\t tab", "<|endoftext|> <s> </s> <unk> <0x41>", "漢字かな 🙂🙂", "é é ﬁ ½", "▁mark",
       "İstanbul ALİ, GEL", "x" * 300, "3.14159 1,000", "a b", "\x01\x7f", "word word word", "word word word", "ab" * 4000, "‍", "Ω≈ç√ ∫˜µ≤"]


def test_edge_cases(spark):
    rows = [(n if n % 5 else None, t) for n, t in enumerate(ODD)] + [(7, "a"), (7, "a"), (8, "the long one " * 6000)]
    frame = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, chunk int, a string").repartition(3)
    got, pairs = align.align(frame, A, B, groups=True)
    want, holds = brute_force(rows)
    found = got.collect()
    assert order(tuple(r)[:-1] for r in found) == order(want)
    assert {(r.a, r.b): r.docs for r in pairs.collect()} == dict(holds)
    for r in found:
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "")
    assert align.align(frame.limit(0), A, B)[0].count() == 0
    assert align.align(frame.filter("text is null"), A, B)[0].count() == 1


@pytest.mark.parametrize("lane", [3, 50, 10**9])
def test_lanes_give_the_same_groups(lane):
    texts = pa.array([t for t in ODD] + ["some words, in a long line of text; " * 200])
    own, whole = align.Aligner(A, B).batch(texts, lane), align.Aligner(A, B).batch(texts)
    assert own["groups"] == whole["groups"] and (own["docs"] == whole["docs"]).all() and (own["multiple"] == whole["multiple"]).all()


def test_vector_drops_finished_documents():
    ends_a, ends_b = np.array([2, 4, 5, 6, 7, 9]), np.array([1, 4, 6, 8, 9])
    states = align.lanes(ends_a, ends_b, np.array([2, 4]), np.array([2, 3]))
    (groups,) = align.lockstep(ends_a, ends_b, states)
    assert sorted(zip(*(g.tolist() for g in groups))) == [(0, 2, 0, 2), (2, 4, 2, 3), (4, 6, 3, 5)]
    in_a, in_b = align.linked(*groups)
    assert sorted(zip(in_a.tolist(), in_b.tolist())) == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 2), (3, 2), (4, 3), (4, 4), (5, 3), (5, 4)]
