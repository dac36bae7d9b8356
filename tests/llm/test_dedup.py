import hashlib
import re
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash

from munimetrics.llm import exactdedup, queries, simhash
from munimetrics.llm.components import components
from munimetrics.llm.radixtrie import RadixTrie, better


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    """Smallest id by brute force over all pairs of fingerprints."""
    prints = np.array([p for _, p in rows], np.uint64)
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 3):
            a, b = sorted((top(i), top(int(j))))
            group[b] = a
    least = {}
    for i, (d, _) in enumerate(rows):
        least[top(i)] = min(d, least.get(top(i), d))
    return {(d, least[top(i)]) for i, (d, _) in enumerate(rows)}


def test_op1_against_brute_force(spark, folder):
    docs = pd.read_parquet(f"{folder}/documents.parquet")
    rows = [(d, plain_print(t)) for d, t in zip(docs.doc_id, docs.text)]
    got = queries.op1(spark, folder).collect()
    assert {(r.doc_id, r.fingerprint) for r in got} == {(d, f"{p:016x}") for d, p in rows}
    assert {(r.doc_id, r.component_id) for r in got} == plain_groups(rows)


def test_near_links_are_complete_on_clustered_prints(spark):
    rng = np.random.default_rng(5)
    prints = set()
    for centre in rng.integers(0, 1 << 63, 12, dtype=np.uint64):
        for _ in range(60):
            flips = rng.choice(64, rng.integers(0, 5), replace=False)
            prints.add(int(centre ^ np.uint64(sum(1 << int(b) for b in flips))))
    prints |= {0, 1, 7, 15, (1 << 64) - 1, (1 << 63) - 1}
    signed = sorted(p - (1 << 64) if p >= 1 << 63 else p for p in prints)
    got = {(r.a, r.b) for r in simhash.near_links(spark.createDataFrame([(p,) for p in signed], "print long")).collect()}
    want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert got == want and len(want) > 500


def test_near_duplicates_edge_cases(spark):
    shape = "doc_id long, text string, component_id string, print int, root int"
    rows = [(5, None, "x", 1, 1), (3, "", "x", 1, 1), (9, " \t", "x", 1, 1), (4, "one", None, None, None),
            (4, "one", None, None, None), (None, "one", None, None, None), (7, "word " * 200_000, "y", 2, 2)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, shape)).collect()
    assert len(got) == 7
    by = {r.id: r for r in got}
    assert by[5].component_id == by[9].component_id == by[3].component_id == 3 and by[3].print == 0
    assert by[None].component_id == by[4].component_id == 4
    assert simhash.near_duplicates(spark.createDataFrame([], shape)).count() == 0


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(1, 200)]
    star = [(1000, i) for i in range(1001, 1400)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 201)} | {i: 1000 for i in range(1000, 1400)}


def test_trie_owners_with_and_without_spilling():
    rng = np.random.default_rng(1)
    keys = [bytes(rng.integers(97, 100, rng.integers(0, 12)).astype(np.uint8)) for _ in range(3000)]
    want = {}
    for i, k in enumerate(keys):
        owner = (len(k) + i % 3, i, 1)
        want[k] = better(want[k], owner) if k in want else owner
    for budget in (1 << 30, 20_000, 900):
        trie = RadixTrie(budget)
        for i, k in enumerate(keys):
            trie.insert(k, (len(k) + i % 3, i, 1))
        assert bool(trie.spilled) == (budget < 1 << 30)
        assert dict(trie.items()) == want


def test_op4_against_brute_force(spark, folder):
    docs = pd.read_parquet(f"{folder}/documents.parquet")
    groups = {}
    for d, t in zip(docs.doc_id, docs.text):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), d))
    want = {
        (d, min(g)[1], len(g), d == min(g)[1], hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for _, d in g
    }
    got = {tuple(r) for r in queries.op4(spark, folder).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()}
    assert got == want


def test_exact_duplicates_edge_cases(spark):
    shape = "doc_id long, text string, sha string, owner int"
    rows = [(2, None, "a", 1), (1, "", "a", 1), (3, " \n", None, None), (8, "ä b", None, 1), (6, "äb", None, 1),
            (6, "äb", None, 1), (None, "äb", None, 1), (9, "x" * 3_000_000, None, None)]
    got = exactdedup.exact_duplicates(spark.createDataFrame(rows, shape)).collect()
    assert len(got) == 8
    assert {(r.id, r.keep_id, r.group_size, r.kept) for r in got} == {
        (2, 3, 3, False), (1, 3, 3, False), (3, 3, 3, True), (8, 8, 4, True), (6, 8, 4, False), (None, 8, 4, False),
        (9, 9, 1, True)}
    assert exactdedup.exact_duplicates(spark.createDataFrame([], shape)).count() == 0


def test_texts_leave_a_batch_in_slices():
    texts = [f"{n} " * 400 for n in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4000), pa.int64()), pa.array(texts)], ["id", "text"])
    tracemalloc.start()
    try:
        rows = sum(1 for _ in exactdedup._owners(batch))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 4000 and peak < batch.nbytes / 4
