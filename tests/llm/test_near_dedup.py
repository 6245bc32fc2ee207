import random

import numpy as np
import pytest

from blockstrata.llm import near_dedup
from blockstrata.llm.linking import components
from blockstrata.llm.words import CircularMinHash, shingle_sets, word_hashes
from helpers import brute_components, docs_table, shingles, words


def edited(rng, base, edits):
    w = list(base)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(w)


@pytest.mark.parametrize("paired", [8, 2])
def test_matches_all_pairs(spark, monkeypatch, paired):
    monkeypatch.setattr(near_dedup, "PAIRED", paired)
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(80))) for i in range(60)]
    base = [f"b{i}" for i in range(120)]
    rows += [(100 + i, edited(rng, base, rng.randrange(12))) for i in range(150)]
    rows += [(400 + i, "The same  TEXT\tagain and again") for i in range(40)]
    rows += [(500, None), (501, ""), (502, " \n\t"), (503, "one"), (504, "ONE"), (505, "two words")]
    rows.append((600, " ".join(f"long{i % 9000}" for i in range(30_000))))
    rng.shuffle(rows)
    got = near_dedup.near_duplicates(docs_table(spark, rows), shingle_words=4, block_shingles=3_000).collect()
    want = brute_components(rows, 4, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert len(got) == len(rows)


def test_repeated_rows_and_null_ids(spark):
    text = "five words in one text here"
    rows = [(3, text), (3, text), (None, text), (None, "a text of its own entirely"), (9, "other words that stand alone here")]
    got = near_dedup.near_duplicates(docs_table(spark, rows)).collect()
    seen = sorted(((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in got))
    assert seen == [(-1, -1, True), (-1, 3, False), (3, 3, True), (3, 3, True), (9, 9, True)]


def test_empty_table(spark):
    assert near_dedup.near_duplicates(docs_table(spark, [])).collect() == []


def test_hub_and_chain_components(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000), (None, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}


def test_word_hashes_see_the_same_words():
    texts = ["A b\x0bA\x0c\r\nb é\x85x", "", "  ", "\x1cq a"]
    hashes, offsets = word_hashes([t.encode() for t in texts])
    flat = [w for t in texts for w in words(t)]
    assert list(np.diff(offsets)) == [len(words(t)) for t in texts]
    assert [[a == b for b in flat] for a in flat] == [[a == b for b in hashes] for a in hashes]


def test_shingle_sets_have_the_right_sizes():
    texts = ["a b c d e a b c d e", "a b", "", "x y z w v"]
    assert [len(s) for s in shingle_sets([t.encode() for t in texts], 4)] == [len(shingles(t, 4)) for t in texts]


def test_signatures_estimate_jaccard():
    rng = np.random.Generator(np.random.PCG64(1))
    minhash = CircularMinHash(400)
    for share in (0.3, 0.6, 0.8):
        close = []
        for _ in range(30):
            pool = rng.integers(0, 2 ** 63, 600, dtype=np.uint64)
            both = int(300 * 2 * share / (1 + share))
            a, b = pool[:300], np.concatenate((pool[:both], pool[300:600 - both]))
            signature = minhash.signatures(minhash.place(np.concatenate((a, b))), np.array([0, 300]))
            close.append(np.mean(signature[0] == signature[1]))
        truth = both / (600 - both)
        assert abs(np.mean(close) - truth) < 0.02
        assert np.std(close) < 0.05
