"""Benchmark search and token counts."""

import random

import pytest

from blockstrata.llm import decontamination
from blockstrata.llm.token_counts import MergeTable, count_tokens
from helpers import docs_table, shingles

rng = random.Random(4)
VOCAB = [f"w{i}" for i in range(4000)]
pick = lambda n: [rng.choice(VOCAB) for _ in range(n)]
ITEMS = [(i, " ".join(pick(rng.choice([6, 9, 14, 30, 60, 150])))) for i in range(60)]


def planted():
    rows = []
    for i in range(150):
        text = pick(rng.choice([20, 200, 3000]))
        if i % 3 == 0:
            item = rng.choice(ITEMS)[1].split()
            if i % 2:
                item[rng.randrange(len(item))] = "changed"
            at = rng.randrange(len(text))
            text[at:at] = [w.upper() for w in item]
        rows.append((i, "\n".join(text)))
    halves = ITEMS[7][1].split()
    rows.append((500, " ".join(halves[:len(halves) // 2 + 4] + pick(3000) + halves[len(halves) // 2:])))
    return rows + [(600, None), (601, ""), (602, "  "), (603, "w1"), (None, ITEMS[3][1]), (604, ITEMS[3][1]), (604, ITEMS[3][1])]


@pytest.mark.parametrize("block_bytes", [16_000_000, 5_000])
def test_search_matches_brute_force(spark, block_bytes):
    rows, items = planted(), ITEMS + [(900, None), (901, ""), (902, "W1"), (903, ITEMS[5][1])]
    table = spark.createDataFrame([(i, t, 1, 1.0) for i, t in items], "item_id long, text string, doc_id long, shared double")
    got = decontamination.find_items(docs_table(spark, rows), table, block_bytes=block_bytes).collect()
    want = []
    for d, text in rows:
        held = shingles(text, 5)
        for i, item in items:
            wanted = shingles(item, 5)
            shared = len(held & wanted)
            if wanted and 100 * shared >= 80 * len(wanted):
                want.append((d, i, shared, len(wanted), shared / len(wanted)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and len(want) > 30


def test_search_in_empty_tables(spark):
    table = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontamination.find_items(docs_table(spark, []), table).collect() == []
    assert decontamination.find_items(docs_table(spark, planted()[:5]), table.limit(0)).collect() == []


TEXTS = ["", None, " \n", "Hello world, it's 2024!!", "ΑΣ ΣΑΣ Straße İstanbul", "é é Å", "a\x1cb\x85c\xa0d", "aaaa" * 3000,
         "hi<|endoftext|>there <|startoftext|><|x|> <|", "漢字とかな \U0001f600\U0001f600", "don't WE'LL '’s", "x " * 30_000]


def test_counts_match_the_library(spark):
    tokenizers, places = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    path = places.path("word_bpe_49k.json")
    letters = "aabbcdeES'tll  \tΣσéß漢字😀½²3<|endoftext|>İ́!?.,"
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(400)]
    got = {r["doc_id"]: r for r in count_tokens(docs_table(spark, list(enumerate(texts)) + [(None, "x"), (0, "")]), path).collect()}
    library = tokenizers.Tokenizer.from_file(path)
    for i, text in enumerate(texts):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len((text or "").encode()), n > 2048), text
    assert count_tokens(docs_table(spark, []), path).collect() == []


def test_merges_match_a_plain_loop():
    letters = {b: chr(b) for b in range(97, 101)}
    merges = [("a", "b"), ("ab", "ab"), ("c", "c"), ("cc", "c"), ("a", "a"), ("abab", "d</w>"), ("b", "c"), ("d", "d</w>")]
    from blockstrata.llm.token_counts import byte_letters
    names = [c for c in byte_letters().values()]
    vocab = {n: i for i, n in enumerate(names + [n + "</w>" for n in names] + [a + b for a, b in merges])}
    table = MergeTable({"model": {"vocab": vocab, "merges": [list(m) for m in merges], "end_of_word_suffix": "</w>"}})

    def plain(word):
        parts = [*word[:-1], word[-1] + "</w>"]
        while True:
            found = [(merges.index(p), i) for i, p in enumerate(zip(parts, parts[1:])) if p in merges]
            if not found:
                return len(parts)
            _, i = min(found)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
    words = ["".join(rng.choice(list(letters.values())) for _ in range(rng.randint(1, 14))) for _ in range(500)] + ["c" * 9, "a" * 8]
    assert table.counts([w.encode() for w in words]).tolist() == [plain(w) for w in words]
    assert table.counts([]).tolist() == []
