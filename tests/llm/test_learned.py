"""Quality, language and language-model operators on small made-up corpora."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from blockstrata.llm import language, lm_scores, quality
from helpers import docs_table, words

rng = random.Random(8)
SYLLABLES = {"en": "the and ing tion er on th".split(), "de": "sch ung ein ver ich ü au".split(), "fr": "eau ou ré le que ç ai".split()}


def prose(lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


GOOD = [prose("en", 60) for _ in range(120)]
BAD = [" ".join(w.upper() + "!!" for w in t.split()) for t in GOOD[:20]] + [("buy " * 50) for _ in range(20)] + [t.replace(" ", " | ") for t in GOOD[20:40]]
CASES = [(9001, None), (9002, ""), (9003, " \n "), (9004, "\U0001f600 123 ²½ !!"), (9005, "the " * 40_000), (None, "the and"), (9006, "x"), (9006, "x")]


@pytest.fixture(scope="module")
def labelled(spark):
    texts = [(t, 1) for t in GOOD] + [(t, 0) for t in BAD]
    rows = [(i, t) for i, (t, _) in enumerate(texts)] + CASES
    labels = [(i, q, 0, "clash") for i, (_, q) in enumerate(texts) if i % 3] + [(None, 1, 0, ""), (1, None, 0, ""), (77_777, 1, 0, ""), (2, 7, 0, "")]
    return rows, texts, spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")


def test_quality_on_held_out_rows(spark, labelled):
    rows, texts, labels = labelled
    docs = docs_table(spark, rows)
    model = quality.train_quality(docs, labels)
    got = quality.score_quality(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    held = [(r["score"] >= 0.5) == bool(texts[r["doc_id"]][1]) for r in got if r["doc_id"] is not None and r["doc_id"] < 9000 and r["doc_id"] % 3 == 0]
    assert sum(held) >= 0.95 * len(held)
    assert len({r["score"] for r in got if r["doc_id"] == 9006}) == 1


def test_quality_without_labels_or_rows(spark, labelled):
    rows, _, labels = labelled
    docs = docs_table(spark, rows[:5])
    assert quality.train_quality(docs, labels.limit(0)) is None
    assert quality.train_quality(docs, labels.where("quality = 1")) is None
    assert {r["score"] for r in quality.score_quality(docs, None).collect()} == {0.5}
    model = quality.train_quality(docs_table(spark, rows), labels)
    assert quality.score_quality(docs_table(spark, []), model).collect() == []


def test_ratios_favour_the_class_that_has_the_gram():
    rows = [np.array([1, 2]), np.array([1, 3]), np.array([4, 2]), np.array([4, 3])] * 10
    weights, ratio, bias, slope, shift = quality.fit(rows, [1, 1, 0, 0] * 10)
    assert ratio[1] > 0 > ratio[4] and abs(ratio[2]) < 0.7
    margin = lambda r: weights[r].sum() / np.sqrt((ratio[r] ** 2).sum()) + bias
    assert slope * margin(rows[0]) + shift > 0 > slope * margin(rows[2]) + shift


def test_indicators_are_distinct_and_do_not_depend_on_neighbours():
    texts = [t.encode() for t in ("The the THE", "", "a", "x" * 5000, "The the THE")]
    together, alone = quality.indicators(texts), [quality.indicators([t])[0] for t in texts]
    for a, b in zip(together, alone):
        assert sorted(a) == sorted(b) and len(set(a.tolist())) == len(a)


def test_languages_on_held_out_rows(spark):
    rows = [(i, prose(lang, 5 + i % 50), lang, "s") for i in range(150) for lang in SYLLABLES]
    rows += [(i, t, "en", "s") for i, t in CASES] + [(9500, "the and", None, "s")]
    docs = docs_table(spark, rows)
    model = language.train_languages(docs.where("doc_id % 4 <> 2"))
    assert sorted(r["lang"] for r in model) == sorted(SYLLABLES)
    got = language.identify_languages(docs, model, piece=40).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    hits = Counter()
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] < 150 and r["doc_id"] % 4 == 2:
            hits[r["doc_id"], r["lang_pred"]] += 1
    total = 3 * len({k[0] for k in hits})
    assert sum(1 for k in hits if hits[k] >= 1) >= 0.95 * total
    assert {r["lang_pred"] for r in got if r["doc_id"] in (9001, 9002, 9003, 9004)} == {"und"}
    assert "und" not in {r["lang_pred"] for r in got if r["doc_id"] in (9005, 9500)}
    assert {r["lang_pred"] for r in language.identify_languages(docs, []).collect()} == {"und"}
    assert language.train_languages(docs_table(spark, [])) == []


def test_phrases_match_a_plain_parse():
    text = language.plain(prose("en", 300) + " " + prose("de", 30))
    letters = "".join(sorted(set(text) - {"z"}))
    moves = language.automaton(text, letters)
    known = np.zeros(max(map(ord, letters)) + 2, dtype=np.uint16)
    known[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
    pieces = [language.plain(prose(lang, 12)) for lang in ("en", "fr", "de") for _ in range(5)] + ["qqq", "é", text[50:200]]

    def brute(piece):
        count, run = 1, ""
        for c in piece:
            if run + c in text:
                run += c
            else:
                count, run = count + 1, c if c in text else ""
        return count
    got = language.phrases([np.frombuffer(p.encode("utf-32-le"), dtype=np.uint32) for p in pieces], known, moves)
    assert got.tolist() == [brute(p) for p in pieces]


def test_base_scores_match_brute_force(spark):
    rows = [(i, prose(rng.choice(list(SYLLABLES)), rng.randint(1, 40))) for i in range(300)] + CASES
    docs = docs_table(spark, rows)
    train = [r for r in rows if r[0] is not None and r[0] % 7 != 2]
    for common in (1 << 18, 3):
        model = lm_scores.train(docs.where("doc_id % 7 <> 2"), most_common=common)
        got = lm_scores.score(docs, model).collect()
        counts = Counter(w for _, t in train for w in [*words(t), None])
        total = sum(counts.values())
        want = []
        for i, t in rows:
            own = [*words(t), None]
            want.append((i, len(own), sum(counts[w] > 0 for w in own), total,
                         round(sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in own), 5)))
        assert sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got), key=str) == sorted(want, key=str)
    better = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 9000]
    assert sum(r["score"] for r in better) > sum(r["base_score"] for r in better)
    assert all(r["score"] <= 0 for r in got)


def test_shards_answer_where_partitions_are_not_merged(spark):
    rows = [(i, prose(rng.choice(list(SYLLABLES)), 30)) for i in range(60)]
    docs, counts = docs_table(spark, rows), Counter(w for _, t in rows for w in [*words(t), None])
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    merged = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        got = lm_scores.score(docs, lm_scores.train(docs, most_common=3, shard_tokens=200)).collect()
    finally:
        spark.conf.set(key, merged)
    texts, total = dict(rows), sum(counts.values())
    for r in got:
        own = [*words(texts[r["doc_id"]]), None]
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in own)
        assert r["n_known"] == r["n_tokens"] == len(own) and math.isclose(r["base_score"], base) and r["score"] > base


def test_filter_gives_levels_back():
    base, sizes = 1.6, [4096 * 8, 4096 * 8]
    hashes = lm_scores.mix(np.arange(1, 2001, dtype=np.uint64))
    counts = np.random.RandomState(1).zipf(1.6, 2000)
    shard, true = lm_scores._shards(hashes, 2), np.minimum(lm_scores.levels_of(counts, base), 255)
    segments = [lm_scores.filled(hashes[shard == s] & lm_scores.NAME, true[shard == s], 1, sizes[s], 3) for s in range(2)]
    held = lm_scores.CountFilter(b"".join(segments), sizes, 1, 3)
    got = held.levels(hashes)
    assert (got >= true).all() and (got == true).mean() > 0.95
    one = lm_scores.CountFilter(segments[1], sizes[1:], 1, 3)
    assert (one.levels(hashes[shard == 1] & lm_scores.NAME, 0) == got[shard == 1]).all()
    strangers = held.levels(lm_scores.mix(np.arange(10 ** 6, 10 ** 6 + 5000, dtype=np.uint64)))
    assert (strangers > 0).mean() < 0.06
    middle = lm_scores.middles(got, base)
    assert np.abs(np.log(middle / counts))[got == true].max() < math.log(2)


def test_packed_counts_round_trip():
    names = np.array([0, 5, 6, 4_000_000_000, 2 ** 63], dtype=np.uint64)
    counts = np.array([1, 255, 70_000, 3, 0])
    for p, c in ((names, counts), (names[:0], counts[:0]), (names[:2], counts[:2])):
        a, b, d = lm_scores._unpack(lm_scores._pack(p, c, c + 1))
        assert a.tolist() == p.tolist() and b.tolist() == c.tolist() and d.tolist() == (c + 1).tolist()


def brute_scores(train, rows, base, prior):
    """doc_id, tokens and score from exact counts in plain Python, pair counts quantised."""
    ones, pairs = Counter(), Counter()
    for _, t in train:
        own = ["<s>", *words(t), None]
        ones.update(own)
        pairs.update(zip(own, own[1:]))
    middle = lambda n: lm_scores.middles(lm_scores.levels_of(np.array([n]), base) * (n > 0), base)[0]
    total, distinct = sum(ones.values()) - len(train), len(ones) - 1
    out = []
    for i, t in rows:
        own = ["<s>", *words(t), None]
        out.append((str(i), len(own) - 1, sum(math.log10((min(middle(pairs[a, b]), ones[a]) + prior * (ones[b] + 1) / (total + distinct + 1)) / (ones[a] + prior))
                                              for a, b in zip(own, own[1:]))))
    return sorted(out)


def test_scores_match_brute_force(spark):
    rows = [(i, prose(rng.choice(list(SYLLABLES)), rng.randint(1, 60))) for i in range(200)] + CASES
    docs, train = docs_table(spark, rows), [r for r in rows if r[0] is not None and r[0] % 7 != 2]
    for kinds in ({}, {"most_bytes": 16, "most_common": 5, "shard_tokens": 500}, {"shard_tokens": 500}):
        model = lm_scores.train(docs.where("doc_id % 7 <> 2"), bits_per_entry=64, probes=12, **kinds)
        assert ("most_bytes" in kinds) == (0 in model.upper[1])
        got = sorted((str(r["doc_id"]), r["n_tokens"], r["score"]) for r in lm_scores.score(docs, model, block_bytes=5000).collect())
        want = brute_scores(train, rows, 1.6, 20.0)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want], rtol=1e-9)


def test_the_size_of_the_upper_filter_changes_no_score(spark):
    docs = docs_table(spark, [(i, prose("en", 50)) for i in range(200)])
    small, large = (lm_scores.train(docs, most_bytes=n, shard_tokens=2000) for n in (100, 10 ** 7))
    assert 0 in small.upper[1] and 0 not in large.upper[1] and len(small.upper[0]) < len(large.upper[0])
    a, b = (np.array([r["score"] for r in sorted(lm_scores.score(docs, m).collect(), key=lambda r: r["doc_id"])]) for m in (small, large))
    assert np.allclose(a, b, rtol=1e-12)


def test_chances_after_a_word_sum_to_one_within_the_quantising(spark):
    rows = [(i, prose("en", 40)) for i in range(100)]
    docs = docs_table(spark, rows)
    model = lm_scores.train(docs, bits_per_entry=64, probes=12)
    kinds = sorted({w for _, t in rows for w in words(t)})
    for before in kinds[:3]:
        texts = [(k, f"{before.decode()} {w.decode()}") for k, w in enumerate(kinds)] + [(len(kinds), before.decode()), (len(kinds) + 1, f"{before.decode()} neverseen")]
        got = {r["doc_id"]: r["score"] for r in lm_scores.score(docs_table(spark, texts), model).collect()}
        ones, pairs = Counter(), Counter()
        for _, t in rows:
            own = ["<s>", *words(t), None]
            ones.update(own)
            pairs.update(zip(own, own[1:]))
        lone = brute_scores(rows, texts, 1.6, 20.0)
        assert np.allclose([got[int(i)] for i, _, _ in lone], [s for _, _, s in lone], rtol=1e-9)
        middle = lambda n: lm_scores.middles(lm_scores.levels_of(np.array([n]), 1.6) * (n > 0), 1.6)[0]
        floor = sum(ones.values()) - len(rows) + len(ones)
        total = sum((min(middle(pairs[before, w]), ones[before]) + 20 * (ones[w] + 1) / floor) / (ones[before] + 20) for w in [*kinds, None])
        assert 1 / 1.6 ** 0.5 - 0.01 < total < 1.6 ** 0.5


def test_model_without_rows(spark):
    empty = docs_table(spark, [])
    model = lm_scores.train(empty)
    got = lm_scores.score(docs_table(spark, [(1, "a b"), (2, None)]), model).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got) == [(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)]
    assert lm_scores.score(empty, model).collect() == []
