"""Collocations against counting in plain Python."""

import random
import re
from collections import Counter

from blockstrata.llm.phrases import collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, n long, key string, size int, w string, parts string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "p", 1, "k", 2, "w", "x") for i, (t, lang) in enumerate(rows)], SCHEMA)


def brute(rows, least, longest, inside, most, scale):
    counts, words = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            words[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    counts[lang, tuple(w[i:i + k])] += 1
    good = {key: a for key, a in counts.items() if a >= least and len(key[1]) > 1}
    dropped = set()
    for (lang, long), n in good.items():
        for k in range(2, len(long)):
            for i in range(len(long) - k + 1):
                if 100 * n >= inside * good.get((lang, long[i:i + k]), n + 1):
                    dropped.add((lang, long[i:i + k]))
    out = set()
    for lang in words:
        scored = []
        for (own, p), a in good.items():
            if own == lang and (lang, p) not in dropped:
                cuts = [(scale * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:most], 1):
            out.add((lang, rank, p.decode(), -a, left, right, words[lang], -score))
    return out


def found(df, **kinds):
    got = [tuple(r) for r in collocations(df, **kinds).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_against_counting(spark):
    rnd = random.Random(11)
    vocabulary = ["New", "york", "the", "of", "größe", "ÉTÉ", "中文", "a|b", "x" * 300, "the", "The", "-", "it's", " ", " b"]
    phrases = ["New York city hall", "in spite of the", "big big big big", "zwei drei"]
    rows = []
    for i in range(500):
        parts = [rnd.choice(phrases) if rnd.random() < 0.3 else rnd.choice(vocabulary) for _ in range(rnd.randrange(0, 40))]
        text = "".join(p + rnd.choice([" ", "  ", "\t", ", ", "\n", ". ", " ", " ", ";", "\x0b", "\r\n"]) for p in parts)
        rows.append((text, rnd.choice(["en", "en", "de", None, "", "und", "language-with-a-long-name"])))
    rows += [("same row again, same row again", "en")] * 40 + [(None, "en"), ("", None), ("...,,,\n", "fr"), ("one", "it"), (None, None)]
    for kinds in ({"least": 30, "longest": 4, "inside_percent": 80, "most": 2000, "scale": 2_000_000},
                  {"least": 2, "longest": 3, "inside_percent": 50, "most": 7, "scale": 100},
                  {"least": 5, "longest": 6, "inside_percent": 100, "most": 2000, "scale": 10 ** 15}):
        got = found(table(spark, rows), **kinds)
        assert got == brute(rows, *kinds.values())
        assert got


def test_one_very_long_text(spark):
    text = "red green blue " * 60_000 + "x"
    rows = [(text, "en")]
    assert found(table(spark, rows)) == brute(rows, 30, 4, 80, 2000, 2_000_000)


def test_nothing_to_find(spark):
    assert found(table(spark, [])) == set()
    assert found(table(spark, [(None, None), ("", "en"), ("a b c", "en")])) == set()
