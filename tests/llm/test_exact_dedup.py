import hashlib
import re

import pytest

from blockstrata.llm.exact_dedup import chunk_pattern, exact_duplicates
from helpers import docs_table


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(plain(t), []).append((-len(t or ""), i is None, i))
    best = {k: min(v) for k, v in groups.items()}
    return sorted(((i, best[plain(t)][2], len(groups[plain(t)]), i == best[plain(t)][2],
                    hashlib.sha256(plain(t).encode()).hexdigest()) for i, t in rows), key=str)


ROWS = [(1, "A b."), (2, "Ab ."), (3, "A  b. "), (4, "ab."), (5, None), (6, ""), (7, " \n\x0b\x0c\r\t"), (8, "A b."), (8, "A b."),
        (9, "é"), (10, "é"), (11, "\xa0"), (12, "x. " * 9000), (13, "x." * 9000), (14, "x. " * 8999 + "y."),
        (15, "no end " * 5000), (16, "noend" * 5000), (None, "A b."), (None, "only here"), (17, "\U0001d49c 漢。" * 900)]


@pytest.mark.parametrize("bits", [64, 3])
def test_groups_match_brute_force(spark, bits):
    got = exact_duplicates(docs_table(spark, ROWS), least=8, most=64, hash_bits=bits).collect()
    assert sorted((tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in got), key=str) == brute(ROWS)


def test_empty_table(spark):
    assert exact_duplicates(docs_table(spark, [])).collect() == []


def test_chunks_cover_texts_and_follow_content():
    pattern = re.compile(chunk_pattern(4, 9))
    for text in ("", "abc", "one. two. three. four five six seven", "x" * 50, "ab. " * 20):
        assert "".join(pattern.findall(text)) == text
    a = pattern.findall("Some first words. Then the rest of it. And more follows here.")
    b = pattern.findall("Other. Then the rest of it. And more follows here.")
    assert a[-1] == b[-1]


def test_plan_has_no_python(spark):
    plan = exact_duplicates(docs_table(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan.replace("PythonRDD", ""))
