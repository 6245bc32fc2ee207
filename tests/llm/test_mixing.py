import numpy as np
import pytest

from blockstrata.llm.mixing import fit_budget, mix_sources, source_targets
from helpers import docs_table, words


def brute_targets(sizes, weights, most):
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        share = {s: most * sizes[s] if s in full else rest * weight[s] / free for s in names}
        over = {s for s in names if s not in full and share[s] >= most * sizes[s]}
        if not over:
            return share
        full |= over


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1, "c": 10_000}, {"a": 5, "b": 900, "c": 7, "d": 3, None: 40},
    {"a": 10, "b": 0, "z": 3}, {"Z": 3, "a": 9, "é": 20, "\U00010000": 11, "￿": 12}])
def test_targets_match_the_repeated_sharing(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_targets(table, (5, 2, 1), 3).collect()}
    want = brute_targets(sizes, (5, 2, 1), 3)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_budget_is_met_exactly_where_it_can_be():
    rng = np.random.RandomState(3)
    for _ in range(60):
        lengths = np.unique(rng.randint(1, 60, 8))
        counts = rng.randint(1, 6, len(lengths))
        total = int((lengths * counts).sum())
        budget = rng.randint(0, total + 1)
        taken = fit_budget(lengths, counts, budget, window=10_000)
        assert ((taken >= 0) & (taken <= counts)).all()
        sums = {0}
        for size, n in zip(lengths, counts):
            sums = {s + k * size for s in sums for k in range(n + 1)}
        assert abs(int((taken * lengths).sum()) - budget) == min(abs(s - budget) for s in sums)


def test_documents_repeat_only_where_needed():
    taken = fit_budget([7, 10], [1, 1], 14, 1000, most=3)
    assert taken.tolist() == [2, 0]
    assert fit_budget([7, 10], [1, 1], 17, 1000, most=3).tolist() == [1, 1]
    assert fit_budget([7, 10], [2, 1], 14, 1000, most=3).tolist() == [2, 0]
    assert fit_budget([5], [2], 30, 1000, most=3).tolist() == [2]


def test_budget_near_with_a_small_window():
    lengths, counts = np.arange(1, 2001), np.full(2000, 50)
    for budget in (0, 1, 12_345, 50_000_000, int((lengths * counts).sum())):
        assert int((fit_budget(lengths, counts, budget, 100) * lengths).sum()) == budget


@pytest.fixture(scope="module")
def rows():
    rng = np.random.RandomState(1)
    out = [(i, "w " * int(rng.randint(1, 90)), "en", f"s{i % 4}" if i % 3 else "hot") for i in range(900)]
    out += [(2000 + i, "same five words right here", "en", "hot") for i in range(400)]
    out += [(3000, None, "en", "s1"), (3001, "", "en", None), (3002, "x " * 5000, "en", None), (None, "a b", "en", "s2"), (None, "a b", "en", "s2")]
    return out


def test_mixture_meets_its_targets(spark, rows):
    first = mix_sources(docs_table(spark, rows), bucket_rows=50).collect()
    again = mix_sources(docs_table(spark, rows[::-1]).repartition(5), bucket_rows=50).collect()
    key = lambda r: str(tuple(r))
    assert sorted(first, key=key) == sorted(again, key=key)
    assert len(first) == len(rows)
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    want, source_of = brute_targets(sizes, (5, 2, 1), 3), {r[0]: r[3] for r in rows}
    taken = dict.fromkeys(sizes, 0)
    for r in first:
        source = source_of[r["doc_id"]]
        assert r["source_size"] == sizes[source] and abs(r["target"] - want[source]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[source] += r["taken"]
    for source in sizes:
        largest = max(len(words(t)) for _, t, _, s in rows if s == source)
        assert abs(taken[source] - want[source]) <= (1 if source is not None else largest)


def test_empty_table(spark):
    assert mix_sources(docs_table(spark, [])).collect() == []
