"""Small tables and brute-force twins for the tests of this folder."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node long, component string, row string, hash long"


def docs_table(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    full = [(i, t, *(list(more) + ["en", "s"])[:2], None, None, "x", None, 7) for i, t, *more in rows]
    return spark.createDataFrame(full, DOCS)


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, n):
    w = words(text)
    if not w:
        return set()
    if len(w) < n:
        return {tuple(w)}
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def brute_components(rows, n, percent):
    """doc_id -> (set size, smallest reachable doc_id), over all pairs."""
    sets = {i: shingles(t, n) for i, t, *_ in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), root(i)) for i in sets}
