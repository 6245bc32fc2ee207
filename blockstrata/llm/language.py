"""Language of a text by cross-parsing it with suffix automata of labelled text."""

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .words import blocks

NOT_LETTERS = re.compile(r"[\W\d_]+")
MODEL = "lang string, letters string, moves binary, length long"
NO_LANGUAGE = "und"


def plain(text):
    """Lower-case letters of a text; each run of other characters is one space.
    Empty where there is no letter."""
    if not any(map(str.isalpha, text)):
        return ""
    return NOT_LETTERS.sub(" ", text.lower()).strip()


def automaton(text, letters):
    """Moves of the suffix automaton of ``text``: state x letter -> state, 0 for none.

    State 1 is the start. Column 0 stands for letters that are not known and
    leads nowhere.
    """
    known = {c: i for i, c in enumerate(letters, 1)}
    moves, link, length, last = [None, {}], [0, 0], [0, 0], 1
    for c in map(known.get, text):
        if c is None:
            last = 1
            continue
        if c in moves[last]:
            near = moves[last][c]
            if length[near] == length[last] + 1:
                last = near
                continue
        cur = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(1)
        p = last
        while p and c not in moves[p]:
            moves[p][c] = cur
            p = link[p]
        if p:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[cur] = copy
                if length[cur] == length[copy]:
                    cur = copy
        last = cur
    table = np.zeros((len(moves), len(letters) + 1), dtype=np.int32)
    for state, row in enumerate(moves[1:], 1):
        if row:
            table[state, list(row)] = list(row.values())
    return table


def phrases(pieces, known, moves):
    """Number of longest-match phrases of each piece (an array of code points).

    All pieces are parsed side by side, one letter of each at a time.
    """
    if not len(pieces):
        return np.zeros(0, dtype=np.int64)
    sizes = np.array([len(p) for p in pieces])
    order = np.argsort(-sizes, kind="stable")
    width, sizes = moves.shape[1], sizes[order]
    grid = np.zeros((int(sizes[0]), len(pieces)), dtype=np.uint16)
    for column, i in enumerate(order):
        grid[:sizes[column], column] = known[np.minimum(pieces[i], len(known) - 1)]
    flat, start = moves.reshape(-1), moves[1]
    state, count = np.ones(len(pieces), dtype=np.int32), np.ones(len(pieces), dtype=np.int64)
    live = np.searchsorted(-sizes, -np.arange(1, len(grid) + 1), side="right")
    for row, n in zip(grid, live):
        letter = row[:n]
        moved = flat[state[:n] * width + letter]
        stop = moved == 0
        fresh = start[letter]
        count[:n] += stop
        # A letter that the language lacks is a phrase of its own.
        state[:n] = np.where(stop, np.where(fresh == 0, 1, fresh), moved)
    out = np.empty(len(pieces), dtype=np.int64)
    out[order] = count
    return out


def _build(most):
    def run(group):
        group = group.sort_values(["draw", "doc_id"])
        text, used = [], 0
        for t in map(plain, group["text"]):
            if used >= most:
                break
            text.append(t)
            used += len(t) + 1
        text = " ".join(text)
        letters = "".join(sorted(c for c, n in Counter(text).most_common(120)))
        moves = automaton(text, letters)
        return pd.DataFrame({"lang": group["lang"].iloc[:1], "letters": [letters], "moves": [moves.tobytes()], "length": [len(text)]})
    return run


def train_languages(docs, most_rows=64, row_points=4_000, most_points=30_000, seed=11):
    """One model row per language: its letters and the moves of its automaton.

    Fits on a bounded sample of the rows with a language and at least one
    letter: of each language the ``most_rows`` rows of up to ``row_points`` code
    points with the smallest seeded hash, whole, until ``most_points`` code
    points are passed. A model has at most 2 * (most_points + row_points)
    states of at most 121 moves.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (F.char_length("text") <= row_points))
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text",
                       F.xxhash64("doc_id", "text", F.lit(seed)).alias("draw"))
    first = F.row_number().over(W.partitionBy("lang").orderBy("draw", "doc_id"))
    kept = rows.withColumn("place", first).where(F.col("place") <= most_rows).drop("place")
    return kept.groupBy("lang").applyInPandas(_build(most_points), MODEL).collect()


def _predict(model, piece):
    def run(batches):
        langs, tables = [], []
        for lang, letters, moves, length in model.value:
            known = np.zeros(max(map(ord, letters), default=0) + 2, dtype=np.uint16)
            known[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
            langs.append(lang)
            tables.append((known, np.frombuffer(moves, dtype=np.int32).reshape(-1, len(letters) + 1), np.log2(max(length, 2))))
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            found, scores = [NO_LANGUAGE] * len(texts), np.zeros(len(texts))
            for lo, hi in blocks(texts, 2_000_000):
                pieces, owner, sizes = [], [], np.zeros(hi - lo, dtype=np.int64)
                for i in range(lo, hi):
                    points = np.frombuffer(plain(texts[i]).encode("utf-32-le", "replace"), dtype=np.uint32)
                    sizes[i - lo] = len(points)
                    for at in range(0, len(points), piece):
                        pieces.append(points[at:at + piece])
                        owner.append(i - lo)
                if not pieces or not langs:
                    continue
                cost = np.stack([np.bincount(owner, phrases(pieces, known, moves), hi - lo) * bits for known, moves, bits in tables])
                cost /= np.maximum(sizes, 1)
                best = cost.argmin(axis=0)
                likely = np.exp2(cost.min(axis=0) - cost)
                share = 1 / likely.sum(axis=0)
                for i in np.flatnonzero(sizes):
                    found[lo + i], scores[lo + i] = langs[best[i]], share[i]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), pa.array(scores)],
                                             names=["doc_id", "lang_pred", "score"])
    return run


def identify_languages(docs, model, piece=1_000):
    """doc_id, lang_pred and score (0 to 1) of every row; ``model`` from train_languages.

    A text's letters are parsed from left to right into the longest phrases
    that occur in a language's labelled text; pieces of ``piece`` letters are
    parsed side by side, each from a new phrase. The language with the fewest
    phrases, times the bits that name a place in its labelled text, wins; ties
    go to the first by name. The score is its share when every bit per letter
    that another language needs more halves that one's weight. Null text, text
    without letters, and any text without a model: ``und``, score 0.
    """
    rows = sorted((tuple(r) for r in model), key=lambda r: r[0])
    rows = [(lang, letters, bytes(moves), length) for lang, letters, moves, length in rows]
    shared = docs.sparkSession.sparkContext.broadcast(rows)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _predict(shared, piece), "doc_id long, lang_pred string, score double")
