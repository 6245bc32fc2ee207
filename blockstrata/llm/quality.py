"""Text quality by support vectors on naive Bayes features."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from .words import SPACES, blocks, mix, texts_of, word_hashes

#: Buckets of hashed n-grams; the model is this many numbers.
BUCKETS = 1 << 18
MODEL = "weights binary, bias double, slope double, shift double"

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[65:91] = 1
_KIND[97:123] = 2
_KIND[48:58] = 3
_KIND[128:] = 2
_KIND[[ord(c) for c in ".,;:'\"()?-"]] = 4
_KIND[[c for c in range(33, 127) if _KIND[c] == 0]] = 5


def _grams(texts):
    """Bucket of every n-gram of a block of texts and the text that holds it.

    N-grams are of three kinds: three bytes of the text, one and two words, and
    one to four word shapes. A shape is the set of character kinds of a word,
    how it begins, and whether it repeats the word before it.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(sizes)
    wide = data.astype(np.uint32)
    chars = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:] if len(data) > 2 else wide[:0]
    chars = (chars * np.uint32(0x9E3779B1)) >> np.uint32(14)
    char_owner = np.repeat(np.arange(len(texts)), sizes)[:len(chars)]
    inner = np.ones(len(data), dtype=bool)
    inner[ends - 1] = False
    inner = inner[:-2] & inner[1:-1] & inner[2:] if len(data) > 2 else inner[:0]

    words, offsets = word_hashes(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    gap = SPACES[data]
    starts = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
    shape = np.zeros(len(words), dtype=np.uint64)
    if len(words):
        kinds = (np.uint8(1) << _KIND[data]).astype(np.uint8)
        kinds[gap] = 0
        shape = np.bitwise_or.reduceat(kinds, starts).astype(np.uint64) * np.uint64(8) + _KIND[data[starts]].astype(np.uint64)
        same = np.concatenate(([False], (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])))
        shape = shape * np.uint64(2) + same
    buckets, owners = [chars[inner]], [char_owner[inner]]
    for values, longest, salt in ((words, 2, 11), (mix(shape), 4, 23)):
        run = values
        for n in range(1, longest + 1):
            if n > 1:
                run = run[:-1] * np.uint64(0xA24BAED4963EE407) + values[n - 1:] if len(run) else run
            whole = owner[:len(run)] == owner[n - 1:] if n > 1 else np.ones(len(run), dtype=bool)
            buckets.append((mix(run[whole] + np.uint64(salt * n)) >> np.uint64(46)).astype(np.uint32))
            owners.append(owner[:len(run)][whole])
    return np.concatenate(buckets), np.concatenate(owners)


def indicators(texts):
    """Distinct n-gram buckets of a block of texts, by text: (buckets, offsets)."""
    buckets, owners = _grams(texts)
    order = np.argsort(owners, kind="stable")
    buckets, cuts = buckets[order], np.searchsorted(owners[order], np.arange(len(texts) + 1))
    stamp, out = np.zeros(BUCKETS, dtype=np.int32), []
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        own = buckets[lo:hi]
        place = np.arange(len(own), dtype=np.int32)
        stamp[own] = place
        out.append(own[stamp[own] == place])
    return out


def fit(rows, labels, regular=0.1, rounds=12, seed=3):
    """Weights of log-count ratios times support vectors, bias, and a logistic scale.

    ``rows``: distinct buckets of each text; ``labels``: 0 or 1. A row's
    indicators are scaled by the ratios and to length one. One row in five is
    left out of the fit and gives the scale that turns margins to scores.
    """
    labels = np.asarray(labels)
    held = np.random.RandomState(seed).permutation(len(rows)) % 5 == 0
    if len(set(labels[held])) < 2 or len(set(labels[~held])) < 2:
        held[:] = False
    counts = {c: np.ones(BUCKETS) for c in (0, 1)}
    for row, label, out in zip(rows, labels, held):
        if not out:
            counts[label][row] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    used = np.flatnonzero(~held)
    values = [ratio[r] for r in rows]
    norms = [max(float(np.sqrt(v @ v)), 1e-9) for v in values]
    weights, bias, alpha = np.zeros(BUCKETS), 0.0, np.zeros(len(rows))
    share = labels[used].mean()
    cost = {1: regular / max(share, 1e-9) * 5, 0: regular / max(1 - share, 1e-9) * 5}
    draw = np.random.RandomState(seed + 1)
    for _ in range(rounds):
        for i in draw.permutation(used):
            y = 1.0 if labels[i] else -1.0
            x = values[i] / norms[i]
            slope = y * (weights[rows[i]] @ x + bias) - 1.0
            new = min(max(alpha[i] - slope / 2.0, 0.0), cost[int(labels[i])])
            if new != alpha[i]:
                weights[rows[i]] += (new - alpha[i]) * y * x
                bias += (new - alpha[i]) * y
                alpha[i] = new
    weights = weights * ratio
    judged = np.flatnonzero(held) if held.any() else used
    margins = np.array([weights[rows[i]].sum() / norms[i] + bias for i in judged])
    slope, shift = _scale(margins, labels[judged])
    return weights.astype(np.float32), ratio.astype(np.float32), bias, slope, shift


def _scale(margins, labels, steps=200):
    """Logistic scale of margins (Platt), by damped Newton steps."""
    a, b = 1.0, 0.0
    good = labels == 1
    target = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([((p - target) * margins).sum() + 1e-3 * (a - 1), (p - target).sum()])
        h = p * (1 - p)
        m = np.array([[(h * margins * margins).sum() + 1e-3, (h * margins).sum()], [(h * margins).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(m, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(float(a), 1e-3), float(b)


def _train(frames):
    frames = [f for f in frames if len(f)]
    if not frames:
        return
    frame = pd.concat(frames).sort_values("doc_id", kind="stable")
    texts = [b"" if t is None else t.encode() for t in frame["text"]]
    rows = []
    for lo, hi in blocks(texts):
        rows.extend(indicators(texts[lo:hi]))
    labels = frame["quality"].to_numpy()
    if len(set(labels)) < 2:
        return
    weights, ratio, bias, slope, shift = fit(rows, labels)
    yield pd.DataFrame({"weights": [np.concatenate([weights, ratio]).tobytes()], "bias": [bias], "slope": [slope], "shift": [shift]})


def train_quality(docs, labels, max_rows=6_000, max_points=30_000, seed=5):
    """Model row (weights, bias, slope, shift), or None if a class is missing.

    Fits on a bounded sample: of the labelled documents of at most
    ``max_points`` code points, the ``max_rows`` with the smallest seeded hash
    of doc_id. Ids come from ``labels`` (doc_id, quality), so only these
    documents' texts move, to one task. Rows with a null or other quality are
    left out; of several labels for an id the larger counts.
    """
    ids = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    ids = ids.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    ids = ids.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(max_rows)
    texts = docs.where(F.coalesce(F.char_length("text"), F.lit(0)) <= max_points).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = texts.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])
    return sample.select("doc_id", "text", "quality").coalesce(1).mapInPandas(_train, MODEL).first()


def _score(model):
    def run(batches):
        if model is not None:
            both = np.frombuffer(model.value[0], dtype=np.float32)
            weights, ratio = both[:BUCKETS], both[BUCKETS:]
            squares = ratio * ratio
            _, bias, slope, shift = model.value
        for batch in batches:
            texts = texts_of(batch.column(1))
            scores = np.full(len(texts), 0.5)
            if model is not None:
                for lo, hi in blocks(texts):
                    for i, own in enumerate(indicators(texts[lo:hi]), lo):
                        margin = float(weights[own].sum()) / max(float(np.sqrt(squares[own].sum())), 1e-9) + bias
                        scores[i] = 1 / (1 + np.exp(-min(max(slope * margin + shift, -30.0), 30.0)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])
    return run


def score_quality(docs, model):
    """doc_id and score (0 to 1) of every row; ``model`` from train_quality.

    Null counts as empty; a text without n-grams is scored by the bias alone.
    Without a model every score is 0.5. Whole texts are read.
    """
    shared = None if model is None else docs.sparkSession.sparkContext.broadcast(tuple(model))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _score(shared), "doc_id long, score double")
