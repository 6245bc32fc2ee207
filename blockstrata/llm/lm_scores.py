"""Language-model scores from a log-frequency Bloom filter of quantised pair counts.

The filter is cut into shards by the pairs' names, and each shard into its lower
and its upper levels, which few pairs reach. The upper parts of as many shards
as a bounded size holds go to all workers; everything stays in a table of
shards. Texts are taken in blocks: pairs that the workers cannot answer are sent
to their shards, probed there, and the levels come back to the block. The same
bits are probed by the same rule in both places, so what is sent changes no score.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..session import cut_lineage
from .words import blocks, mix, texts_of, word_hashes

START, END = (mix(np.array([x], dtype=np.uint64))[0] for x in (101, 103))
FLUSH = 1_500_000
#: Bytes of text in a block, and tokens whose pairs make a shard.
BLOCK, SHARD = 2_000_000, 4_000_000
#: Lowest of the upper levels, and how many of them must answer before the lower ones need not be asked.
UPPER, SURE = 4, 3
#: A shard takes the top 24 bits of a hash, a name within it the lower 48.
NAME = np.uint64(0xFFFFFFFFFFFF)
TABLE = "shard int, lower binary, upper binary, words binary"
SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def tokens(texts, start=False):
    """Token hashes of a block of texts, and where each text's begin.

    Every text ends with END and, if asked for, begins with START.
    """
    words, offsets = word_hashes(texts)
    sizes = np.diff(offsets)
    lead = int(start)
    begins = np.concatenate(([0], np.cumsum(sizes + 1 + lead)))
    out = np.empty(begins[-1], dtype=np.uint64)
    out[begins[1:] - 1] = END
    if start:
        out[begins[:-1]] = START
    inside = np.ones(len(out), dtype=bool)
    inside[begins[1:] - 1] = False
    if start:
        inside[begins[:-1]] = False
    out[inside] = words
    return out, begins


def pair_hashes(run, begins):
    """Hash of each token of a run with the one before it, START left out."""
    both = mix(run[:-1] * np.uint64(0xA24BAED4963EE407) + run[1:])
    keep = np.ones(len(run), dtype=bool)
    keep[begins[:-1]] = False
    return both[keep[1:]]


def _tally(parts):
    values = np.concatenate([p[0] for p in parts])
    weights = np.concatenate([p[1] for p in parts])
    found, at = np.unique(values, return_inverse=True)
    return found, np.bincount(at, weights, len(found)).astype(np.int64)


def _counted(batches, hashes):
    """(distinct hashes, counts) of all texts, handed on whenever many are held."""
    held, size = [], 0
    for batch in batches:
        texts = texts_of(batch.column(0))
        for lo, hi in blocks(texts):
            held.append(np.unique(hashes(texts[lo:hi]), return_counts=True))
            size += len(held[-1][0])
            if size >= FLUSH:
                held = [_tally(held)]
                if len(held[0][0]) >= FLUSH // 2:
                    yield held.pop()
                size = sum(len(h[0]) for h in held)
    if held:
        yield _tally(held)


def _words(batches):
    for found, counts in _counted(batches, lambda texts: tokens(texts)[0]):
        for at in range(0, len(found), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(found[at:at + 100_000].view(np.int64)), pa.array(counts[at:at + 100_000])],
                                             names=["token", "n"])


def _pack(names, *counts):
    """Sorted names of up to 64 bits, and numbers that go with them, as bytes."""
    steps = np.diff(names, prepend=np.uint64(0)).astype("<u8")
    wide = max(1, -(-int(steps.max(initial=0)).bit_length() // 8))
    raw = steps.view(np.uint8).reshape(-1, 8)[:, :wide].tobytes()
    tails = b""
    for c in counts:
        large = c[c >= 255].astype("<u8").tobytes()
        tail = zlib.compress(np.minimum(c, 255).astype(np.uint8).tobytes() + large, 1)
        tails += len(tail).to_bytes(4, "little") + tail
    return bytes([wide]) + len(names).to_bytes(4, "little") + raw + tails


def _unpack(blob):
    """The names of packed bytes, and the arrays of their numbers."""
    wide, n = blob[0], int.from_bytes(blob[1:5], "little")
    steps = np.zeros((n, 8), dtype=np.uint8)
    steps[:, :wide] = np.frombuffer(blob, dtype=np.uint8, count=n * wide, offset=5).reshape(n, wide)
    out, at = [np.cumsum(steps.reshape(-1).view("<u8"), dtype=np.uint64)], 5 + n * wide
    while at < len(blob):
        size = int.from_bytes(blob[at:at + 4], "little")
        tail, at = zlib.decompress(blob[at + 4:at + 4 + size]), at + 4 + size
        counts = np.frombuffer(tail, dtype=np.uint8, count=n).astype(np.int64)
        counts[counts == 255] = np.frombuffer(tail, dtype="<u8", offset=n)
        out.append(counts)
    return out


def _shards(hashes, shards):
    return ((hashes >> np.uint64(40)) * np.uint64(shards) >> np.uint64(24)).astype(np.int32)


def _split(hashes, shards):
    """(shard, positions, sorted names) of each shard that sorted hashes have a part in."""
    edges = np.searchsorted(_shards(hashes, shards), np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(edges)).tolist():
        names = hashes[edges[s]:edges[s + 1]] & NAME
        order = np.argsort(names, kind="stable")
        yield s, edges[s] + order, names[order]


def _pairs(shards):
    def run(batches):
        for found, counts in _counted(batches, lambda texts: pair_hashes(*tokens(texts, start=True))):
            parts = [(s, _pack(names, counts[at])) for s, at, names in _split(found, shards)]
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in parts], pa.int32()), pa.array([b for _, b in parts], pa.binary())], names=["shard", "blob"])
    return run


def levels_of(counts, base):
    """Quantised counts: level j holds counts from base ** (j - 1) on."""
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(base) + 1e-9).astype(np.int64)


def middles(level, base):
    """Counts at the middle of levels; 0 for level 0."""
    low = np.ceil(np.power(base, np.maximum(level - 1, 0)) - 1e-9)
    high = np.maximum(np.ceil(np.power(base, level) - 1e-9) - 1, low)
    return np.where(level == 0, 0.0, np.sqrt(low * high))


def _places(names, level, bits, probes):
    """Bit places of pairs at a level among ``bits`` bits."""
    x = mix(names ^ mix(np.array([level], dtype=np.uint64)))
    first, step = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
    for k in range(probes):
        yield (((first + np.uint64(k) * step) & np.uint64(0xFFFFFFFF)) * bits) >> np.uint64(32)


def filled(names, levels, least, bits, probes):
    """Bytes of a filter that holds every level from ``least`` up to each pair's."""
    flags, level, bits = np.zeros(int(bits), dtype=bool), least, np.uint64(bits)
    while True:
        keep = levels >= level
        names, levels = names[keep], levels[keep]
        if not len(names):
            return np.packbits(flags, bitorder="little").tobytes()
        for at in _places(names, level, bits, probes):
            flags[at] = True
        level += 1


def _room(entries, bits_per_entry):
    """Bits for so many entries, whole words; a place has 32 bits, so a shard has 2 ** 32 at most."""
    return np.maximum((np.asarray(entries) * bits_per_entry + 63) // 64 * 64, 64)


def _merge(base, bits_per_entry, probes):
    """One row of a shard: its filter of lower and of upper levels, and its words with their counts."""
    def run(words, pairs):
        none = [np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)]
        names, counts = _tally([none, *(_unpack(b) for b in pairs.column("blob").to_pylist())])
        levels = np.minimum(levels_of(counts, base), 255)
        low, high = np.minimum(levels, UPPER - 1), levels >= UPPER
        lower = filled(names, low, 1, _room(low.sum(), bits_per_entry), probes)
        upper = filled(names[high], levels[high], UPPER, _room((levels[high] - UPPER + 1).sum(), bits_per_entry), probes)
        own = words.column("token").combine_chunks().to_numpy(zero_copy_only=False).view(np.uint64) & NAME
        order, shard = np.argsort(own), (words if words.num_rows else pairs).column("shard").slice(0, 1)
        counted = words.column("n").combine_chunks().to_numpy(zero_copy_only=False)[order]
        return pa.table({"shard": shard, "lower": pa.array([lower], pa.binary()), "upper": pa.array([upper], pa.binary()),
                         "words": pa.array([_pack(own[order], counted)], pa.binary())})
    return run


class CountFilter:
    """Bits of shards, one after another; the level of a pair is found by probing upwards. A shard of size 0 is not held."""

    def __init__(self, segments, sizes, least, probes, most=255):
        self.bits, self.sizes = np.frombuffer(segments, dtype=np.uint8), np.asarray(sizes, dtype=np.uint64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.least, self.probes, self.most = least, probes, most

    def levels(self, hashes, shard=None):
        """0 for pairs that are not held."""
        shard = _shards(hashes, len(self.sizes)) if shard is None else np.full(len(hashes), shard)
        names, size, start = hashes & NAME, self.sizes[shard], self.starts[shard]
        out, open_, level = np.zeros(len(hashes), dtype=np.int64), np.flatnonzero(size > 0), self.least
        while len(open_) and level <= self.most:
            hit = np.ones(len(open_), dtype=bool)
            for at in _places(names[open_], level, size[open_], self.probes):
                at += start[open_]
                hit &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
            open_ = open_[hit]
            out[open_] = level
            level += 1
        return out

    def sure(self, hashes, shard=None):
        """Levels of the pairs that are held SURE levels deep; 0 for all others."""
        out = self.levels(hashes, shard)
        return np.where(out >= self.least + SURE - 1, out, 0)


def levels_in_shard(names, lower, upper, probes):
    """Levels of names by a shard's two filters: a sure upper level, or else what probing from level 1 reaches."""
    low, high = CountFilter(lower, [len(lower) * 8], 1, probes, UPPER - 1), CountFilter(upper, [len(upper) * 8], UPPER, probes)
    out, above = low.levels(names, 0), high.levels(names, 0)
    climbed = np.where(out == UPPER - 1, np.maximum(above, out), out)
    return np.where(above >= UPPER + SURE - 1, above, climbed)


class Model:
    """What scoring needs: the table of shards and their number, N, V, the common
    words (sorted hashes, counts), the upper filter, and the parameters."""

    def __init__(self, table, shards, total, distinct, common, upper, base, probes, prior):
        self.table, self.shards, self.total, self.distinct = table, shards, total, distinct
        self.common, self.upper, self.base, self.probes, self.prior = common, upper, base, probes, prior


def train(docs, bits_per_entry=10, probes=5, base=1.6, most_bytes=32_000_000, most_common=1 << 18, prior=20.0, shard_tokens=SHARD):
    """Count words and pairs of all ``docs`` (needs text) and build the filter.

    Word counts are exact. Pairs of neighbours (the first word of a text has the
    begin before it) are merged by shards of their hashes; every level up to a
    pair's quantised count (powers of ``base``) is an entry of ``bits_per_entry``
    bits of its shard. A table keeps a row per shard, one for ``shard_tokens``
    tokens of the corpus. Two things go to all workers: the ``most_common`` most
    frequent words, and the upper levels of the first shards, as many as
    ``most_bytes`` hold.
    """
    text = docs.select(F.col("text").cast("string").alias("text"))
    spark = docs.sparkSession
    counts = cut_lineage(text.mapInArrow(_words, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")))
    step = F.floor(F.log2(F.col("n").cast("double")) * 16)
    heights = counts.groupBy(step.alias("step")).agg(F.count("*").alias("tokens"), F.min("n").alias("least"), F.sum("n").alias("sum")).collect()
    total, distinct = sum(h["sum"] for h in heights), sum(h["tokens"] for h in heights)
    held, edge = 0, None
    for h in sorted(heights, key=lambda h: -h["step"]):
        held += h["tokens"]
        if held > most_common:
            break
        edge = h["least"]
    rows = counts.where(F.col("n") >= edge).toPandas() if edge is not None else counts.limit(0).toPandas()
    names = rows["token"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(names)
    common = names[order], rows["n"].to_numpy(dtype=np.int64)[order]

    shards = max(1, -(-total // shard_tokens))
    pairs = text.mapInArrow(_pairs(shards), "shard int, blob binary")
    # As in _shards: the top 24 bits, scaled.
    own = F.shiftright(F.shiftrightunsigned("token", 40) * F.lit(shards), 24).cast("int")
    table = cut_lineage(counts.withColumn("shard", own).groupBy("shard").cogroup(pairs.groupBy("shard")).applyInArrow(
        _merge(base, bits_per_entry, probes), TABLE))
    lengths = np.zeros(shards, dtype=np.int64)
    for row in table.select("shard", F.octet_length("upper").alias("n")).toLocalIterator():
        lengths[row["shard"]] = row["n"]
    fits = np.cumsum(lengths) <= most_bytes
    chosen = table.where(F.col("shard") < int(np.count_nonzero(fits))).select("shard", "upper")
    segments = {r["shard"]: bytes(r["upper"]) for r in chosen.toLocalIterator()}
    upper = b"".join(segments.get(i, b"") for i in range(shards))
    return Model(table, shards, total, distinct, common, (upper, np.where(fits, lengths, 0) * 8, UPPER, probes), base, probes, prior)


def _found(keys, values, wanted):
    """Values of the wanted keys; 0 for those that are not among the sorted keys."""
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


class Scorer:
    """Sorted words and pairs of a block, and scores once the open ones are answered."""

    def __init__(self, texts, shared):
        self.names, self.seen, self.upper, self.total, self.distinct, self.base, self.prior, self.shards = shared
        run, self.begins = tokens(texts, start=True)
        self.words, self.at = np.unique(run, return_inverse=True)
        self.pairs, self.pair_at = np.unique(pair_hashes(run, self.begins), return_inverse=True)
        self.counts = _found(self.names, self.seen, self.words)
        self.levels = self.upper.sure(self.pairs)

    def open(self):
        """(shard, names of words, names of pairs) to ask for."""
        words, pairs = (dict((s, n) for s, _, n in _split(x, self.shards)) for x in (self.words[self.counts == 0], self.pairs[self.levels == 0]))
        none = np.zeros(0, dtype=np.uint64)
        for s in sorted(words.keys() | pairs.keys()):
            yield s, words.get(s, none), pairs.get(s, none)

    def answer(self, shards, words, pairs):
        """Take in the answered counts and levels of each shard."""
        for kind, own, values in ((words, self.words, self.counts), (pairs, self.pairs, self.levels)):
            open_ = np.flatnonzero(values == 0)
            answered = dict(zip(shards, kind))
            for s, at, names in _split(own[open_], self.shards):
                if s in answered:
                    values[open_[at]] = _found(*_unpack(answered[s]), names)

    def scores(self):
        """n_tokens, n_known, base score and score of each text."""
        inside = np.ones(len(self.at), dtype=bool)
        inside[self.begins[:-1]] = False
        own, starts = self.at[inside], self.begins[:-1] - np.arange(len(self.begins) - 1)
        # A text begins as often as it ends.
        counts = np.where(self.words == START, _found(self.words, self.counts, np.array([END])), self.counts)
        log = np.log10(counts + 1.0) - np.log10(self.total + self.distinct + 1.0)
        before = counts[self.at[:-1][inside[1:]]]
        both = np.minimum(middles(self.levels, self.base)[self.pair_at], before)
        single = (counts[own] + 1.0) / (self.total + self.distinct + 1.0)
        chance = np.log10((both + self.prior * single) / (before + self.prior))
        return (np.diff(self.begins) - 1, *(np.add.reduceat(x, starts) for x in ((counts[own] > 0).astype(np.int64), log[own], chance)))


def _shared(sent):
    names, seen, upper, *rest = sent.value
    return (names, seen, CountFilter(*upper), *rest)


def _asked(sent):
    """The words and pairs of a block that the workers' own tables do not answer, by shard."""
    def run(rows):
        parts = list(Scorer(texts_of(rows.column("text")), _shared(sent)).open())
        return pa.table({"shard": pa.array([s for s, _, _ in parts], pa.int32()), "block": pa.array([rows.column("block")[0].as_py()] * len(parts), pa.int64()),
                         "words": pa.array([_pack(w) for _, w, _ in parts], pa.binary()), "pairs": pa.array([_pack(p) for _, _, p in parts], pa.binary())})
    return run


def _answered(probes):
    """Counts of the words and levels of the pairs that blocks ask a shard for."""
    def run(held, asked):
        words, pairs = [], []
        if held.num_rows:
            known, lower, upper = _unpack(held.column("words")[0].as_py()), held.column("lower")[0].as_py(), held.column("upper")[0].as_py()
        for w, p in zip(asked.column("words"), asked.column("pairs")):
            (w,), (p,) = _unpack(w.as_py()), _unpack(p.as_py())
            words.append(_pack(w, _found(*known, w) if held.num_rows else np.zeros(len(w), dtype=np.int64)))
            pairs.append(_pack(p, levels_in_shard(p, lower, upper, probes) if held.num_rows else np.zeros(len(p), dtype=np.int64)))
        return pa.table({"shard": asked.column("shard"), "block": asked.column("block"), "words": pa.array(words, pa.binary()), "pairs": pa.array(pairs, pa.binary())})
    return run


def _settled(sent):
    def run(rows, answers):
        scorer = Scorer(texts_of(rows.column("text")), _shared(sent))
        scorer.answer(*(answers.column(c).to_pylist() for c in ("shard", "words", "pairs")))
        return pa.table([rows.column("doc_id"), *map(pa.array, scorer.scores())], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])
    return run


def score(docs, model, block_bytes=BLOCK):
    """Scores of every row's whole text under a model from ``train``.

    ``docs`` needs doc_id and text; null text counts as empty. Returns doc_id,
    n_tokens, n_known, train_tokens, base_score, score. Tokens are the words
    and one end. base_score is the add-one unigram score, from exact counts.
    score is the sum of the log10 probabilities of each token given the one
    before: (c(pair) + prior * p(token)) / (c(before) + prior), p the add-one
    probability, c(before) exact, c(pair) from the filter and at most
    c(before). False hits aside, c(pair) is within a factor of the square root
    of ``base`` of the count, so the probabilities of all tokens after one sum
    to 1 within that factor.

    Texts are dealt into blocks of about ``block_bytes`` by a hash of their row;
    they move once. A block asks the shards of the model's table for its
    distinct words and pairs that the workers' tables do not answer. A model
    without training text gives every token the same chance. An empty table
    gives no rows; repeated rows are scored alike.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((*model.common, model.upper, model.total, model.distinct, model.base, model.prior, model.shards))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks_ = -(-size // block_bytes) + 1
    rows = plain.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks_)))
    asked = rows.groupBy("block").applyInArrow(_asked(sent), "shard int, block long, words binary, pairs binary")
    # Where far more is scored than was learned from, a shard answers in several places.
    copies = 1 + size // (20 * max(model.total, 1))
    # Both sides need keys of one type: they are dealt by hashes, and those of an int and of a long differ.
    held = model.table.select("shard", "lower", "upper", "words").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))))
    asked = asked.withColumn("copy", F.pmod("block", F.lit(copies)).cast("long"))
    answers = held.groupBy("shard", "copy").cogroup(asked.groupBy("shard", "copy")).applyInArrow(
        _answered(model.probes), "shard int, block long, words binary, pairs binary")
    scored = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_settled(sent), SCORED)
    return scored.select("doc_id", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")
