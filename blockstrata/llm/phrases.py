"""Phrases whose words stay together: counts of word sequences joined in prefix and suffix order.

A stream of counts in prefix order holds every phrase after the phrases it
begins with, and before those it begins; one pass with a short stack gives each
phrase its left parts and its extensions to the right. The same pass over the
stream in suffix order (words reversed) gives right parts and extensions to the
left. Both streams are then merge-joined.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .lm_scores import _pack, _split, _tally, _unpack
from .words import BYTE_KEYS, STEP, STEP_BACK, _power, blocks, mix, texts_of

#: Bytes that end a piece, and those that part words.
ENDS = np.zeros(256, dtype=bool)
ENDS[list(b".,;:!?\n\x0b\x0c\r")] = True
GAPS = ENDS.copy()
GAPS[[9, 32]] = True
#: Bits of each of the two maps of frequent names that go to all workers: 16 MB.
MAP_BITS = 2 ** 27
SLICE = 2 ** 15
#: Names that a task holds before it hands them on.
FLUSH = 500_000
#: Bytes of text for each shard of names.
SHARD_BYTES = 16_000_000


def words_of(texts):
    """Words of a block of texts as one Arrow array, and whether the next word stands in the same piece."""
    data = np.frombuffer(b"\n".join(texts).lower() + b"\n", dtype=np.uint8)
    gap = GAPS[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if len(data) and not gap[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[::2], edge[1::2]
    offsets = np.concatenate(([0], np.cumsum(ends - starts)))
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[~gap])])
    stops = np.cumsum(ENDS[data])
    joined = np.zeros(len(starts), dtype=bool)
    joined[:-1] = stops[ends[:-1] - 1] == stops[starts[1:] - 1]
    return words, joined


def name_hashes(words):
    """64-bit names of the words of an Arrow array, used only to tell rare words before counting."""
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[:len(words) + 1]
    data = np.frombuffer(data, dtype=np.uint8)[:offsets[-1]]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_KEYS[data] * _power("up", STEP, len(data)), out=sums[1:])
    back = _power("down", STEP_BACK, len(data))[offsets[:-1]]
    return mix((sums[offsets[1:]] - sums[offsets[:-1]]) * back + np.diff(offsets).astype(np.uint64))


def pair_hashes(names):
    """Names of each word with the next one; the last has none."""
    return mix(names[:-1] * np.uint64(0xA24BAED4963EE407) + names[1:])


def inside(held, names):
    """Which names have their bit in a map."""
    place = (names & np.uint64(MAP_BITS - 1)).astype(np.int64)
    return (held[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1


def longer_hashes(hashes, names, ends):
    """Names of sequences with the word at ``ends`` added to each."""
    return mix(hashes * np.uint64(0xA24BAED4963EE407) + names[ends])


def followed(names, joined, held):
    """Which words form a frequent pair with the next one."""
    out = np.zeros(len(names), dtype=bool)
    if len(names) > 1:
        out[:-1] = joined[:-1] & inside(held, pair_hashes(names))
    return out


def _by_language(batch, rows=500):
    """Language and texts of a batch, in blocks; few rows at a time are held as texts."""
    for at in range(0, batch.num_rows, rows):
        part = batch.slice(at, rows)
        for lang in pc.unique(part.column(0)).to_pylist():
            texts = texts_of(part.filter(pc.equal(part.column(0), lang)).column(1))
            for lo, hi in blocks(texts):
                yield lang, texts[lo:hi]


def _salt(lang):
    return mix(np.frombuffer(lang.encode().ljust(8, b"\0")[:8], dtype=np.uint64) + np.uint64(len(lang)))[0]


def _short(longest):
    """Names of all words and, for longer phrases, pairs of neighbours."""
    def hashes(names, joined):
        yield names
        if longest > 1 and len(names) > 1:
            yield pair_hashes(names)[joined[:-1]]
    return hashes


def _long(sent, longest):
    """Names of the sequences of 3 to ``longest`` words whose neighbours are all frequent pairs."""
    def hashes(names, joined):
        follows = followed(names, joined, sent.value)
        starts = np.flatnonzero(follows)
        found = pair_hashes(names)[starts] if len(starts) else names[:0]
        for size in range(3, longest + 1):
            more = follows[starts + size - 2]
            starts = starts[more]
            found = longer_hashes(found[more], names, starts + size - 1)
            yield found
    return hashes


def _names(shards, hashes):
    """How often words and sequences occur, by name; handed on whenever many are held."""
    def counted(batches):
        held, size = [], 0
        for batch in batches:
            for lang, texts in _by_language(batch):
                words, joined = words_of(texts)
                if not len(words):
                    continue
                for found in hashes(name_hashes(words) ^ _salt(lang), joined):
                    held.append(np.unique(found, return_counts=True))
                    size += len(held[-1][0])
                if size >= FLUSH:
                    held = [_tally(held)]
                    if len(held[0][0]) >= FLUSH // 2:
                        yield held.pop()
                    size = sum(len(h[0]) for h in held)
        if held:
            yield _tally(held)

    def run(batches):
        for found, counts in counted(batches):
            parts = [(shard, _pack(names, counts[at])) for shard, at, names in _split(found, shards)]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in parts], pa.int32()), pa.array([x for _, x in parts], pa.binary())], names=["shard", "blob"])
    return run


def _frequent(least):
    """Places of a shard's names that occur ``least`` times or more."""
    def run(table):
        names, counts = _tally([_unpack(b.as_py()) for b in table.column("blob")])
        return pa.table({"place": pa.array((names[counts >= least] & np.uint64(MAP_BITS - 1)).astype(np.int64))})
    return run


def _slice(batches):
    held = {}
    for batch in batches:
        places = np.sort(batch.column(0).to_numpy(zero_copy_only=False))
        for part in np.unique(places // SLICE).tolist():
            lo, hi = np.searchsorted(places, [part * SLICE, (part + 1) * SLICE])
            held.setdefault(part, np.zeros(SLICE, dtype=bool))[places[lo:hi] - part * SLICE] = True
    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([np.packbits(b).tobytes() for b in held.values()], pa.binary())],
                                     names=["part", "bits"])


def frequent_map(docs, least, shards, hashes):
    """Bit map of the names that occur ``least`` times or more; others may share their bits."""
    places = docs.mapInArrow(_names(shards, hashes), "shard int, blob binary").groupBy("shard").applyInArrow(_frequent(least), "place long")
    parts = places.repartition(F.expr(f"place div {SLICE}")).mapInArrow(_slice, "part long, bits binary")
    out = np.zeros(MAP_BITS // 8, dtype=np.uint8)
    for r in parts.collect():  # MAP_BITS / 8 bytes at most
        out[r["part"] * SLICE // 8:(r["part"] + 1) * SLICE // 8] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


COUNTED = pa.schema([("phrase", pa.large_binary()), ("size", pa.int32()), ("n", pa.int64())])


def _windows(sent, longest):
    """Counts of the word sequences whose parts are all in the maps, handed on whenever many are held."""
    def sequences(held, words, joined, lang):
        """Distinct sequences of a block's words, by size, with their counts."""
        short, long = held
        names = name_hashes(words) ^ _salt(lang)
        starts = np.flatnonzero(inside(short, names))
        follows, found = followed(names, joined, short), names[starts]
        phrase = words.take(pa.array(starts))
        for size in range(1, longest + 1):
            if size > 1:
                more = follows[starts + size - 2]
                starts, phrase = starts[more], phrase.filter(pa.array(more))
                found = longer_hashes(found[more], names, starts + size - 1)
                if size > 2:
                    more = inside(long, found)
                    starts, phrase, found = starts[more], phrase.filter(pa.array(more)), found[more]
                if not len(starts):
                    break
                phrase = pc.binary_join_element_wise(phrase, words.take(pa.array(starts + size - 1)), pa.scalar(b" ", pa.large_binary()))
            counted = pc.value_counts(phrase)
            yield pa.table([counted.field(0), pa.array(np.full(len(counted), size, np.int32)), counted.field(1)], schema=COUNTED)

    def summed(lang, tables):
        out = pa.concat_tables(tables).group_by(["phrase", "size"]).aggregate([("n", "sum")])
        out = pa.table({"lang": pa.array([lang] * len(out), pa.string()), "phrase": out["phrase"].cast(pa.binary()), "size": out["size"], "n": out["n_sum"]})
        return out.to_batches(max_chunksize=50_000)

    def run(batches):
        held, tables, rows = sent.value, {}, {}
        for batch in batches:
            for lang, texts in _by_language(batch):
                words, joined = words_of(texts)
                if not len(words):
                    continue
                own = tables.setdefault(lang, [])
                own.append(pa.table([pa.array([b""], pa.large_binary()), pa.array([0], pa.int32()), pa.array([len(words)])], schema=COUNTED))
                own += sequences(held, words, joined, lang)
                rows[lang] = rows.get(lang, 0) + sum(len(t) for t in own[-longest:])
                if sum(rows.values()) >= FLUSH // 5:
                    for name in tables:
                        yield from summed(name, tables[name])
                    tables, rows = {}, {}
        for name in tables:
            yield from summed(name, tables[name])
    return run


def phrase_counts(docs, least=30, longest=4):
    """lang, phrase, size, n of all sequences of up to ``longest`` words that occur ``least`` times or more,
    and of size 0 with all words of a language."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    context = docs.sparkSession.sparkContext
    shards = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SHARD_BYTES + 1
    short = frequent_map(rows, least, shards, _short(longest))
    long = frequent_map(rows, least, shards, _long(context.broadcast(short), longest)) if longest > 2 else np.zeros_like(short)
    sent = context.broadcast((short, long))
    found = rows.mapInArrow(_windows(sent, longest), "lang string, phrase binary, size int, n long")
    sums = found.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))
    return cut_lineage(sums.where((F.col("n") >= least) | (F.col("size") == 0)).select("lang", F.col("phrase").cast("string").alias("phrase"), "size", "n"))


def _chain(batches):
    """Parts and extensions of each phrase of a stream in order of its words.

    Each row carries key (lang and words), size, n and the count of its first
    word. Yields lang, key, parts (counts of its first 1, 2, ... words) and
    most (the highest count of a phrase that is one word longer).
    """
    stack, lang = [], None
    done = {"lang": [], "key": [], "parts": [], "most": []}

    def close(depth):
        while len(stack) > depth:
            key, n, first, most = stack.pop()
            done["lang"].append(lang)
            done["key"].append(key)
            done["parts"].append([first, *(x[1] for x in stack)])
            done["most"].append(most)
    kinds = pa.schema([("lang", pa.string()), ("key", pa.list_(pa.string())), ("parts", pa.list_(pa.int64())), ("most", pa.int64())])
    for batch in batches:
        for own, key, n, first in zip(*(c.to_pylist() for c in batch.columns)):
            depth = 0
            if own == lang:
                while depth < len(stack) and key[:len(stack[depth][0])] == stack[depth][0]:
                    depth += 1
            close(depth)
            lang = own
            if stack and len(stack[-1][0]) == len(key) - 1:
                stack[-1][3] = max(stack[-1][3], n)
            stack.append([key, n, first, 0])
        held = pa.RecordBatch.from_pydict(done, schema=kinds)
        done = {k: [] for k in done}
        yield held
    close(0)
    yield pa.RecordBatch.from_pydict(done, schema=kinds)


def _stream(counts, backwards):
    """Parts and extensions of the phrases of two words and more, in prefix or suffix order."""
    key = F.split("phrase", " ")
    key = F.reverse(key) if backwards else key
    singles = counts.where("size = 1").select("lang", F.col("phrase").alias("w"), F.col("n").alias("first"))
    longer = counts.where("size > 1").select("lang", key.alias("key"), "n").withColumn("w", F.col("key")[0])
    rows = longer.join(singles.hint("merge"), ["lang", "w"]).select("lang", "key", "n", "first")
    rows = rows.repartition("lang", F.col("key")[0], F.col("key")[1]).sortWithinPartitions("lang", "key")
    out = rows.mapInArrow(_chain, "lang string, key array<string>, parts array<long>, most long")
    return out.select("lang", F.array_join(F.reverse("key") if backwards else F.col("key"), " ").alias("phrase"), "parts", "most")


def collocations(docs, least=30, longest=4, inside_percent=80, most=2000, scale=2_000_000):
    """Best phrases of each language.

    ``docs``: text, lang. A-Z count as a-z; texts break into pieces at
    ``.,;:!?`` and line ends, pieces into words at spaces and tabs. A candidate
    is a phrase of 2 to ``longest`` words that occurs a >= ``least`` times within
    pieces, overlaps included. Cut after k words, it scores
    floor(scale * a / (l + r)), l and r the counts of its two parts; its lowest
    cut counts, of equal ones the first. Candidates inside a longer one with
    100 * count >= inside_percent * a are dropped. Returns for each language
    (null: ``und``) the first ``most`` by score and a, both falling, and phrase:
    lang, rank, phrase, a, l, r, n (words of the language), score.

    Words, pairs and longer sequences that are too rare are left out by two bit
    maps of 16 MB each before phrases are counted; they may keep rare ones, never
    lose frequent ones, and the counts decide. Null and empty texts have no words; repeated
    rows count each; other columns are ignored; an empty table gives no rows.
    """
    counts = phrase_counts(docs, least, longest)
    words = counts.where("size = 0").select("lang", F.col("n").alias("words"))
    left = _stream(counts, False).select("lang", "phrase", F.col("parts").alias("lefts"), F.col("most").alias("after"))
    right = _stream(counts, True).select("lang", "phrase", F.col("parts").alias("rights"), F.col("most").alias("before"))
    both = counts.where("size > 1").join(left.hint("merge"), ["lang", "phrase"]).join(right.hint("merge"), ["lang", "phrase"])
    big = "decimal(38,0)"
    cut = F.expr(f"""array_min(transform(lefts, (x, i) -> struct(
        cast({scale} as {big}) * n div (cast(x as decimal(20,0)) + element_at(rights, size - 1 - i)) as score, i as k, x as l, element_at(rights, size - 1 - i) as r)))""")
    kept = both.where(F.greatest("after", "before") * F.lit(100).cast("decimal(3,0)") < F.col("n") * F.lit(inside_percent).cast("decimal(3,0)"))
    scored = kept.withColumn("cut", cut).select("lang", "phrase", F.col("n").alias("a"), "cut.l", "cut.r", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    first = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= most)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), "score")
