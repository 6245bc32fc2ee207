"""Near duplicates by circulant MinHash, banding and exact Jaccard checks."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..session import cut_lineage
from .linking import components
from .words import CircularMinHash, blocks, common, mix, shingle_sets, texts_of

#: Buckets of up to so many nodes give their pairs one by one.
PAIRED = 8
SKETCH = "doc_id long, n_shingles long, set_key binary, bands array<long>"


def _sketch(shingle_words, bands, rows, seed):
    minhash = CircularMinHash(bands * rows, seed)
    salt = mix(np.arange(1, bands + 1, dtype=np.uint64))

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), texts_of(batch.column(1))
            for lo, hi in blocks(texts):
                sets = shingle_sets(texts[lo:hi], shingle_words)
                sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
                full = np.flatnonzero(sizes)
                flat = np.concatenate(sets) if len(sets) else np.empty(0, dtype=np.uint64)
                starts = np.cumsum(sizes) - sizes
                signature = minhash.signatures(minhash.place(flat), starts[full]).astype(np.uint64)
                keys = np.zeros((len(full), bands), dtype=np.uint64)
                for r in range(rows):
                    keys = mix(keys + signature[:, r::rows] + np.uint64(r + 1))
                keys = mix(keys ^ salt)
                prints = np.zeros((len(sets), 2), dtype=np.uint64)
                if len(full):
                    prints[full, 0] = np.add.reduceat(mix(flat), starts[full])
                    prints[full, 1] = np.add.reduceat(mix(flat ^ np.uint64(0x5851F42D4C957F2D)), starts[full])
                spans = np.zeros(len(sets) + 1, dtype=np.int32)
                spans[1:] = np.cumsum(np.where(sizes > 0, bands, 0))
                yield pa.RecordBatch.from_arrays([
                    ids.slice(lo, hi - lo).cast(pa.int64()), pa.array(sizes),
                    pa.array([p.tobytes() for p in prints], type=pa.binary()),
                    pa.ListArray.from_arrays(spans, pa.array(keys.reshape(-1).view(np.int64)))],
                    names=["doc_id", "n_shingles", "set_key", "bands"])
    return run


def sketches(docs, shingle_words=5, bands=40, rows=5, seed=1):
    """doc_id, n_shingles, set_key (128 bits of the shingle set), bands."""
    return docs.select("doc_id", "text").mapInArrow(_sketch(shingle_words, bands, rows, seed), SKETCH)


def _sets(shingle_words):
    def run(batches):
        for batch in batches:
            nodes, texts = batch.column(0), texts_of(batch.column(1))
            for lo, hi in blocks(texts):
                sets = shingle_sets(texts[lo:hi], shingle_words)
                yield pa.RecordBatch.from_arrays([nodes.slice(lo, hi - lo), pa.array(
                    [x.tobytes() for x in sets], type=pa.binary())], names=["node", "shingles"])
    return run


def _numbers(column):
    return [np.frombuffer(x, dtype=np.uint64) for x in column.to_pylist()]


def _verify(percent):
    def run(batches):
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            left, right = _numbers(batch.column(2)), _numbers(batch.column(3))
            keep = np.zeros(len(a), dtype=bool)
            for i in range(len(a)):
                shared = common(left[i], right[i])
                keep[i] = shared > 0 and 100 * shared >= percent * (len(left[i]) + len(right[i]) - shared)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])
    return run


def _links(pairs, sets, percent):
    """The pairs (a, b) of nodes whose full shingle sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")
    return cut_lineage(both.mapInArrow(_verify(percent), "a long, b long").distinct())


def _link_block(percent):
    """Links between different components of one block of nodes, at least one
    for each two components that the block's sets link."""
    def run(table):
        nodes = table.column("node").to_numpy()
        _, group = np.unique(table.column("component").to_numpy(), return_inverse=True)
        sets = _numbers(table.column("shingles").combine_chunks())
        sizes = np.array([len(x) for x in sets], dtype=np.int64)
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(flat, kind="stable")
        owner = owner[order]
        known, begins = np.unique(flat[order], return_index=True)
        ends = np.append(begins[1:], len(flat))
        parent = list(range(int(group.max()) + 1))

        def root(x):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x
        found = []
        main = np.bincount(group).argmax()
        for i in np.flatnonzero(group != main):
            at = np.searchsorted(known, sets[i])
            spans = ends[at] - begins[at]
            where = np.repeat(begins[at] - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())
            shared = np.bincount(owner[where], minlength=len(sets))
            near = (100 * shared >= percent * (sizes + sizes[i] - shared)) & (group != group[i])
            for j in np.flatnonzero(near):
                p, q = root(group[i]), root(group[j])
                if p != q:
                    parent[p] = q
                    found.append((nodes[i], nodes[j]))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})
    return run


def _unsettled(marks, placed):
    """Marks of buckets whose nodes are not yet in one component."""
    if placed is None:
        return marks.withColumn("component", F.col("node"))
    here = marks.join(placed, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = here.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return here.join(mixed.where("low < high").select("band"), "band", "left_semi")


def near_duplicates(docs, shingle_words=5, percent=80, bands=40, rows=5, seed=1, block_shingles=400_000):
    """Components of documents whose shingle sets have a Jaccard similarity of
    at least ``percent`` / 100.

    ``docs`` needs doc_id and text; other columns are ignored. Returns one row
    per input row: doc_id, n_shingles, component_id, kept.

    Every document gets ``bands * rows`` circulant MinHash coordinates. A pair
    at the threshold shares a band with probability 1 - (1 - 0.8 ** 5) ** 40,
    all but one in ten million. Documents with equal shingle sets are one node
    from then on, so exact copies cost nothing further. Every node of a bucket
    is first compared with a hub, twice; what is linked forms a component, and
    only buckets with several components are left. Of these, small ones give
    their pairs; large ones are compared in blocks of about
    ``block_shingles`` shingles on either side, which return links only. So no
    candidate pair goes unchecked unless its ends are linked already, and no
    task holds more than two such blocks.

    Null or empty text and text without words: n_shingles 0, own component,
    kept. A row with null doc_id takes its set's component (null if no row of
    the set has an id) and is kept only where that is null. Rows with the same
    doc_id are one document. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketched = cut_lineage(sketches(docs, shingle_words, bands, rows, seed))
    filled = sketched.where("n_shingles > 0")
    sets = cut_lineage(filled.groupBy("set_key").agg(F.min("doc_id").alias("node")).where("node is not null"))
    nodes = filled.join(sets.withColumnRenamed("node", "doc_id"), ["set_key", "doc_id"])
    marks = nodes.select(F.col("doc_id").alias("node"), "n_shingles", F.explode("bands").alias("band"))
    several = marks.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    marks = cut_lineage(marks.join(several.select("band"), "band", "left_semi").distinct())
    wanted = marks.select("node").distinct()
    texts = docs.join(wanted, docs.doc_id == wanted.node, "left_semi").select(F.col("doc_id").alias("node"), "text")
    full = cut_lineage(texts.distinct().mapInArrow(_sets(shingle_words), "node long, shingles binary"))

    fits = (F.least("n_shingles", "n_hub") * 100 >= F.greatest("n_shingles", "n_hub") * percent) & (F.col("a") != F.col("b"))
    links = placed = None
    for turn in range(2):
        here = _unsettled(marks, placed)
        first = F.xxhash64("node", F.lit(turn)) if turn else F.col("node")
        hubs = here.groupBy("band").agg(F.min(F.struct(first.alias("first"), "node", "n_shingles", "component")).alias("hub"))
        hubs = hubs.select("band", F.col("hub.node").alias("b"), F.col("hub.n_shingles").alias("n_hub"), F.col("hub.component").alias("c_b"))
        pairs = here.withColumnRenamed("node", "a").join(hubs, "band").where("component <> c_b").where(fits)
        found = _links(pairs.groupBy("a").agg(F.min("b").alias("b")), full, percent)
        links = found if links is None else links.unionByName(found)
        placed = components(links)

    here = cut_lineage(_unsettled(marks, placed))
    sizes = here.groupBy("band").agg(F.count("*").alias("members"), F.sum("n_shingles").alias("total"))
    here = here.join(sizes, "band")
    small, large = here.where(F.col("members") <= PAIRED), here.where(F.col("members") > PAIRED)
    one = small.select("band", F.col("node").alias("a"), F.col("component").alias("c_a"), "n_shingles")
    two = small.select("band", F.col("node").alias("b"), F.col("component").alias("c_b"), F.col("n_shingles").alias("n_hub"))
    pairs = one.join(two, "band").where("c_a < c_b").where(fits).select("a", "b").distinct()
    parts = F.ceil(F.col("total") / block_shingles).cast("int")
    large = large.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    large = large.select("node", "component", "band", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    large = large.join(full, "node").groupBy("band", "i", "j").applyInArrow(_link_block(percent), "a long, b long")
    found = _links(pairs, full, percent).unionByName(cut_lineage(large.distinct()))
    placed = components(links.unionByName(found))

    named = sets.join(placed, "node", "left").select("set_key", F.coalesce("component", "node").alias("node"))
    out = sketched.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("node")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
