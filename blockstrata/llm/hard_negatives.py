"""Hard negatives of anchors: exact integer inner products looked up in subset-sum tables.

Eight dimensions make a group. For every anchor and group a table holds the sums
of all 256 subsets of the anchor's eight components. A candidate is packed as bit
planes: bit b of its components, eight dimensions to a byte. A plane's sum is one
lookup per group; planes are added with shifts, the sign plane negative. The
score is exact.
"""

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import cut_lineage, shared_folder

#: Bits of a byte as packbits lays them out: row v holds the bits of v, highest first.
SUBSETS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
#: Components of this size or more take no part: sums of 2 ** 15 products stay below 2 ** 63.
LARGEST = 2 ** 24
CANDIDATES, ANCHORS = 512, 256
NONE = np.iinfo(np.int64).min


def matrix(column, dims):
    """Rows of an Arrow list column as an int64 matrix, short ones filled up with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dims), dtype=np.int64)
    out[np.arange(dims) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def bit_planes(values):
    """Packed planes of a matrix of integers: planes x groups x rows; the last plane is the sign's."""
    top = int(max(values.max(initial=0), -1 - values.min(initial=0)))
    planes = top.bit_length() + 1
    bits = (values[None, :, :] >> np.arange(planes)[:, None, None]) & 1
    return np.ascontiguousarray(np.packbits(bits.astype(np.uint8), axis=2).transpose(0, 2, 1)).astype(np.intp)


class AnchorTables:
    """Subset sums of anchors by groups of eight dimensions, in chunks of anchors."""

    def __init__(self, values, chunks):
        """``values``: anchors x dims. ``chunks``: index arrays of the anchors scored together."""
        dims = -(-values.shape[1] // 8) * 8
        full = np.zeros((len(values), dims), dtype=np.int64)
        full[:, :values.shape[1]] = values
        reach = int(np.abs(full).sum(axis=1).max(initial=0))
        self.sum_type = np.int16 if reach < 2 ** 15 else np.int32 if reach < 2 ** 31 else np.int64
        self.reach, self.chunks = reach, chunks
        self.tables = [[np.ascontiguousarray((SUBSETS @ full[c, g:g + 8].T).astype(self.sum_type)) for g in range(0, dims, 8)]
                       for c in chunks]

    def scores(self, chunk, planes, rows):
        """Exact products of the anchors of a chunk with the candidates ``rows`` of ``planes``: candidates x anchors."""
        tables, size = self.tables[chunk], (len(rows), len(self.chunks[chunk]))
        wide = np.int32 if self.reach << len(planes) < 2 ** 31 else np.int64
        total = np.zeros(size, dtype=wide)
        plane, part = np.empty(size, dtype=self.sum_type), np.empty(size, dtype=self.sum_type)
        for b in range(len(planes) - 1, -1, -1):
            plane[:] = 0
            for g, table in enumerate(tables):
                np.take(table, planes[b, g, rows], axis=0, out=part, mode="clip")
                np.add(plane, part, out=plane)
            if b == len(planes) - 1:
                np.negative(plane, out=total, dtype=wide, casting="same_kind")
            else:
                np.left_shift(total, 1, out=total)
                np.add(total, plane, out=total)
        return total


class Best:
    """The ``keep`` best (score, id) of each of ``n`` lists; higher scores first, then smaller ids."""

    def __init__(self, n, keep):
        self.keep = keep
        self.scores = np.full((n, keep), NONE)
        self.ids = np.zeros((n, keep), dtype=np.int64)

    def add(self, lists, scores, ids):
        if not len(lists):
            return
        touched = np.unique(lists)
        had = self.scores[touched] != NONE
        all_lists = np.concatenate((lists, np.repeat(touched, self.keep)[had.ravel()]))
        all_scores = np.concatenate((scores.astype(np.int64), self.scores[touched][had]))
        all_ids = np.concatenate((ids, self.ids[touched][had]))
        order = np.lexsort((all_ids, -all_scores, all_lists))
        all_lists = all_lists[order]
        starts = np.flatnonzero(np.concatenate(([True], all_lists[1:] != all_lists[:-1])))
        place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
        kept = place < self.keep
        self.scores[touched], order = NONE, order[kept]
        self.scores[all_lists[kept], place[kept]] = all_scores[order]
        self.ids[all_lists[kept], place[kept]] = all_ids[order]

    def last(self, lists):
        """The score that a later candidate of a larger id must exceed."""
        return self.scores[lists, -1]

    def filled(self):
        at, place = np.nonzero(self.scores != NONE)
        return at, self.ids[at, place], self.scores[at, place]


def _bound(values, like):
    """Bounds in the type of the scores they are compared with; what lies beyond that type becomes its end."""
    ends = np.iinfo(like.dtype)
    return np.clip(values, ends.min, ends.max).astype(like.dtype)


def _chunks(index, most=ANCHORS):
    return [index[i:i + most] for i in range(0, len(index), most)]


def _batches(batches, dims):
    for batch in batches:
        if batch.num_rows:
            yield (batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False),
                   bit_planes(matrix(batch.column(2), dims)))


def _positives(sent, dims, keep):
    """Best rows of each anchor's own label among a task's rows, which come by rising id."""
    def run(batches):
        ids, labels, values = sent.value
        chunks = [c for x in np.unique(labels) for c in _chunks(np.flatnonzero(labels == x))]
        tables, best = AnchorTables(values, chunks), Best(len(ids), keep)
        for row_ids, row_labels, planes in _batches(batches, dims):
            members = {x: np.flatnonzero(row_labels == x) for x in np.unique(row_labels)}
            for k, chunk in enumerate(chunks):
                for rows in _chunks(members.get(labels[chunk[0]], row_ids[:0]), CANDIDATES):
                    scores = tables.scores(k, planes, rows)
                    hit = (scores > _bound(best.last(chunk), scores)) & (row_ids[rows][:, None] != ids[chunk])
                    row, col = np.nonzero(hit)
                    best.add(chunk[col], scores[row, col], row_ids[rows][row])
        at, found, scores = best.filled()
        yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(found), pa.array(scores)],
                                         names=["anchor_id", "positive_id", "positive_score"])
    return run


def _negatives(sent, dims, keep, low, high):
    """Best rows of other labels within the band of each positive, among a task's rows by rising id."""
    def run(batches):
        ids, labels, values, positive_ids, positive_scores = sent.value
        slots = positive_scores.shape[1]
        taken = positive_scores != NONE
        known = np.where(taken, positive_scores, 0)
        least, most = -(-low * known // 100), np.where(taken, high * known // 100, NONE)
        chunks = _chunks(np.arange(len(ids)))
        tables, best = AnchorTables(values, chunks), Best(len(ids) * slots, keep)
        for row_ids, row_labels, planes in _batches(batches, dims):
            for rows in _chunks(np.arange(len(row_ids)), CANDIDATES):
                for k, chunk in enumerate(chunks):
                    scores = tables.scores(k, planes, rows)
                    other = row_labels[rows][:, None] != labels[chunk]
                    for s in range(slots):
                        floor = np.maximum(best.last(chunk * slots + s), least[chunk, s] - 1)
                        row, col = np.nonzero((scores > _bound(floor, scores)) & (scores <= _bound(most[chunk, s], scores)) & other)
                        best.add(chunk[col] * slots + s, scores[row, col], row_ids[rows][row])
        at, found, scores = best.filled()
        anchor, slot = np.divmod(at, slots)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[anchor]), pa.array(positive_ids[anchor, slot]), pa.array(positive_scores[anchor, slot]),
             pa.array(found), pa.array(scores)],
            names=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])
    return run


def _first(df, keys, score, row, keep):
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), row)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def quantised(vectors, scale=256):
    """vec_id, label, q: floor(scale * component) of the rows that take part, one row for each vec_id."""
    full = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    whole = full.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
                       & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < LARGEST)))
    rows = whole.select("vec_id", "label", F.transform("embedding", lambda x: F.floor(x * scale)).alias("q"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r")).select("vec_id", "r.label", "r.q")


def mine_negatives(vectors, every=50, positives=5, negatives=3, low=50, high=95, scale=256, table_bytes=2 ** 26):
    """Negatives that score within a band below each positive of each anchor.

    ``vectors``: vec_id, label, embedding (floats). Anchors are rows whose
    vec_id is divisible by ``every``. Components count as floor(scale * x). An
    anchor's positives are its ``positives`` best other rows of its label; for
    each, the ``negatives`` best rows of other labels with
    low * positive <= 100 * negative <= high * positive. Best: higher inner
    product, then smaller vec_id. Returns anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.

    Every row is scored with every anchor. Anchors are taken in passes whose
    tables stay below ``table_bytes``; a pass's anchors go to all tasks and each
    task returns at most its best rows of each anchor. Other columns are ignored.
    Rows with a null vec_id, label or vector, a null or non-finite component, or
    one of 2 ** 24 / scale or more, take no part. Missing components of shorter
    vectors count as 0. Of rows that repeat a vec_id the smallest (label, then
    vector) counts. An empty table, or one without anchors, gives no rows.
    """
    spark = vectors.sparkSession
    rows = cut_lineage(quantised(vectors, scale))
    shape = rows.agg(F.max(F.size("q")).alias("dims"), F.count_if(F.col("vec_id") % every == 0).alias("anchors")).first()
    dims, folder = max(shape["dims"] or 0, 1), f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    most = max(ANCHORS, table_bytes // (-(-dims // 8) * 256 * 4))
    passes = -(-shape["anchors"] // most)
    context, ordered = spark.sparkContext, rows.sortWithinPartitions("vec_id")
    for k in range(passes):
        own = rows.where((F.col("vec_id") % every == 0) & (F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == k)).orderBy("vec_id").toArrow()
        own = own.combine_chunks().to_batches()
        if not own:
            continue
        ids, labels = own[0].column(0).to_numpy(), own[0].column(1).to_numpy()
        values = matrix(own[0].column(2), dims)
        sent = context.broadcast((ids, labels, values))
        found = ordered.mapInArrow(_positives(sent, dims, positives), "anchor_id long, positive_id long, positive_score long")
        best = _first(found, ["anchor_id"], "positive_score", "positive_id", positives).toPandas()
        sent.unpersist()
        ranked = np.zeros((len(ids), positives), dtype=np.int64), np.full((len(ids), positives), NONE)
        at = np.searchsorted(ids, best["anchor_id"].to_numpy()), best["rank"].to_numpy() - 1
        ranked[0][at], ranked[1][at] = best["positive_id"].to_numpy(), best["positive_score"].to_numpy()
        sent = context.broadcast((ids, labels, values, *ranked))
        found = ordered.mapInArrow(_negatives(sent, dims, negatives, low, high),
                                   "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
        _first(found, ["anchor_id", "positive_id", "positive_score"], "negative_score", "negative_id", negatives).select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").write.parquet(f"{folder}/{k}")
        sent.unpersist()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not passes:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/*")
