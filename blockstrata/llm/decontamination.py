"""Benchmark items inside documents by size-partitioned MinHash containment search."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..session import cut_lineage
from .words import CircularMinHash, blocks, common, mix, shingle_sets, texts_of, word_hashes

FOUND = "doc_id long, item_id long, shared long, n_shingles long, containment double"


class ItemIndex:
    """Signatures of items by size class; class c holds sets of 2**c to 2**(c+1) - 1 shingles."""

    def __init__(self, items, shingle_words, coordinates, seed):
        self.shingle_words, self.minhash = shingle_words, CircularMinHash(coordinates, seed)
        self.items = [(item_id, sets) for item_id, sets in items if len(sets)]
        self.classes = {}
        by_class = {}
        for i, (_, sets) in enumerate(self.items):
            by_class.setdefault(int(len(sets)).bit_length() - 1, []).append(i)
        salt = mix(np.arange(1, coordinates + 1, dtype=np.uint64))
        self.salt = salt
        for c, members in by_class.items():
            flat = np.concatenate([self.items[i][1] for i in members])
            sizes = np.array([len(self.items[i][1]) for i in members])
            signature = self.minhash.signatures(self.minhash.place(flat), np.cumsum(sizes) - sizes)
            keys = mix(signature.astype(np.uint64) ^ salt).reshape(-1)
            order = np.argsort(keys)
            self.classes[c] = keys[order], np.repeat(members, coordinates)[order]
        self.least = min(self.classes, default=0)

    def candidates(self, shingles, offsets):
        """(text, item) pairs that share a coordinate within a window of the item's class.

        ``shingles``: all shingles of a block of texts in order, text i from
        ``offsets[i]`` to ``offsets[i + 1]``.
        """
        found = []
        if not self.classes or not len(shingles):
            return []
        step = 1 << (self.least + 1)
        cells, owner = [], []
        for i, (lo, hi) in enumerate(zip(offsets[:-1], offsets[1:])):
            if hi > lo:
                cells.append(np.arange(lo, hi, step))
                owner.append(np.full(len(cells[-1]), i))
        cells, owner = np.concatenate(cells), np.concatenate(owner)
        least = self.minhash.signatures(self.minhash.place(shingles), cells)
        for c in range(self.least, max(self.classes) + 1):
            if c > self.least:  # two cells make a cell of the next class
                first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
                inside = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
                starts = np.flatnonzero(inside % 2 == 0)
                least, owner = np.minimum.reduceat(least, starts, axis=0), owner[starts]
            if c not in self.classes:
                continue
            # A window is two neighbouring cells, so any passage as long as an item lies in one.
            follows = np.concatenate((owner[1:] == owner[:-1], [False]))
            window = least.copy()
            window[follows] = np.minimum(least[follows], least[np.flatnonzero(follows) + 1])
            keys, members = self.classes[c]
            probe = mix(window.astype(np.uint64) ^ self.salt)
            at = np.searchsorted(keys, probe.reshape(-1))
            hit = np.flatnonzero(keys[np.minimum(at, len(keys) - 1)] == probe.reshape(-1))
            for h in hit:
                place, text = at[h], int(owner[h // probe.shape[1]])
                while place < len(keys) and keys[place] == keys[at[h]]:
                    found.append((text, int(members[place])))
                    place += 1
        return sorted(set(found))


def in_order(texts, shingle_words):
    """Shingles of a block of texts in order with repeats, and offsets by text."""
    hashes, offsets = word_hashes(texts)
    times = np.uint64(0xA24BAED4963EE407)
    whole = hashes
    for k in range(1, shingle_words):
        whole = whole[:-1] * times + hashes[k:] if len(hashes) > k else whole[:0]
    whole = mix(whole.copy())
    sizes = np.diff(offsets)
    parts = [whole[lo:lo + n - shingle_words + 1] if n >= shingle_words else shingle_sets([texts[i]], shingle_words)[0]
             for i, (lo, n) in enumerate(zip(offsets[:-1], sizes))]
    ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
    return np.concatenate(parts) if parts else hashes[:0], np.concatenate(([0], ends))


def _search(shared, percent):
    def run(batches):
        index = ItemIndex(*shared.value)
        for batch in batches:
            texts = texts_of(batch.column(1))
            for lo, hi in blocks(texts):
                ids = batch.column(0).slice(lo, hi - lo).to_pylist()
                shingles, offsets = in_order(texts[lo:hi], index.shingle_words)
                rows, last, mine = [], None, None
                for text, i in index.candidates(shingles, offsets):
                    if text != last:
                        last, mine = text, np.unique(shingles[offsets[text]:offsets[text + 1]])
                    item_id, wanted = index.items[i]
                    n = common(wanted, mine)
                    if 100 * n >= percent * len(wanted):
                        rows.append((ids[text], item_id, n, len(wanted), n / len(wanted)))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                columns = zip(*rows) if rows else ([],) * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 names=["doc_id", "item_id", "shared", "n_shingles", "containment"])
    return run


def find_items(docs, benchmark, shingle_words=5, percent=80, coordinates=64, block_bytes=16_000_000, seed=2):
    """Benchmark items whose shingles a document holds to at least ``percent`` %.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text. Returns
    doc_id, item_id, shared, n_shingles, containment (share of the item's
    shingles found in the whole document).

    Items are partitioned by the size of their shingle sets in powers of two.
    For each class a document is a row of overlapping windows, each up to four
    times the items' size, so a long document does not drown a short passage:
    an item that a window holds to 80 % has a Jaccard similarity of 0.19 or
    more with it, and all 64 coordinates miss it once in a million. A shared
    coordinate makes a candidate; it is checked on the full sets. Signatures of
    larger windows are minima of smaller ones, so every shingle is hashed once.
    Items are sent to all tasks in blocks of about ``block_bytes``, one pass
    over the documents each; documents do not move.

    Null or wordless documents and items match nothing; a text of fewer words
    than a shingle has its whole sequence as its only shingle. Repeated rows
    give repeated results, an item's repeated id too. Empty tables give no rows.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    spark, passes, held, size = docs.sparkSession, [], [], 0

    def add():
        nonlocal held, size
        shared = spark.sparkContext.broadcast((held, shingle_words, coordinates, seed))
        passes.append(plain.mapInArrow(_search(shared, percent), FOUND))
        held, size = [], 0
    for row in items.toLocalIterator():
        text = row["text"].encode()
        held.append((row["item_id"], shingle_sets([text], shingle_words)[0]))
        size += 8 * len(held[-1][1]) + 8 * coordinates
        if size >= block_bytes:
            add()
    if held or not passes:
        add()
    out = passes[0]
    for more in passes[1:]:
        out = cut_lineage(out).unionByName(more)
    return out
