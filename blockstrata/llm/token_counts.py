"""Token counts of texts: byte-pair merges on ragged arrays, all sequences at once."""

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from .words import blocks

#: White space of Unicode, which ends every piece.
WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: Characters that str.split takes for white space and Unicode does not.
SEPARATORS = "\x1c\x1d\x1e\x1f"
#: Fixed sequences that the vocabulary's rules split off first.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{L}\p{N}]+")


def byte_letters():
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class MergeTable:
    """Ranks and results of symbol pairs, looked up by sorted keys."""

    def __init__(self, spec):
        model = spec["model"]
        ids, end = dict(model["vocab"]), model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.inner = np.array([ids[letters[b]] for b in range(256)], dtype=np.int64)
        self.final = np.array([ids[letters[b] + end] for b in range(256)], dtype=np.int64)
        left = np.array([ids[a] for a, _ in merges], dtype=np.int64)
        right = np.array([ids[b] for _, b in merges], dtype=np.int64)
        result = np.array([ids[a + b] for a, b in merges], dtype=np.int64)
        keys = left << 32 | right
        self.keys, first = np.unique(keys, return_index=True)
        self.ranks, self.results = first.astype(np.int64), result[first]
        self.none = len(merges)

    def counts(self, words):
        """Symbols left of each word (byte strings, none of them empty).

        In every round each word merges all places of its lowest-ranked pair;
        a word without a pair in the table leaves the arrays.
        """
        out = np.zeros(len(words), dtype=np.int64)
        if not words:
            return out
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        symbols = self.inner[data]
        symbols[np.cumsum(sizes) - 1] = self.final[data[np.cumsum(sizes) - 1]]
        names = np.arange(len(words))
        while len(names):
            starts = np.cumsum(sizes) - sizes
            owner = np.repeat(np.arange(len(names)), sizes)
            pairs = symbols << 32
            pairs[:-1] |= symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
            rank = np.where(self.keys[at] == pairs, self.ranks[at], self.none)
            rank[np.cumsum(sizes) - 1] = self.none
            lowest = np.minimum.reduceat(rank, starts)
            merge = (rank == lowest[owner]) & (rank < self.none)
            # In a run of equal symbols only every second place merges, from the left.
            run = np.flatnonzero(merge[1:] & merge[:-1]) + 1
            for i in run:
                if merge[i - 1]:
                    merge[i] = False
            symbols[merge] = self.results[at[merge]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[1:] = ~merge[:-1]
            ended = lowest == self.none
            out[names[ended]] = sizes[ended]
            sizes = np.add.reduceat(keep.astype(np.int64), starts)[~ended]
            symbols, names = symbols[keep & ~ended[owner]], names[~ended]
        return out


def lowered(text):
    """Lower case letter by letter, without the rule for a final sigma."""
    return text.replace("Σ", "σ").lower()


def words_of(text):
    """Parts of a text between white space; no piece spans two of them."""
    if any(c in text for c in SEPARATORS):
        return [w for w in WHITE.split(text) if w]
    return text.split()


class Counter:
    """Tokens per word under a vocabulary; remembers up to ``most`` words."""

    def __init__(self, path, most=300_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.table, self.known, self.most = MergeTable(spec), {}, most
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.specials = re.compile("|".join(map(re.escape, specials))) if specials else None

    def _learn(self, words):
        pieces, owner, base = [], [], np.zeros(len(words), dtype=np.int64)
        for i, word in enumerate(words):
            parts = [word]
            if self.specials is not None and (found := self.specials.findall(word)):
                base[i], parts = len(found), self.specials.split(word)
            for part in parts:
                part = part if part.isascii() else unicodedata.normalize("NFC", part)
                for piece in PIECES.findall(lowered(part)):
                    pieces.append(piece.encode())
                    owner.append(i)
        if pieces:
            base += np.bincount(owner, self.table.counts(pieces), len(words)).astype(np.int64)
        self.known.update(zip(words, base.tolist()))

    def totals(self, texts):
        """Tokens of each text of a block."""
        split = [words_of(t) for t in texts]
        if len(self.known) > self.most:
            self.known = {}
        known = self.known
        self._learn(list({w for words in split for w in words if w not in known}))
        return [sum(map(known.__getitem__, words)) for words in split]


def _count(path):
    def run(batches):
        counter = Counter(path)
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            totals = []
            for lo, hi in blocks(texts):
                totals += counter.totals(texts[lo:hi])
            sizes = [len(t) if t.isascii() else len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64())],
                                             names=["doc_id", "n_bytes", "n_tokens"])
    return run


def count_tokens(docs, path, limit=2048):
    """Tokens of every row's whole text under a vocabulary file with word ends.

    ``path``: a file like word_bpe_49k.json that every worker can open (same
    place, or sent with ``addFile``). ``docs`` needs doc_id and text. Returns
    doc_id, n_bytes (UTF-8), n_tokens, over_limit (more tokens than ``limit``).

    Text is brought to NFC, white space folded, lower-cased and cut into pieces
    as the file's rules say; special strings in a text are one token each. The
    pieces of a block's words that were not met before are held as one ragged
    array; see MergeTable. Null counts as empty: no tokens. Repeated rows count alike.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = plain.mapInArrow(_count(path), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
