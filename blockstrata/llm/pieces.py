"""Encoding and decoding with the pieces of a SentencePiece model, by a table of distinct words.

A marker stands for each space. Where no piece of a model has a marker after
another letter, no merge reaches across the begin of a run of markers, so a text
is the sequence of its marked words: a run of markers and what follows it. Each
distinct marked word is segmented once; texts are put together from the table
by position.
"""

import codecs
import heapq
import re
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .words import blocks, texts_of

MARKER = "▁"
MARKED = re.compile(rb" +[^ ]*")
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
NONE = 1 << 30
#: What an unknown piece is decoded to.
UNKNOWN_TEXT = " ⁇ ".encode()
#: Words up to this many letters are merged together as arrays, longer ones singly with a heap.
SHORT = 64
#: Symbols from here on are letters without a piece of their own.
LETTER = 1 << 21

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


def fields(data):
    """(number, value) of the fields of a protocol buffer message; submessages and strings as bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7
    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        else:
            size = {1: 8, 5: 4}.get(kind)
            size = varint() if size is None else size
            value, at = data[at:at + size], at + size
        yield key >> 3, value


class PieceModel:
    """Pieces of a model file: byte-pair merges, bytes for letters it does not know, spaces kept as they are."""

    def __init__(self, path):
        with open(path, "rb") as f:
            parts = list(fields(f.read()))
        trainer, normal = ({k: v for p, v in parts if p == n for k, v in fields(v)} for n in (2, 3))
        if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or trainer.get(24, 0):
            raise ValueError("the model must merge pairs, fall back to bytes and mark the begin of words")
        if normal.get(2) or normal.get(4, 1) or not normal.get(3, 1) or not normal.get(5, 1):
            raise ValueError("the model must keep letters and spaces as they are and mark the begin of a text")
        self.text, self.ids, self.scores, self.bytes, kinds = [], {}, {}, {}, []
        for number, value in parts:
            if number != 1:
                continue
            piece = dict(fields(value))
            text, kind, own = piece[1].decode(), piece.get(3, NORMAL), len(self.text)
            kinds.append(kind)
            if kind == NORMAL:
                if MARKER in text.lstrip(MARKER):
                    raise ValueError("a piece spans the begin of a word")
                self.ids[text], self.scores[text] = own, struct.unpack("<f", piece.get(2, bytes(4)))[0]
                self.text.append(text.replace(MARKER, " ").encode())
            elif kind == BYTE:
                self.bytes[int(text[3:5], 16)] = own
                self.text.append(bytes([int(text[3:5], 16)]))
            elif kind in (UNKNOWN, CONTROL):
                self.text.append(UNKNOWN_TEXT if kind == UNKNOWN else b"")
            else:
                raise ValueError("pieces given by users are not known here")
        self.end = int(trainer.get(42, 2))
        #: Neighbours that some piece holds; no merge reaches across any others.
        self.together = {text[i:i + 2] for text in self.ids for i in range(len(text) - 1)}
        self._pairs()

    def _pairs(self):
        """Tables of letters, and of symbol pairs with the rank of their score and the piece that they make."""
        self.letters = np.arange(LETTER, LETTER + 0x110000)
        for text, own in self.ids.items():
            if len(text) == 1:
                self.letters[ord(text)] = own
        symbol = lambda t: int(self.letters[ord(t)]) if len(t) == 1 else self.ids.get(t)
        rank = {v: i for i, v in enumerate(sorted(set(self.scores.values()), reverse=True))}
        found = sorted((left << 32 | right, rank[self.scores[text]], own) for text, own in self.ids.items() for i in range(1, len(text))
                       if (left := symbol(text[:i])) is not None and (right := symbol(text[i:])) is not None)
        self.pair_keys, self.pair_ranks, self.pair_pieces = np.array(found, dtype=np.int64).reshape(-1, 3).T.copy()

    def _ranks(self, left, right):
        """Ranks of symbol pairs and what they make; a pair of no piece has the rank NONE."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), max(len(self.pair_keys) - 1, 0))
        if not len(self.pair_keys):
            return np.full(len(keys), NONE), at
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE), self.pair_pieces[at]

    def segment_all(self, words):
        """Ids of many marked words in a row, and how many each has.

        In every round each word merges its best pair, of equal ones the
        leftmost; words without one leave the arrays.
        """
        out = [None] * len(words)
        short = []
        for i, w in enumerate(words):
            if len(w) > SHORT:
                out[i] = self.segment(w)
            else:
                short.append(i)
        texts = [words[i].decode().replace(" ", MARKER) for i in short]
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        symbols = self.letters[np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)]
        names, done = np.array(short, dtype=np.int64), []
        starts = np.cumsum(sizes) - sizes
        ranks, makes = self._ranks(symbols, np.append(symbols[1:], 0))
        ranks[starts + sizes - 1] = NONE
        while len(names):
            best = np.minimum.reduceat(ranks << 32 | np.arange(len(symbols)), starts)
            ended = best >> 32 >= NONE
            if ended.any():
                own = np.repeat(ended, sizes)
                done.append((names[ended], sizes[ended], symbols[own]))
                # What stays moves up by the symbols that leave before it.
                gone = np.cumsum(np.where(ended, sizes, 0))[~ended]
                symbols, ranks, makes, best = symbols[~own], ranks[~own], makes[~own], best[~ended] - gone
                names, sizes = names[~ended], sizes[~ended]
                if not len(names):
                    break
            at = best & 0xFFFFFFFF
            symbols[at] = makes[at]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            symbols, ranks, makes = symbols[keep], ranks[keep], makes[keep]
            at -= np.arange(len(at))
            sizes -= 1
            starts = np.cumsum(sizes) - sizes
            last = starts + sizes - 1
            near = np.concatenate((at[at < last], at[at > starts] - 1))
            ranks[near], makes[near] = self._ranks(symbols[near], symbols[near + 1])
            ranks[last] = NONE
        for own, each, ids in done:
            cuts = np.cumsum(each) - each
            for i, lo, n in zip(own.tolist(), cuts.tolist(), each.tolist()):
                out[i] = ids[lo:lo + n]
        sizes = np.array([len(x) for x in out], dtype=np.int64)
        ids = np.concatenate([np.zeros(0, np.int64), *out]) if out else np.zeros(0, np.int64)
        odd = np.flatnonzero(ids >= LETTER)
        if len(odd):
            spelled = [[self.bytes[b] for b in chr(c).encode()] for c in (ids[odd] - LETTER).tolist()]
            more = np.array([len(x) for x in spelled])
            owner = np.repeat(np.arange(len(out)), sizes)
            np.add.at(sizes, owner[odd], more - 1)
            wide = np.ones(len(ids), dtype=np.int64)
            wide[odd] = more
            ids, first = np.repeat(ids, wide), (np.cumsum(wide) - wide)[odd]
            ids[np.repeat(first - np.cumsum(more) + more, more) + np.arange(more.sum())] = np.concatenate([np.array(x) for x in spelled])
        return ids, sizes

    def segment(self, word):
        """Piece ids of a marked word, its markers given as spaces."""
        text, out, begin = word.decode().replace(" ", MARKER), [], 0
        for i in range(1, len(text) + 1):
            if i == len(text) or text[i - 1:i + 1] not in self.together:
                part = [text[begin:i]] if i - begin == 1 else self.merged(text[begin:i])
                begin = i
                for symbol in part:
                    own = self.ids.get(symbol)
                    if own is None:
                        out.extend(self.bytes[b] for b in symbol.encode())
                    else:
                        out.append(own)
        return out

    def merged(self, text):
        """Symbols of a run of letters; the best pair merges first, of equal ones the leftmost."""
        scores, symbols, n = self.scores, list(text), len(text)
        after, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def offer(i, j):
            if i >= 0 and j < n:
                score = scores.get(symbols[i] + symbols[j])
                if score is not None:
                    heapq.heappush(heap, (-score, i, j, len(symbols[i]) + len(symbols[j])))
        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, size = heapq.heappop(heap)
            if not symbols[i] or not symbols[j] or len(symbols[i]) + len(symbols[j]) != size:
                continue
            symbols[i] += symbols[j]
            symbols[j] = ""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [s for s in symbols if s]


def _gather(values, begins, sizes):
    """The runs of ``values`` that start at ``begins``, one after the other."""
    ends = np.cumsum(sizes)
    return values[np.repeat(begins - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


class WordTable:
    """Ids of the distinct marked words met so far; begun anew beyond ``most`` words."""

    def __init__(self, model, most):
        self.model, self.most = model, most
        self.clear()

    def clear(self):
        self.places = {}
        self.flat, self.begins, self.sizes = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def learn(self, words):
        """Segment the words that are new here."""
        new = [w for w in words if w not in self.places]
        flat, sizes = self.model.segment_all(new)
        self.places.update(zip(new, range(len(self.sizes), len(self.sizes) + len(new))))
        self.begins = np.concatenate((self.begins, len(self.flat) + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.flat = np.concatenate((self.flat, flat))

    def encode(self, texts):
        """Ids of all texts of a block in a row, and how many each has; the end id closes each."""
        marked = [MARKED.findall(b" " + t.replace(MARKER.encode(), b" ")) if t else [] for t in texts]
        if len(self.places) > self.most:
            self.clear()
        self.learn(set().union(*marked))
        places, sizes = self.places, self.sizes
        counts = np.array([len(m) for m in marked], dtype=np.int64)
        at = np.fromiter(map(places.__getitem__, chain.from_iterable(marked)), dtype=np.int64, count=int(counts.sum()))
        ids = _gather(self.flat, self.begins[at], sizes[at])
        bounds = np.concatenate(([0], np.cumsum(sizes[at])))[np.concatenate(([0], np.cumsum(counts)))]
        return np.insert(ids, bounds[1:], self.model.end).astype(np.int32), np.diff(bounds) + 1


def _encode(path, most):
    def run(batches):
        table = WordTable(PieceModel(path), most)
        for batch in batches:
            texts, ids, sizes = texts_of(batch.column(1)), [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
            for lo, hi in blocks(texts):
                own, each = table.encode(texts[lo:hi])
                ids.append(own)
                sizes.append(each)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(sizes)).astype(np.int32)), pa.array(np.concatenate(ids)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "ids"])
    return run


def encode_texts(docs, path, most_words=300_000):
    """Piece ids of every row's whole text with an end id: doc_id, ids.

    ``path``: a model file that every worker can open. ``docs`` needs doc_id and
    text; other columns are ignored. A task holds a table of the distinct marked
    words it has met (begun anew beyond ``most_words``), segments each once and
    joins ids back by position. Null and empty texts have the end id only;
    repeated rows are encoded alike; an empty table gives no rows. A model whose
    pieces reach across markers, or that changes texts first, is refused.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(_encode(path, most_words), "doc_id long, ids array<int>")


class PieceTexts:
    """Bytes of all pieces of a model, to put texts together."""

    def __init__(self, model):
        self.flat = np.frombuffer(b"".join(model.text), dtype=np.uint8)
        self.sizes = np.array([len(t) for t in model.text], dtype=np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.marked = np.zeros(len(model.text), dtype=bool)
        self.marked[[i for t, i in model.ids.items() if t[0] == MARKER]] = True

    def decode(self, ids, counts):
        """Texts of rows of ids, ``counts`` ids each. The marker that opens a text is left out."""
        sizes = self.sizes[ids]
        data = _gather(self.flat, self.begins[ids], sizes).tobytes()
        rows = np.concatenate(([0], np.cumsum(counts)))
        bounds = np.concatenate(([0], np.cumsum(sizes)))[rows]
        written = np.flatnonzero(sizes > 0)
        first = np.searchsorted(written, rows[:-1])
        opens = np.zeros(len(counts), dtype=np.int64)
        some = bounds[1:] > bounds[:-1]
        opens[some] = self.marked[ids[written[first[some]]]]
        # Bytes on both sides of a control id never form one letter.
        ends = np.concatenate(([0], np.cumsum(sizes)))[np.flatnonzero(sizes == 0)]
        cuts = np.unique(np.concatenate((bounds, ends))).tolist()
        text = {lo: data[lo:hi].decode("utf-8", "each_byte") for lo, hi in zip(cuts, cuts[1:])}
        at = np.searchsorted(cuts, bounds).tolist()
        whole = ["".join(text[c] for c in cuts[i:j]) for i, j in zip(at, at[1:])]
        return [t[1:] if o else t for t, o in zip(whole, opens.tolist())]


def _decode(path):
    def run(batches):
        table = PieceTexts(PieceModel(path))
        for batch in batches:
            lists = batch.column(1)
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            begins, texts = np.concatenate(([0], np.cumsum(counts))), []
            for lo in range(0, len(counts), 256):
                hi = min(lo + 256, len(counts))
                texts += table.decode(ids[begins[lo]:begins[hi]], counts[lo:hi])
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])
    return run


def decode_ids(encoded, path):
    """Text of every row's ids: doc_id, ids, text. Null and empty lists give an empty text.

    Bytes that form no letter become U+FFFD each; control ids give nothing.
    Ids that the model has not are an error.
    """
    return encoded.select("doc_id", "ids").mapInArrow(_decode(path), "doc_id long, ids array<int>, text string")
