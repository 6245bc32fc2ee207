"""Piece ids and decoded texts against the library, and texts put together again."""

import random

import pytest

from blockstrata.llm.pieces import PieceModel, WordTable, decode_ids, encode_texts
from blockstrata.llm.queries import vocabulary
from helpers import docs_table

PATH = vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=PATH)


def odd_texts():
    rnd = random.Random(9)
    parts = [" ", "  ", "▁", "\n", "\t", "\0", "the", "ing", "😀", "中文", "ﬁ", "<s>", "</s>", "<unk>", "<0x0A>", "　", "�", "한국", "----------", "é"]
    out = ["", " ", "   ", "▁", " a ", "a", "\n", "a" * 100_000, "ab " * 50_000, " " * 10_000 + "x" + " " * 10_000]
    for _ in range(600):
        out.append("".join(rnd.choice(parts) if rnd.random() < 0.6 else chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(0x80, 0xd800), rnd.randrange(0xe000, 0x110000)]))
                           for _ in range(rnd.choice([1, 4, 20, 80]))))
    return out


def test_texts_as_the_library(spark, library):
    texts = [None, *odd_texts(), *["the same row"] * 3]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (5, "an id again")]
    got = decode_ids(encode_texts(docs_table(spark, rows), PATH, most_words=50), PATH).collect()
    want = sorted((str(i), tuple(ids := library.encode(t or "", add_eos=True)), library.decode(ids)) for i, t in rows)
    assert sorted((str(r["doc_id"]), tuple(r["ids"]), r["text"]) for r in got) == want


def test_any_ids(spark, library):
    rnd = random.Random(2)
    some = lambda: rnd.choice([0, 1, 2, 35, 259, 28705, rnd.randrange(3, 259), rnd.randrange(3, 259), rnd.randrange(259, 32000)])
    rows = [(i, [some() for _ in range(rnd.randrange(9))]) for i in range(3000)] + [(-1, None)]
    got = {r["doc_id"]: r["text"] for r in decode_ids(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH).collect()}
    assert got == {i: library.decode(ids or []) for i, ids in rows}


def test_each_word_is_segmented_once(monkeypatch):
    table, seen = WordTable(PieceModel(PATH), 1000), []
    segment = table.model.segment_all
    monkeypatch.setattr(table.model, "segment_all", lambda words: seen.extend(words) or segment(words))
    table.encode([b"one two one", b"two  two", b""])
    table.encode([b"two one"])
    assert sorted(seen) == [b"  two", b" one", b" two"]


def test_words_together_as_words_alone():
    model, rnd = PieceModel(PATH), random.Random(4)
    words = list({(" " * rnd.randrange(1, 4) + "".join(rnd.choice("aeinrst hel😀中ßं0") for _ in range(rnd.randrange(0, 40))).replace(" ", "")).encode() for _ in range(3000)})
    ids, sizes = model.segment_all(words)
    cuts = [0, *sizes.cumsum().tolist()]
    assert [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == [model.segment(w) for w in words]
    assert [len(x) for x in model.segment_all([])] == [0, 0]


def test_other_models_are_refused(tmp_path):
    def field(number, kind, data):
        return bytes([number << 3 | kind]) + data

    def message(number, data):
        return field(number, 2, bytes([len(data)]) + data)
    def model(piece, trainer=field(3, 0, b"\2") + b"\x98\x02\x01", normal=field(4, 0, b"\0")):
        path = tmp_path / "m"
        path.write_bytes(message(1, message(1, piece.encode())) + message(2, trainer) + message(3, normal))
        return str(path)
    assert PieceModel(model("▁▁a")).ids == {"▁▁a": 0}
    for bad in (model("a▁"), ):
        with pytest.raises(ValueError):
            PieceModel(bad)
    with pytest.raises(ValueError):
        PieceModel(model("a", trainer=b"\x98\x02\x01"))
    with pytest.raises(ValueError):
        PieceModel(model("a", normal=b""))


def test_no_rows(spark):
    assert decode_ids(encode_texts(docs_table(spark, []), PATH), PATH).collect() == []
