"""The registered queries on the smallest tables against SQL and brute force."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import pandas as pd
import pytest

import oracle
from blockstrata.llm import queries as Q
from helpers import words
from test_mixing import brute_targets

SF = "/root/testdata/sf0.001"


def table(name):
    return pd.read_parquet(f"{SF}/{name}.parquet")


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def rows(spark, name):
    return Q.QUERIES[name](spark, SF).collect()


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_against_sql(spark, name):
    differences, _ = oracle.compare(spark, oracle.connect(SF), SF, Q.QUERIES[name], Q.ORACLES[name])
    assert not differences


def test_surrogates(spark):
    texts = dict(zip(table("documents").doc_id, table("documents").text))
    private = re.compile(r"[a-z.0-9]+@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}|\b\d{16}\b|AKIA[A-Z0-9]{12,}|(?<=password=)[0-9a-f]+|(?<=token = \")[0-9a-f]+")
    got = rows(spark, "op2_surrogates")
    assert len(got) == len(texts)
    for r in got:
        found = private.findall(texts[r["doc_id"]])
        assert not [f for f in found if f in r["text"]]
        assert (r["n_entities"] > 0) or (not found and r["text"] == texts[r["doc_id"]])


def test_mixture(spark):
    docs = table("documents")
    size = {i: len(words(t)) for i, t in zip(docs.doc_id, docs.text)}
    sizes = Counter()
    for i, s in zip(docs.doc_id, docs.source):
        sizes[s] += size[i]
    want, taken = brute_targets(sizes, (5, 2, 1), 3), Counter()
    source = dict(zip(docs.doc_id, docs.source))
    got = rows(spark, "op4_mixture")
    assert len(got) == len(docs)
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sizes[s] and math.isclose(r["target"], want[s])
        assert r["size"] == 0 or r["taken"] % r["size"] == 0 and r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= max(2, 0.02 * want[s]) for s in sizes)


def test_archives(spark):
    pages = table("pages")
    first = pages.groupby("html").page_id.min()
    got = {r["page_id"]: r for r in rows(spark, "op5_web_archives")}
    assert len(got) == len(pages)
    for page_id, html in zip(pages.page_id, pages.html):
        r, body = got[page_id], html.encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first[html] == page_id else ("revisit", first[html]))


def test_quality(spark):
    quality = dict(zip(table("labels").doc_id, table("labels").quality))
    got = rows(spark, "op6_quality")
    assert len(got) == len(table("documents"))
    for r in got:
        assert r["held_out"] == (fold(r["doc_id"], 3) == 1) and r["predicted"] == int(r["score"] >= 0.5)
    held = [r["predicted"] == quality[r["doc_id"]] for r in got if r["held_out"] and r["doc_id"] in quality]
    assert sum(held) >= 0.9 * len(held)


def test_languages(spark):
    lang = dict(zip(table("documents").doc_id, table("documents").lang))
    got = rows(spark, "op7_languages")
    assert all(r["held_out"] == (fold(r["doc_id"], 4) == 2) for r in got)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in got if r["held_out"]]
    assert sum(held) >= 0.95 * len(held)


def test_language_model(spark):
    docs = {i: [*words(t), None] for i, t in zip(table("documents").doc_id, table("documents").text)}
    counts = Counter(w for i, own in docs.items() if fold(i, 7) != 2 for w in own)
    total = sum(counts.values())
    got, better = rows(spark, "op8_language_model"), 0
    assert len(got) == len(docs)
    for r in got:
        own = docs[r["doc_id"]]
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in own)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(counts[w] > 0 for w in own), total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["held_out"] == (fold(r["doc_id"], 7) == 2)
        better += (r["score"] - r["base_score"]) * r["held_out"]
    assert better > 0


def test_token_counts(spark):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(Q.vocabulary())
    texts = dict(zip(table("documents").doc_id, table("documents").text))
    for r in rows(spark, "op10_token_counts"):
        n = len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 2048)


def test_pieces(spark):
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=Q.vocabulary("piece_bpe_32k.model"))
    texts, got = dict(zip(table("documents").doc_id, table("documents").text)), rows(spark, "op13_pieces")
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]], add_eos=True)
        sums = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids))]
        assert [r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]] == [len(ids), *sums]
