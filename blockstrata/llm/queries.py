"""Named queries of this subpackage with the SQL that states the same result."""

import os

from pyspark.sql import functions as F

from . import archives as _archives
from . import decontamination as _decontamination
from . import exact_dedup as _exact
from . import hard_negatives as _hard
from . import language as _language
from . import lm_scores as _lm
from . import mixing as _mixing
from . import near_dedup as _near
from . import phrases as _phrases
from . import pieces as _pieces
from . import quality as _quality
from . import surrogates as _surrogates
from . import token_counts as _tokens

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

NEAR_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
sets AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END)) AS s FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT s.a, s.b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b
    WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT d.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id
"""


@query("op1_near_duplicates", NEAR_SQL)
def op1_near_duplicates(spark, sf_dir):
    """Near-duplicate components of all documents on four-word shingles."""
    return _near.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=4, percent=80)


@query("op2_surrogates")
def op2_surrogates(spark, sf_dir):
    """All documents with personal data replaced by surrogates."""
    return _surrogates.replace_entities(_table(spark, sf_dir, "documents"))


EXACT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY plain ORDER BY length(text) DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY plain)::BIGINT AS group_size,
    doc_id = first_value(doc_id) OVER (PARTITION BY plain ORDER BY length(text) DESC, doc_id) AS kept,
    sha256(plain) AS text_sha256
FROM d
"""


@query("op3_exact_duplicates", EXACT_SQL)
def op3_exact_duplicates(spark, sf_dir):
    """Groups of all documents that are equal without white space."""
    return _exact.exact_duplicates(_table(spark, sf_dir, "documents"))


@query("op4_mixture")
def op4_mixture(spark, sf_dir):
    """Words that a mixture of all sources takes from each document."""
    return _mixing.mix_sources(_table(spark, sf_dir, "documents"), weights=(5, 2, 1), most=3)


@query("op5_web_archives")
def op5_web_archives(spark, sf_dir):
    """All pages written as packed web archives and read back."""
    packages = _archives.write_packages(_table(spark, sf_dir, "pages"))
    return _archives.read_packages(packages, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _fold(n):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


@query("op6_quality")
def op6_quality(spark, sf_dir):
    """Quality of all documents, learned from two thirds of the labels."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = _quality.train_quality(docs, labels.where(_fold(3) != 1))
    return _quality.score_quality(docs, model).select(
        "doc_id", (_fold(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op7_languages")
def op7_languages(spark, sf_dir):
    """Language of all documents, learned from three quarters of them."""
    docs = _table(spark, sf_dir, "documents")
    model = _language.train_languages(docs.where(_fold(4) != 2))
    return _language.identify_languages(docs, model).select(
        "doc_id", (_fold(4) == 2).alias("held_out"), "lang_pred", "score")


@query("op8_language_model")
def op8_language_model(spark, sf_dir):
    """Scores of all documents under a model of six sevenths of them."""
    docs = _table(spark, sf_dir, "documents")
    model = _lm.train(docs.where(_fold(7) != 2))
    return _lm.score(docs, model).withColumn("held_out", _fold(7) == 2)


LEAKS_SQL = f"""
WITH items AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark), docs AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
wanted AS (SELECT item_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s FROM items),
held AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM docs)
    WHERE s IN (SELECT s FROM wanted)),
sizes AS (SELECT item_id, count(*) AS n FROM wanted GROUP BY item_id),
found AS (SELECT doc_id, item_id, count(*) AS shared FROM held JOIN wanted USING (s) GROUP BY ALL)
SELECT doc_id, item_id, shared::BIGINT AS shared, n::BIGINT AS n_shingles, shared / n AS containment
FROM found JOIN sizes USING (item_id) WHERE 100 * shared >= 80 * n
"""


@query("op9_benchmark_leaks", LEAKS_SQL)
def op9_benchmark_leaks(spark, sf_dir):
    """Benchmark items that documents hold."""
    return _decontamination.find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def vocabulary(name="word_bpe_49k.json"):
    """Place of a vocabulary file: in the folder that BLOCKSTRATA_TOKENIZERS names, or else among the installed ones."""
    folder = os.environ.get("BLOCKSTRATA_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op10_token_counts")
def op10_token_counts(spark, sf_dir):
    """Tokens of all documents."""
    return _tokens.count_tokens(_table(spark, sf_dir, "documents"), vocabulary(), limit=2048)


HARD_SQL = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END::BIGINT AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS other_id, b.label AS label,
    list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE label = own
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE label <> own AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 3
"""


@query("op11_hard_negatives", HARD_SQL)
def op11_hard_negatives(spark, sf_dir):
    """Hard negatives of every fiftieth vector among all vectors."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return _hard.mine_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", moved))


PHRASES_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
g AS (SELECT lang, unnest(flatten(list_transform([1, 2, 3, 4], lambda k: list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])))) AS g FROM p),
f AS (SELECT lang, g, len(g) AS size, count(*) AS a FROM g GROUP BY ALL),
c AS (SELECT * FROM f WHERE a >= 30),
words AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
cuts AS (SELECT c.lang, c.g, c.a, k, x.a AS l, y.a AS r, ((2000000::HUGEINT * c.a) // (x.a + y.a))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM c WHERE size > 1) c
    JOIN c x ON x.lang = c.lang AND x.g = c.g[1:k] JOIN c y ON y.lang = c.lang AND y.g = c.g[k + 1:]),
low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_ AS (SELECT DISTINCT s.lang, s.g FROM (SELECT lang, a, unnest(flatten(list_transform(range(2, size), lambda k:
    list_transform(range(1, size - k + 2), lambda i: g[i:i + k - 1])))) AS g FROM c WHERE size > 2) s
    JOIN c o ON o.lang = s.lang AND o.g = s.g WHERE 100 * s.a >= 80 * o.a)
SELECT lang, (row_number() OVER w)::INTEGER AS rank, array_to_string(g, ' ') AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score
FROM low ANTI JOIN inner_ USING (lang, g) JOIN words USING (lang)
WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' '))
QUALIFY row_number() OVER w <= 2000
"""


@query("op12_collocations", PHRASES_SQL)
def op12_collocations(spark, sf_dir):
    """Phrases of all documents whose words stay together, by language."""
    return _phrases.collocations(_table(spark, sf_dir, "documents"), least=30, longest=4, inside_percent=80, most=2000)


@query("op13_pieces")
def op13_pieces(spark, sf_dir):
    """Digests of the piece ids of all documents and of the texts they decode to."""
    path = vocabulary("piece_bpe_32k.model")
    decoded = _pieces.decode_ids(_pieces.encode_texts(_table(spark, sf_dir, "documents"), path), path)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                          F.sha2("text", 256).alias("decoded_sha256"))
