"""One query per operator, over its whole table with production parameters: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgeo.llm import ann, bpe, divergence, langid, linededup, mixing, phrases, quality, secrets, simhash, substrings, toxicity, warc
from docgeo.llm.common import table
from docgeo.session import new_table_path


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every vector whose id is divisible by 20."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0, k=20)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 4-word shingles, 4 bits or fewer apart."""
    out = simhash.simhash_classes(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated weight, probability and fate of every document under the default mix."""
    docs = table(spark, sf_dir, "documents")
    return mixing.sample(mixing.labelled(docs, [docs["doc_id"]]), F.col("doc_id"), mixing.Mix())


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every web page (all evidence) and of every document (text and source)."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = langid.train(docs)
    none = F.lit(None).cast("long")
    of_pages = langid.page_evidence(F.col("url"), F.col("html"))
    of_docs = langid.document_evidence(F.col("text"), F.col("source"))
    rows = docs.select("doc_id", none.alias("page_id"), *[c.alias(k) for k, c in of_docs.items()]).unionByName(
        pages.select(none.alias("doc_id"), "page_id", *[c.alias(k) for k, c in of_pages.items()])
    )
    return langid.identify(rows, model, ["doc_id", "page_id"])


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document; digests of the ids and of the decoded text."""
    out = bpe.bpe_encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of the rule cascade for every document."""
    out = quality.quality(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels that are not held out."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as WARC archives in the shared folder, read them back, one row per record."""
    path = new_table_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    page = lambda c: F.nullif(F.regexp_extract(c, "^<urn:page:(-?[0-9]*)>$", 1), F.lit("")).cast("long")
    return warc.read_archives(spark, path).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), page("refers_to").alias("refers_to")
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the base spans, and all spans."""
    out = secrets.find_secrets(table(spark, sf_dir, "documents"))
    n = [secrets.count_kind("spans", k).alias(f"n_{k}") for k in secrets.KINDS[:3]]
    base = secrets.span_list(F.filter("spans", lambda x: x["rank"] < 3))
    return out.select("doc_id", *n, F.sha2(base, 256).alias("base_sha256"), secrets.span_list(F.col("spans")).alias("spans"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and fate of every line of all documents: 2 edits or fewer apart from 16 characters on, 1 from 8 on, equal below."""
    return linededup.line_classes(table(spark, sf_dir, "documents"), edits=2, min_chars=16, short=True, fewer=((8, 1),))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the windows of 50 words that an earlier one has; digest of what is kept."""
    out = substrings.without_repeats(table(spark, sf_dir, "documents"), window=50)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leading 2000 phrases of two and three words of each language, over all documents."""
    return phrases.collocations(table(spark, sf_dir, "documents"), max_words=3, min_count=10, absorb_percent=50, top=2000)


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source of all documents from the others of its language, and its leading terms."""
    return divergence.divergence(table(spark, sf_dir, "documents"), min_docs=10, top=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ann": op1_ann,
    "op2_simhash": op2_simhash,
    "op3_mixing": op3_mixing,
    "op4_language_id": op4_language_id,
    "op5_bpe": op5_bpe,
    "op6_quality": op6_quality,
    "op7_toxicity": op7_toxicity,
    "op8_warc": op8_warc,
    "op9_secrets": op9_secrets,
    "op10_line_dedup": op10_line_dedup,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_collocations": op12_collocations,
    "op13_divergence": op13_divergence,
}

# DuckDB SQL for the queries that SQL can express; the others are tested against brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op8_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS h FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS last FROM d)
SELECT page_id, payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), '') AS payload_digest,
    CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM m
""",
    "op11_substring_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT row, doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS h FROM
    (SELECT row, doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d WHERE len(w) >= 50)),
first AS (SELECT h, min(doc_id) AS low FROM win GROUP BY h),
gone AS (SELECT row, s FROM win JOIN first USING (h) WHERE doc_id > low),
covered AS (SELECT DISTINCT row, unnest(range(s, s + 50)) AS i FROM gone),
removed AS (SELECT row, list(i) AS i FROM covered GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(removed.i), 0)::BIGINT AS n_removed,
    sha256(CASE WHEN removed.i IS NULL THEN array_to_string(w, ' ')
        ELSE array_to_string(list_filter(w, lambda x, n: NOT list_contains(removed.i, n)), ' ') END) AS kept_sha256
FROM d LEFT JOIN removed USING (row)
""",
    "op12_collocations": r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
piece AS (SELECT lang, unnest(regexp_extract_all(text, '[^.,;:!?\x0A-\x0D]+')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
occurrence AS (
    SELECT lang, 1 AS words, unnest(w) AS phrase FROM w
    UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w
    UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w),
f AS (SELECT lang, words, phrase, count(*)::HUGEINT AS n FROM occurrence GROUP BY lang, words, phrase),
n AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, words, phrase, n AS a, string_split(phrase, ' ') AS p FROM f WHERE words > 1 AND n >= 10),
cut AS (
    SELECT lang, phrase, a, 1 AS k, p[1] AS first, array_to_string(p[2:], ' ') AS rest FROM c
    UNION ALL SELECT lang, phrase, a, 2, p[1] || ' ' || p[2], p[3] FROM c WHERE words = 3),
scored AS (SELECT cut.lang, cut.phrase, a, k, l.n AS l, r.n AS r, 1000000 * a * a // (l.n * r.n) AS score
    FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = first JOIN f r ON r.lang = cut.lang AND r.phrase = rest),
least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, p[1] || ' ' || p[2] AS phrase, a AS longer FROM c WHERE words = 3
    UNION ALL SELECT lang, p[2] || ' ' || p[3], a FROM c WHERE words = 3),
absorbed AS (SELECT lang, phrase, max(longer) AS longer FROM inside GROUP BY lang, phrase),
own AS (SELECT least.* FROM least LEFT JOIN absorbed USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM own)
SELECT ranked.lang, rank::INT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n.n, score::BIGINT AS score
FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000
""",
    "op13_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{80}-\x{10FFFF}]+') AS found FROM documents),
t AS (SELECT row, lang, source, translate(unnest(found), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source),
g AS (SELECT DISTINCT lang, source FROM d),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.c, 0) AS c,
        1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 2)) // (coalesce(n.n, 0) + 2 * v.v)::HUGEINT AS p,
        1 + (1000000000::HUGEINT * (kept.total + 2)) // (v.n + 2 * v.v)::HUGEINT AS q
    FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN n USING (lang, source) LEFT JOIN c USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
scored AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0)::BIGINT AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM scored)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
""",
}
