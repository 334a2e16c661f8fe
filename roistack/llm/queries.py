"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe
from .ann_search import nearest
from .common import read_table
from .decontaminate import find_leaks
from .jaccard_join import jaccard_components
from .lexical_search import rank_documents
from .license_scan import scan_licenses
from .line_dedup import dedup_lines
from .lm_score import score_documents
from .quality import fit_quality, score_quality
from .secret_scan import scan_secrets
from .simhash_dedup import simhash_components
from .spelling_variants import spelling_forms
from .token_output import round_trip


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read_table(spark, sf_dir, "documents"), edits=True).select("doc_id", "text", "n_lines_dropped")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return score_documents(read_table(spark, sf_dir, "documents"), held_out)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return score_quality(documents, fit_quality(documents, read_table(spark, sf_dir, "labels")))


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return files.select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return byte_bpe.digests(byte_bpe.round_trip(read_table(spark, sf_dir, "documents"), ranks, pattern))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"), n=3, num=90, den=100)


def op10_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read_table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(read_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_line_dedup, op3_lm_score, op4_license_scan, op5_quality, op6_token_output, op7_secret_scan, op8_byte_bpe, op9_jaccard_join, op10_ann_search,
        op11_simhash_dedup, op12_lexical_search, op13_spelling_variants,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op9_jaccard_join": r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
),
elements AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS e
    FROM texts
),
sizes AS (SELECT doc_id, count(*) AS n FROM elements GROUP BY doc_id),
pairs AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM elements x JOIN elements y ON x.e = y.e AND x.doc_id <> y.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM pairs JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
    WHERE 100 * shared >= 90 * (s.n + t.n - shared)
),
reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
),
named AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, m.component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN named m ON m.a = d.doc_id
""",
    "op12_lexical_search": r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
),
asked AS (
    SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark
    ) GROUP BY ALL
),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
postings AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals),
scores AS (
    SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN sizes USING (doc_id), totals GROUP BY ALL
)
SELECT item_id, rank, doc_id, score FROM (
    SELECT *, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank FROM scores WHERE score > 0
) WHERE rank <= 10
""",
    "op13_spelling_variants": r"""
WITH RECURSIVE bits AS (
    SELECT i, 0 AS k, i::BIGINT AS c FROM range(256) r(i)
    UNION ALL
    SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents) WHERE length(run) >= 7 GROUP BY ALL
),
hashed AS (
    SELECT run, n, xor(list_reduce(
        list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(concat(doc_id, ':', run), ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195::BIGINT, ord(c)::BIGINT - 64] END))),
        lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1])), 4294967295) AS h
    FROM runs, crc
),
words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT CASE WHEN h % 31 = 0 THEN concat(left(run, (h % length(run))::INT), substr(run, (h % length(run))::INT + 2)) ELSE run END AS word, n FROM hashed
    ) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
),
cut AS (SELECT word, n, i, concat(left(word, i), substr(word, i + 2)) AS rest FROM (SELECT word, n, unnest(range(0, length(word)))::INT AS i FROM words)),
near AS (
    SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION
    SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.rest
    UNION
    SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.rest
),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS most FROM near GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * w.n THEN other END AS form, CASE WHEN most >= 10 * w.n THEN most END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word),
paths AS (
    SELECT word, word AS root, 0 AS step FROM forms
    UNION ALL
    SELECT p.word, f.form, step + 1 FROM paths p JOIN forms f ON f.word = p.root WHERE f.form IS NOT NULL
),
roots AS (SELECT word, arg_max(root, step) AS root FROM paths GROUP BY word)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN roots r ON r.word = f.word
""",
}
