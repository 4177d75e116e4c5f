"""The registered queries of this package and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import contamination, embeddings, languages, lines, mixing, negatives, planes, quality, simhash, tokens, toxicity, urls, variants
from plumbline.llm.shared import checkpoint_dir, crc_mod, table

BYTE_BPE = "byte_bpe_50k.json"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mix(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), vocabulary(BYTE_BPE))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.train(documents, table(spark, sf_dir, "labels")))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_repeated(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.score(documents, quality.train(documents, table(spark, sf_dir, "labels")))


URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
# What no rule decides: hosts that name themselves as spam.
URL_GLOBS = [("*spam*/**", "block"), ("*cheap-pills*/**", "block"), ("*casino*/**", "block")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES, URL_GLOBS)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.found_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_dir(spark)}/plumbline-ids-{uuid.uuid4().hex}"
    planes.write_ids(table(spark, sf_dir, "documents"), folder, vocabulary(BYTE_BPE))
    return planes.read_documents(spark, folder, with_ids=False)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"))


def op11_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    found = languages.identify(documents, languages.train(documents, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), F.col("lang").alias("lang_pred"), "score", "languages")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = variants.variants(variants.spelled_words(table(spark, sf_dir, "documents")))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, relabelled)
    return found.drop("positive_rank")


QUERIES = {
    "op1_source_mix": op1_source_mix,
    "op2_token_counts": op2_token_counts,
    "op3_toxicity": op3_toxicity,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality": op6_quality,
    "op7_url_filter": op7_url_filter,
    "op8_decontamination": op8_decontamination,
    "op9_token_planes": op9_token_planes,
    "op10_simhash": op10_simhash,
    "op11_language_mixture": op11_language_mixture,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_hard_negatives": op13_hard_negatives,
}

SQL: dict[str, str] = {
    "op5_line_dedup": r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM split
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), firsts AS (
  SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT k.*, f.key IS NOT NULL AND doc_id > first_id AS gone FROM keyed k LEFT JOIN firsts f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
    "op7_url_filter": r"""
WITH rest AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), cut AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), judged AS (
  SELECT *,
    CASE WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM cut
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
       WHEN rule IN ('example.com/de/', 'net/') THEN 'block'
       WHEN starts_with(path, '/') AND (contains(host, 'spam') OR contains(host, 'cheap-pills') OR contains(host, 'casino')) THEN 'block'
       ELSE 'allow' END AS verdict
FROM judged
""",
    "op8_decontamination": r"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, lower(text) AS text FROM documents
  UNION ALL SELECT 'i', item_id, lower(text) FROM benchmark
), words AS (
  SELECT kind, id, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM texts WHERE text IS NOT NULL
), items AS (
  SELECT DISTINCT id AS item_id, least(len(w), 5) AS width,
         unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' '))) AS shingle
  FROM words WHERE kind = 'i' AND len(w) > 0
), sizes AS (
  SELECT item_id, count(*) AS n_shingles FROM items GROUP BY item_id
), held AS (
  SELECT DISTINCT id AS doc_id, k AS width,
         unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS shingle
  FROM words, (SELECT DISTINCT width AS k FROM items) WHERE kind = 'd' AND len(w) >= k
)
SELECT doc_id, item_id, n_shingles, count(*) AS n_found, count(*) / n_shingles AS containment
FROM held JOIN items USING (width, shingle) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING count(*) >= ceil(round(0.8 * n_shingles, 9))
""",
    "op12_spelling_variants": r"""
WITH RECURSIVE bits AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(hex(doc_id || ':' || run)) // 2 + 1),
         lambda i: ('0x' || substr(hex(doc_id || ':' || run), 2 * i - 1, 2))::BIGINT)),
         lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS h
  FROM counted, bits
), spelled AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM spelled WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), holes AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS pos FROM words
), cut AS (
  SELECT word, n, pos, substr(word, 1, pos - 1) AS head, substr(word, pos + 1) AS tail FROM holes
), near AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.pos = b.pos AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT a.word, a.n, w.word, w.n FROM cut a JOIN words w ON a.head || a.tail = w.word
  UNION SELECT w.word, w.n, a.word, a.n FROM cut a JOIN words w ON a.head || a.tail = w.word
), best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS most FROM near GROUP BY word
), forms AS (
  SELECT n.word, min(n.near) AS form, any_value(n.near_n) AS form_n FROM near n JOIN best b ON n.word = b.word AND n.near_n = b.most
  WHERE n.near_n >= 10 * n.n GROUP BY n.word
), chain AS (
  SELECT word, form AS root, 1 AS steps FROM forms
  UNION ALL SELECT c.word, f.form, c.steps + 1 FROM chain c JOIN forms f ON c.root = f.word
), roots AS (
  SELECT word, arg_max(root, steps) AS root FROM chain GROUP BY word
)
SELECT w.word, f.form, coalesce(r.root, w.word) AS root, w.n, coalesce(b.n_near, 0) AS n_near, f.form_n
FROM words w LEFT JOIN best b USING (word) LEFT JOIN forms f USING (word) LEFT JOIN roots r USING (word)
""",
    "op13_hard_negatives": r"""
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM kept a JOIN kept b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
WHERE 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
""",
}
