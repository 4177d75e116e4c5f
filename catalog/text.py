"""Queries over documents: features, language, entities, duplicates, checks and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.shared import spread, table
from plumbline.config import DIMENSIONS, TextRules
from plumbline.functions import text as tx
from plumbline.functions.entities import ENTITY_PATTERNS
from plumbline.functions.language import CODES, FUNCTION_WORDS
from plumbline.functions.scoring import weighted_score
from plumbline.config import Weights
from plumbline.operators.documents import text_features, with_likely_duplicates
from plumbline.operators.entities import dictionary_entities, entity_maps
from plumbline.operators.language import PROFILE_SIZE, identify_language, language_profiles
from plumbline.plans.text import score_documents
from plumbline.sources.documents import rows_as_documents

TEXT_AS_OF = "2024-02-15"

# Word-poor, upper-case, symbol-heavy and broken documents, derived from the
# texts themselves. Valid in Spark and in DuckDB alike.
DIRTY_DOCUMENTS_SQL = """
SELECT doc_id, lang,
  CASE WHEN source = 'src1'
         THEN translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')
       WHEN source = 'src2' THEN replace(text, ' ', '    ')
       WHEN source = 'src3' THEN replace(text, 'e', '#%&')
       WHEN source = 'src4' THEN replace(text, 'a', chr(65533))
       WHEN source = 'src5' THEN replace(replace(replace(text, 'e', ''), ' ', ''), '.', '')
       WHEN source = 'src6' THEN ''
       ELSE text END AS text,
  CASE WHEN source = 'src7' THEN TIMESTAMP '2023-11-01 00:00:00'
       WHEN source = 'src8' THEN TIMESTAMP '2024-01-01 00:00:00'
       WHEN source = 'src9' THEN TIMESTAMP '2023-12-20 06:00:00'
       ELSE TIMESTAMP '2024-02-10 00:00:00' END AS modified_at
FROM {documents}
"""


def dirty_documents(spark, sf_dir):
    select = DIRTY_DOCUMENTS_SQL.replace("chr(65533)", "'" + tx.REPLACEMENT + "'")
    columns = ("doc_id", "lang", "text", "source")
    return spark.sql(select, documents=spread(table(spark, sf_dir, "documents").select(*columns)))


def _documents(spark, sf_dir, *columns):
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", *columns))


NUMBERS = (
    "char_count", "word_count", "sentence_count", "avg_word_length",
    "special_char_ratio", "whitespace_ratio", "uppercase_ratio", "is_empty", "encoding_errors",
)


def features_documents(spark, sf_dir):
    features = text_features(dirty_documents(spark, sf_dir).select("doc_id", "text"))
    return features.select("doc_id", *NUMBERS)


def language_documents(spark, sf_dir):
    features = text_features(_documents(spark, sf_dir))
    return features.select("doc_id", "language", "language_confidence")


def entities_documents(spark, sf_dir):
    features = text_features(_documents(spark, sf_dir))
    return features.select("doc_id", F.explode("entities").alias("label", "n")).withColumn("n", F.col("n").cast("bigint"))


def entities_pages(spark, sf_dir):
    features = text_features(table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text")))
    return features.select("page_id", F.explode("entities").alias("label", "n")).withColumn("n", F.col("n").cast("bigint"))


def trained_profiles(spark, sf_dir):
    return language_profiles(_documents(spark, sf_dir, "lang"))


def trained_language(spark, sf_dir):
    docs = _documents(spark, sf_dir, "lang")
    return identify_language(docs, language_profiles(docs)).select("doc_id", "language", "confidence", "score")


def _vocabulary(spark, sf_dir):
    """The benchmark's words as a dictionary, labelled by length."""
    items = table(spark, sf_dir, "benchmark")
    words = items.select(F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}]+")).alias("phrase")).where("phrase <> ''")
    label = F.when(F.length("phrase") >= 7, "LONG").otherwise("SHORT")
    return words.distinct().withColumn("label", label)


def dictionary_documents(spark, sf_dir):
    return dictionary_entities(_documents(spark, sf_dir), _vocabulary(spark, sf_dir))


def dictionary_maps(spark, sf_dir):
    maps = entity_maps(dictionary_entities(_documents(spark, sf_dir), _vocabulary(spark, sf_dir)))
    return maps.select("doc_id", F.to_json("entities").alias("entities"))


def likely_duplicates(spark, sf_dir):
    features = text_features(_documents(spark, sf_dir))
    return with_likely_duplicates(features, "doc_id").select("doc_id", "char_count", "word_count", "duplicate_count")


def likely_duplicate_turns(spark, sf_dir):
    """Conversations hold many documents each; only those of other conversations count."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    features = text_features(turns)
    return with_likely_duplicates(features, "conv_id", unique_names=False).select(
        "conv_id", "turn", "duplicate_count"
    )


def rows_as_text(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumn(
        "id", F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    )
    docs = rows_as_documents(rows, "id")
    return docs.select("doc_id", F.length("text").cast("bigint").alias("chars"))


def _scored(spark, sf_dir):
    features = text_features(dirty_documents(spark, sf_dir).select("doc_id", "text", "modified_at"))
    return score_documents(features, "doc_id", TEXT_AS_OF, "modified_at")


def document_scores(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    dims = scored.withColumn("dimensions", F.struct(*DIMENSIONS))
    return dims.select("doc_id", *DIMENSIONS, weighted_score(Weights()).alias("overall_score"))


def document_checks(spark, sf_dir):
    return _scored(spark, sf_dir).select("doc_id", F.inline("failed_checks")).select(
        "doc_id", "check", "column", "expected", "actual", "severity"
    )


# -- SQL ----------------------------------------------------------------------

WS = tx.WHITESPACE


def features_cte(source: str, key: str = "doc_id") -> str:
    """CTE ``f``: the numeric features of each text."""
    return f"""WITH src AS ({source}),
counted AS (
  SELECT *, length(text) AS char_count,
    len(regexp_extract_all(text, '[^{WS}]+')) AS word_count,
    len(regexp_extract_all(text, '[^{WS}.][^.\\n]*')) AS sentence_count,
    length(regexp_replace(text, '[^{WS}]+', '', 'g')) AS ws,
    length(regexp_replace(text, '[\\p{{L}}\\p{{N}}{WS}]+', '', 'g')) AS special,
    length(regexp_replace(text, '[^\\p{{L}}]+', '', 'g')) AS letters,
    length(regexp_replace(text, '[^\\p{{Lu}}]+', '', 'g')) AS upper_letters
  FROM src),
f AS (
  SELECT *,
    coalesce(round((char_count - ws) / nullif(word_count, 0), 4), 0.0) AS avg_word_length,
    coalesce(round(special / nullif(char_count, 0), 6), 0.0) AS special_char_ratio,
    coalesce(round(ws / nullif(char_count, 0), 6), 0.0) AS whitespace_ratio,
    coalesce(round(upper_letters / nullif(letters, 0), 6), 0.0) AS uppercase_ratio,
    word_count < 5 AS is_empty,
    contains(text, chr(65533)) AS encoding_errors
  FROM counted)"""


DIRTY_SQL = DIRTY_DOCUMENTS_SQL.replace("{documents}", "documents")


def language_cte(source: str = "f") -> str:
    """CTEs ``hits`` and ``spoken``: function-word hits of each text of ``source``."""
    lists = {c: ", ".join(f"'{w}'" for w in FUNCTION_WORDS[c].split()) for c in CODES}
    hits = ", ".join(f"len(list_filter(words, lambda w: w IN ({lists[c]}))) AS h_{c}" for c in CODES)
    most = "greatest(" + ", ".join(f"h_{c}" for c in CODES) + ")"
    choice = " ".join(f"WHEN h_{c} = {most} THEN '{c}'" for c in CODES)
    total = " + ".join(f"h_{c}" for c in CODES)
    return f"""hits AS (
  SELECT *, {hits} FROM (SELECT *, regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{M}}]+') AS words FROM {source})),
spoken AS (
  SELECT *, CASE WHEN {most} = 0 THEN 'unknown' {choice} END AS language,
    round({most} / nullif({total}, 0), 4) AS language_confidence FROM hits)"""


def _entities_sql(source: str, key: str, text: str) -> str:
    plain = {
        "DATE": r"(^|[^0-9])[0-9]{4}-[0-9]{2}-[0-9]{2}([^0-9]|$)",
        **{label: pattern for label, (_, pattern) in ENTITY_PATTERNS.items() if label != "DATE"},
    }
    parts = [
        f"SELECT {key}, '{label}' AS label, len(regexp_extract_all({text}, '{pattern}')) AS n FROM {source}"
        for label, pattern in plain.items()
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE n > 0"


_GRAMS = """letters AS (SELECT *, regexp_replace(lower(text), '[^\\p{L}]+', '_', 'g') AS s FROM documents),
grams AS (
  SELECT doc_id, lang, unnest(list_concat(list_concat(regexp_extract_all(s, '...'), regexp_extract_all(s[2:], '...')),
    regexp_extract_all(s[3:], '...'))) AS gram FROM letters)"""
_PROFILES = f"""WITH {_GRAMS},
ranked AS (
  SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS rank
  FROM (SELECT lang, gram, count(*) AS n FROM grams GROUP BY lang, gram)),
profiles AS (SELECT lang, gram, {PROFILE_SIZE + 1} - rank AS weight FROM ranked WHERE rank <= {PROFILE_SIZE})"""

_DICTIONARY = """WITH vocabulary AS (
  SELECT DISTINCT phrase, CASE WHEN length(phrase) >= 7 THEN 'LONG' ELSE 'SHORT' END AS label
  FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS phrase FROM benchmark)
  WHERE phrase <> ''),
words AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS phrase FROM documents),
tagged AS (SELECT doc_id, label, count(*) AS n FROM words JOIN vocabulary USING (phrase) GROUP BY doc_id, label)"""

_rules = TextRules()
_LANGUAGE_LIST = ", ".join(f"'{c}'" for c in _rules.languages)
_LANGUAGES_SHOWN = ", ".join(f"''{c}''" for c in sorted(_rules.languages))


def scored_cte() -> str:
    """CTE ``scored``: six scores, overall score and the inputs of the checks of each dirty document."""
    age = f"(epoch(TIMESTAMP '{TEXT_AS_OF}') - epoch(modified_at)) / 86400.0"
    return (
        features_cte(DIRTY_SQL)
        + ", "
        + language_cte("f")
        + f""",
aged AS (
  SELECT *, {age} AS age_days,
    count(*) OVER (PARTITION BY char_count, word_count) - 1 AS duplicate_count FROM spoken),
scored AS (
  SELECT *,
    round(CASE WHEN is_empty THEN 0.0 WHEN word_count >= 50 THEN 100.0 ELSE word_count / 50 * 100 END, 2) AS completeness,
    100.0 - CASE WHEN encoding_errors THEN 30.0 ELSE 0.0 END - CASE WHEN uppercase_ratio > 0.5 THEN 20.0 ELSE 0.0 END
      - CASE WHEN special_char_ratio > 0.3 THEN 20.0 ELSE 0.0 END AS accuracy,
    CASE WHEN language = 'unknown' THEN 50.0 ELSE 100.0 END - CASE WHEN whitespace_ratio > 0.4 THEN 20.0 ELSE 0.0 END AS consistency,
    round(CASE WHEN age_days <= 30 THEN 100.0 WHEN age_days >= 90 THEN 0.0 ELSE 100 - (age_days - 30) / 60 * 100 END, 2) AS freshness,
    CASE WHEN duplicate_count > 0 THEN 0.0 ELSE 100.0 END AS uniqueness,
    100.0 - CASE WHEN language NOT IN ({_LANGUAGE_LIST}) THEN 50.0 ELSE 0.0 END
      - CASE WHEN sentence_count < 1 THEN 50.0 ELSE 0.0 END AS validity
  FROM aged),
totals AS (
  SELECT *, round(completeness * 0.25 + accuracy * 0.25 + consistency * 0.15 + freshness * 0.15
    + uniqueness * 0.1 + validity * 0.1, 2) AS overall_score FROM scored)"""
    )


# (check, severity, condition, expected, actual) in report order.
_CHECKS = [
    ("is_empty", "error", "is_empty", "'word_count >= 5'", "'word_count = ' || word_count"),
    ("low_word_count", "warning", "NOT is_empty AND word_count < 20", "'word_count >= 20'", "'word_count = ' || word_count"),
    ("encoding_errors", "error", "encoding_errors", "'no Unicode replacement characters (\\ufffd)'",
     "'replacement character \\ufffd detected'"),
    ("excessive_uppercase", "warning", "uppercase_ratio > 0.5", "'uppercase_ratio <= 0.5'",
     "printf('uppercase_ratio = %.4f', uppercase_ratio) || ' — possible OCR or formatting issue'"),
    ("excessive_special_chars", "warning", "special_char_ratio > 0.3", "'special_char_ratio <= 0.3'",
     "printf('special_char_ratio = %.4f', special_char_ratio)"),
    ("language_undetected", "warning", "language = 'unknown'", "'detectable language'", "'Language could not be detected'"),
    ("excessive_whitespace", "warning", "whitespace_ratio > 0.4", "'whitespace_ratio <= 0.4'",
     "printf('whitespace_ratio = %.4f', whitespace_ratio) || ' — Excessive whitespace detected'"),
    ("stale_file", "error", "age_days >= 90", "'file modified within 90 days'",
     "printf('file last modified %.0f days ago', age_days)"),
    ("aging_file", "warning", "age_days > 30 AND age_days < 90", "'file modified within 30 days'",
     "printf('file last modified %.0f days ago', age_days)"),
    ("likely_duplicate", "warning", "duplicate_count > 0", "'unique char_count and word_count combination'",
     "'char_count=' || char_count || ' and word_count=' || word_count || ' matches ' || duplicate_count || ' other document(s)'"),
    ("unexpected_language", "error", f"language NOT IN ({_LANGUAGE_LIST})", f"'language in [{_LANGUAGES_SHOWN}]'",
     "'detected language = ''' || language || ''''"),
    ("no_sentences", "warning", "sentence_count < 1", "'sentence_count >= 1'", "'sentence_count = ' || sentence_count"),
]


def checks_union(source: str = "totals") -> str:
    """Rows ``doc_id, ord, check, column, expected, actual, severity`` from ``source``."""
    return " UNION ALL ".join(
        f"SELECT doc_id, {i} AS ord, '{check}' AS \"check\", 'document' AS \"column\", {expected} AS expected, "
        f"{actual} AS actual, '{severity}' AS severity FROM {source} WHERE {condition}"
        for i, (check, severity, condition, expected, actual) in enumerate(_CHECKS)
    )


QUERIES = {
    "features_documents": features_documents,
    "language_documents": language_documents,
    "entities_documents": entities_documents,
    "entities_pages": entities_pages,
    "trained_profiles": trained_profiles,
    "trained_language": trained_language,
    "dictionary_documents": dictionary_documents,
    "dictionary_maps": dictionary_maps,
    "likely_duplicates": likely_duplicates,
    "likely_duplicate_turns": likely_duplicate_turns,
    "rows_as_text": rows_as_text,
    "document_scores": document_scores,
    "document_checks": document_checks,
}

SQL = {
    "features_documents": features_cte(DIRTY_SQL) + f" SELECT doc_id, {', '.join(NUMBERS)} FROM f",
    "language_documents": "WITH " + language_cte("documents") + " SELECT doc_id, language, language_confidence FROM spoken",
    "entities_documents": _entities_sql("documents", "doc_id", "text"),
    "entities_pages": _entities_sql("pages", "page_id", "html"),
    "trained_profiles": _PROFILES + " SELECT lang, gram, weight FROM profiles",
    "trained_language": _PROFILES
    + """,
scores AS (
  SELECT doc_id, p.lang, CAST(sum(weight) AS BIGINT) AS score FROM grams g JOIN profiles p USING (gram) GROUP BY doc_id, p.lang),
best AS (
  SELECT doc_id, lang, score, round(score / sum(score) OVER (PARTITION BY doc_id), 4) AS confidence,
    row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang DESC) AS r FROM scores)
SELECT d.doc_id, coalesce(b.lang, 'unknown') AS language, b.confidence, b.score
FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id AND b.r = 1""",
    "dictionary_documents": _DICTIONARY + " SELECT doc_id, label, n FROM tagged",
    "dictionary_maps": _DICTIONARY
    + """ SELECT doc_id, '{' || string_agg('"' || label || '":' || n, ',' ORDER BY label) || '}' AS entities
FROM tagged GROUP BY doc_id""",
    "likely_duplicates": features_cte("SELECT doc_id, text FROM documents")
    + """ SELECT doc_id, char_count, word_count,
  count(*) OVER (PARTITION BY char_count, word_count) - 1 AS duplicate_count FROM f""",
    "likely_duplicate_turns": features_cte("SELECT conv_id, turn, text FROM conversations")
    + """ SELECT conv_id, turn, count(*) OVER (PARTITION BY char_count, word_count)
  - count(*) OVER (PARTITION BY char_count, word_count, conv_id) AS duplicate_count FROM f""",
    "rows_as_text": """
SELECT conv_id || '/' || turn AS doc_id, length(role || ' ' || text) AS chars FROM conversations""",
    "document_scores": scored_cte()
    + f" SELECT doc_id, {', '.join(DIMENSIONS)}, overall_score FROM totals",
    "document_checks": scored_cte()
    + f' SELECT doc_id, "check", "column", expected, actual, severity FROM ({checks_union()})',
}
