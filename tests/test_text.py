"""Text documents."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plumbline.operators import entities as E
from plumbline.operators.documents import text_features, with_likely_duplicates
from plumbline.operators import language
from plumbline.operators.language import identify_language, language_profiles, trigrams
from plumbline.plans.text import score_documents, validate_documents

ENGLISH = "The quick brown fox jumps over the lazy dog and it was for this that they are here. "


def features(spark, *texts):
    rows = [(f"d{i}", t) for i, t in enumerate(texts)]
    return text_features(spark.createDataFrame(rows, "doc_id string, text string")).orderBy("doc_id").collect()


def base(**changes):
    row = {
        "doc_id": "a", "char_count": 600, "word_count": 100, "sentence_count": 5, "avg_word_length": 5.0,
        "language": "en", "language_confidence": 1.0, "special_char_ratio": 0.02, "whitespace_ratio": 0.16,
        "uppercase_ratio": 0.05, "is_empty": False, "encoding_errors": False,
        "modified_at": dt.datetime(2024, 5, 30),
    }
    return {**row, **changes}


SCHEMA = (
    "doc_id string, char_count bigint, word_count bigint, sentence_count bigint, avg_word_length double, "
    "language string, language_confidence double, special_char_ratio double, whitespace_ratio double, "
    "uppercase_ratio double, is_empty boolean, encoding_errors boolean, modified_at timestamp"
)


def scored(spark, *rows):
    df = spark.createDataFrame(list(rows), SCHEMA)
    return score_documents(df, "doc_id", "2024-06-01", "modified_at").orderBy("doc_id").collect()


def python_features(text):
    words = text.split()
    letters = [c for c in text if c.isalpha()]
    n = len(text)
    import re

    return {
        "char_count": n,
        "word_count": len(words),
        "sentence_count": sum(1 for s in re.split(r"[.\n]", text) if s.strip()),
        "avg_word_length": round(sum(map(len, words)) / len(words), 4) if words else 0.0,
        "special_char_ratio": round(sum(not c.isalnum() and not c.isspace() for c in text) / n, 6) if n else 0.0,
        "whitespace_ratio": round(sum(c.isspace() for c in text) / n, 6) if n else 0.0,
        "uppercase_ratio": round(sum(c.isupper() for c in letters) / len(letters), 6) if letters else 0.0,
    }


@pytest.mark.parametrize(
    "text",
    [
        "", "   ", ENGLISH * 4, "One. Two.. Three\n\n . \nFour", "no break space\x1cgroup\x85next",
        "ÀÉÎ straße naïve Ωmega", "𝒜𝓑 emoji 😀 x", "###!!! $%&", "1,234.5 ½ ²", "\t.\n.\t", "ǅ title case",
    ],
)
def test_features_agree_with_plain_python(spark, text):
    row = features(spark, text)[0].asDict()
    for name, value in python_features(text).items():
        assert row[name] == pytest.approx(value), name


def test_null_text_is_empty(spark):
    row = features(spark, None)[0]
    assert row.is_empty and row.char_count == 0 and row.language == "unknown" and row.language_confidence is None


def test_fifty_words(spark):
    row = features(spark, "word " * 50)[0]
    assert row.word_count == 50 and not row.is_empty


def test_replacement_character(spark):
    assert features(spark, "bad � byte")[0].encoding_errors


def test_language_by_function_words(spark):
    got = features(spark, ENGLISH * 3, "Le chat est dans la maison et il ne sort pas avec le chien.", "xyzzy plugh")
    assert [r.language for r in got] == ["en", "fr", "unknown"]


def test_rule_entities(spark):
    row = features(spark, "Mail a.b@c.org or x@y.z on 2024-01-02, pay $3.50 or 5%, see https://e.org/x?y=1 now")[0]
    assert row.entities == {"EMAIL": 2, "DATE": 1, "MONEY": 1, "PERCENT": 1, "URL": 1}


def test_trigrams_overlap(spark):
    got = spark.sql("SELECT 'Ab-cDe' AS t").select(trigrams(F.col("t"))).first()[0]
    assert sorted(got) == sorted(["ab_", "b_c", "_cd", "cde"])


def test_trained_language(spark):
    docs = spark.createDataFrame(
        [(1, "en", "the weather there and then"), (2, "de", "der schnee schmilzt schnell"), (3, "en", "that father gathers")],
        "doc_id int, lang string, text string",
    )
    profiles = language_profiles(docs, size=50)
    unseen = spark.createDataFrame([(7, "then the"), (8, "schnee"), (9, "??")], "doc_id int, text string")
    got = {r.doc_id: (r.language, r.confidence) for r in identify_language(unseen, profiles).collect()}
    assert got[7][0] == "en" and got[8] == ("de", 1.0) and got[9] == ("unknown", None)


def test_trigrams_are_counted_before_they_leave_the_scan(spark, monkeypatch):
    """In pieces of any size as brute force over single trigrams has them; null labels, repeated keys, letters of two units."""
    monkeypatch.setattr(language, "PIECE", 7)
    rows = [
        (1, "en", "the weather there and then, the end"), (1, "en", "Then AGAIN"), (2, "de", "der Schnee schmilzt"), (3, None, "the null label"),
        (None, "de", "ohne Schlüssel"), (4, "en", None), (5, "de", "ab"), (6, "en", "1 2 3"), (7, "fr", "\U0001d49c\U0001d4d1\U0001d49c x\0y"), (8, "de", "zz " * 40),
    ]
    docs = spark.createDataFrame(rows, "doc_id int, lang string, text string")
    single = docs.select("doc_id", "lang", F.explode_outer(trigrams(F.col("text"))).alias("gram"))
    want = single.where("gram is not null").groupBy("lang", "gram").count().collect()
    made = language_profiles(docs, size=1000)
    profile = {(r.lang, r.gram): r.weight for r in made.collect()}
    for lang in {r.lang for r in want}:
        ranked = sorted((-r["count"], r.gram) for r in want if r.lang == lang)
        assert [profile[lang, gram] for _, gram in ranked] == [1000 - k for k in range(len(ranked))]
    assert len(profile) == len(want)
    scores, keys = {}, set()
    for row in single.collect():
        keys.add(row.doc_id)
        for (lang, gram), weight in profile.items():
            if gram == row.gram:
                scores.setdefault(row.doc_id, {}).setdefault(lang, []).append(weight)
    got = {r.doc_id: (r.language, r.score, r.confidence) for r in identify_language(docs, made).collect()}
    assert got.keys() == keys
    for key in keys:
        sums = {lang: sum(w) for lang, w in scores.get(key, {}).items()}
        best = max(((s, lang) for lang, s in sums.items() if lang is not None), default=(None, "unknown"))
        assert got[key][:2] == (best[1], best[0])
        assert got[key][2] == (None if best[0] is None else pytest.approx(best[0] / sum(sums.values()), abs=5e-5))


def test_phrases_are_counted_without_a_table_of_a_partition(spark, capsys):
    rows = [(1, "a b a c"), (1, "a d"), (None, "b b"), (3, None), (4, ""), (5, "e f")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    tags = spark.createDataFrame([("a", "X"), ("a", "Y"), ("b", "X"), ("e", "X")], "phrase string, label string")
    made = E.dictionary_entities(docs, tags)
    assert sorted((r.doc_id or 0, r.label, r.n) for r in made.collect()) == [(0, "X", 2), (1, "X", 4), (1, "Y", 3), (5, "X", 1)]
    assert dict(made.dtypes) == {"doc_id": "int", "label": "string", "n": "bigint"}
    capsys.readouterr()
    made.explain()
    grouped = [line for line in capsys.readouterr().out.splitlines() if "Aggregate(" in line]
    assert grouped and not any("phrase" in line.split("functions")[0] for line in grouped)
    assert E.dictionary_entities(docs.limit(0), tags).count() == 0


def test_dictionary_entities(spark):
    docs = spark.createDataFrame([(1, "New York, new york and Lagos."), (2, "nothing")], "doc_id int, text string")
    places = spark.createDataFrame([("new york", "CITY"), ("lagos", "CITY"), ("york", "NAME")], "phrase string, label string")
    got = {(r.doc_id, r.label): r.n for r in E.dictionary_entities(docs, places, longest=2).collect()}
    assert got == {(1, "CITY"): 3, (1, "NAME"): 2}
    maps = E.entity_maps(E.dictionary_entities(docs, places, longest=2)).collect()
    assert maps[0].entities == {"CITY": 3, "NAME": 2}


def test_model_hook(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, " ")], "doc_id int, text string")

    def load():
        return lambda text: {"WORD": len(text.split())}

    def absent():
        raise ImportError

    assert {r.doc_id: r.entities for r in E.model_entities(docs, load).collect()} == {1: {"WORD": 2}, 2: {}}
    assert {r.doc_id: r.entities for r in E.model_entities(docs, absent).collect()} == {1: {}, 2: {}}


def test_likely_duplicates_skip_the_own_name(spark):
    rows = [("a", 10, 2), ("a", 10, 2), ("b", 10, 2), ("c", 11, 2)]
    df = spark.createDataFrame(rows, "name string, char_count bigint, word_count bigint")
    got = with_likely_duplicates(df, "name", unique_names=False).collect()
    assert sorted((r.name, r.duplicate_count) for r in got) == [("a", 1), ("a", 1), ("b", 2), ("c", 0)]


@pytest.mark.parametrize("words, score, checks", [(4, 0.0, ["is_empty"]), (10, 20.0, ["low_word_count"]), (25, 50.0, []), (50, 100.0, [])])
def test_completeness(spark, words, score, checks):
    row = scored(spark, base(word_count=words, is_empty=words < 5))[0]
    assert row.completeness == score and [c.check for c in row.failed_checks] == checks


def test_accuracy(spark):
    row = scored(spark, base(encoding_errors=True, uppercase_ratio=0.6))[0]
    assert row.accuracy == 50.0 and [c.check for c in row.failed_checks] == ["encoding_errors", "excessive_uppercase"]
    assert scored(spark, base(uppercase_ratio=0.8))[0].accuracy == 80.0


def test_consistency(spark):
    row = scored(spark, base(language="unknown", whitespace_ratio=0.45))[0]
    assert row.consistency == 30.0
    assert [c.check for c in row.failed_checks] == ["language_undetected", "excessive_whitespace"]


@pytest.mark.parametrize("days, score, check", [(30, 100.0, None), (45, 75.0, "aging_file"), (90, 0.0, "stale_file")])
def test_freshness(spark, days, score, check):
    row = scored(spark, base(modified_at=dt.datetime(2024, 6, 1) - dt.timedelta(days=days)))[0]
    assert row.freshness == score and [c.check for c in row.failed_checks] == ([check] if check else [])


def test_unknown_file_time_scores_zero(spark):
    row = scored(spark, base(modified_at=None))[0]
    assert row.freshness == 0.0 and row.failed_checks[0].check == "freshness"


def test_uniqueness(spark):
    first, second, third = scored(spark, base(), base(doc_id="b"), base(doc_id="c", char_count=7))
    assert (first.uniqueness, second.uniqueness, third.uniqueness) == (0.0, 0.0, 100.0)
    assert first.failed_checks[0].actual == "char_count=600 and word_count=100 matches 1 other document(s)"


def test_validity(spark):
    assert scored(spark, base(language="zh"))[0].validity == 50.0
    assert scored(spark, base(language="zh", sentence_count=0))[0].validity == 0.0


def test_end_to_end(spark):
    docs = spark.createDataFrame([("x", ENGLISH * 12, dt.datetime(2024, 5, 31))], "doc_id string, text string, modified_at timestamp")
    row = validate_documents(docs, as_of="2024-06-01", modified_at="modified_at").first()
    assert row.passed and row.overall_score == 100.0 and row.metadata["language"] == "en" and row.failed_checks == []
