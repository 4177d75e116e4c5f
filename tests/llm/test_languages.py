import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import languages
from plumbline.llm.shared import crc_mod, table

ENGLISH = "the weather was fine and they walked along the river to the old mill where the children were playing with water"
GERMAN = "das wetter war schön und sie gingen am fluss entlang zur alten mühle wo die kinder mit dem wasser spielten"
FRENCH = "le temps était beau et ils marchaient le long de la rivière vers le vieux moulin où les enfants jouaient avec l'eau"


@pytest.fixture(scope="module")
def learned(spark):
    rows = [(k, text, lang) for k, (text, lang) in enumerate([(ENGLISH, "en"), (GERMAN, "de"), (FRENCH, "fr")])]
    rows += [(9, None, "en"), (10, "", "xx"), (11, "words without a label", None), (12, "12 34", "yy")]
    return languages.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_labels_without_letters_teach_nothing(learned):
    assert learned.names == ("de", "en", "fr")
    assert np.allclose(learned.probability.sum(axis=0), 1)


def test_mixtures_are_recognised_with_their_shares(learned, make_docs):
    rows = [(1, ENGLISH), (2, f"{ENGLISH} {GERMAN}"), (3, f"{FRENCH}. {GERMAN} {ENGLISH}"), (4, f"{FRENCH} {FRENCH} {FRENCH} {GERMAN}")]
    got = {r.doc_id: {p.lang: p.share for p in r.languages} for r in languages.identify(make_docs(rows), learned).collect()}
    assert got[1] == {"en": 1.0}
    assert set(got[2]) == {"en", "de"} and abs(got[2]["en"] - 0.5) < 0.1
    assert set(got[3]) == {"en", "de", "fr"}
    assert set(got[4]) == {"de", "fr"} and abs(got[4]["fr"] - 0.75) < 0.1


def test_shares_maximise_the_likelihood(learned):
    """Two languages: the share found by expectation-maximisation is the best of a fine grid."""
    at, n = languages.gram_counts(f"{ENGLISH} {ENGLISH} {GERMAN}", learned.slots)
    shares = languages.mixtures(learned, [(at, n)])[0]
    p = learned.probability[at]
    grid = np.linspace(0, 1, 1001)
    likely = [(n * np.log(g * p[:, 0] + (1 - g) * p[:, 1])).sum() for g in grid]
    assert shares[2] == 0 and abs(shares[0] - grid[int(np.argmax(likely))]) < 0.01


def test_texts_without_letters_repeated_rows_and_empty_tables(learned, make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "12 - 34 !"), (None, GERMAN), (5, GERMAN), (5, GERMAN), (6, "x")])
    got = sorted(((r.doc_id or 0), r.lang, r.score) for r in languages.identify(docs, learned).collect())
    assert [g for g in got if g[0] in (1, 2, 3)] == [(k, "und", 0.0) for k in (1, 2, 3)]
    assert [g[:2] for g in got if g[0] in (0, 5)] == [(0, "de"), (5, "de"), (5, "de")]
    assert all(0 < g[2] <= 1 for g in got if g[1] != "und") and len(got) == 7
    assert languages.identify(make_docs([]), learned).count() == 0
    nothing = languages.train(make_docs([]).selectExpr("doc_id", "text", "'en' AS lang"))
    assert nothing.names == ()
    assert {r.lang for r in languages.identify(docs, nothing).collect()} == {"und"}


def test_long_texts_are_counted_whole_in_pieces(monkeypatch):
    text = f"{ENGLISH} {GERMAN} " * 40
    whole = languages.gram_counts(text, 1 << 12)
    monkeypatch.setattr(languages, "CELLS_AT_ONCE", 101)
    pieces = languages.gram_counts(text, 1 << 12)
    # Pieces add nothing but the gap that stands before and after each of them.
    assert abs(pieces[1].sum() - whole[1].sum()) <= 4 * (len(text) // 101 + 1)
    assert set(whole[0].tolist()) <= set(pieces[0].tolist())


def test_too_many_labels_are_refused(spark):
    with pytest.raises(ValueError, match="values"):
        languages.train(spark.range(languages.MOST_LANGUAGES + 1).selectExpr("id AS doc_id", "'a b' AS text", "string(id) AS lang"))


def test_held_out_accuracy(spark):
    from plumbline.llm import queries

    sf = "/root/testdata/sf0.01"
    documents = table(spark, sf, "documents")
    got = queries.op11_language_mixture(spark, sf)
    truth = documents.select("doc_id", "lang", (crc_mod(F.col("doc_id"), 4) == 2).alias("held"))
    assert got.count() == documents.count()
    rows = got.join(truth, "doc_id").where("lang IS NOT NULL AND lang_pred <> 'und'").collect()
    assert all(r.held_out == r.held for r in rows)
    rows = [r for r in rows if r.held]
    assert len(rows) > 50 and sum(r.lang_pred == r.lang for r in rows) >= 0.95 * len(rows)
