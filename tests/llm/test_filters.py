import random
import re

import numpy as np
import pytest

from plumbline.llm import contamination, lines, quality, toxicity, urls
from plumbline.llm.queries import URL_RULES
from plumbline.llm.shared import table


def slow_lines(rows, least=10):
    blank = " \t\n\x0b\x0c\r"
    first = {}
    for key, text in rows:
        for line in (text or "").split("\n"):
            k = re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(blank))
            if key is not None and len(k) >= least:
                first.setdefault(k, set()).add(key)
    out = []
    for key, text in rows:
        found = (text or "").split("\n")
        stay = [
            x for x in found
            if key is None
            or len(seen := first.get(re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(blank)), ())) < 2
            or key == min(seen)
        ]
        out.append((key if key is not None else -1, len(found), len(found) - len(stay), "\n".join(stay)))
    return sorted(out)


@pytest.mark.parametrize("bits", [lines.FILTER_BITS, 64])
def test_lines_against_brute_force(spark, sf_small, make_docs, bits):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_small, "documents").collect()]
    rows += [(7_000, None), (7_001, ""), (7_002, "\n\n"), (7_003, " A Repeated LINE\r\nshort\na repeated line"), (7_004, "a repeated line \nshort"), (7_004, "a repeated line \nshort"), (None, "a repeated line"), (None, "only without id"), (None, "only without id"), (7_005, "ÄÖÜäöüßéèê\n" * 5_000), (7_006, "ÄÖÜäöüßéèê")]
    got = lines.drop_repeated(make_docs(rows).repartition(4), filter_bits=bits)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_lines, r.n_dropped, r.kept) for r in got.collect())
    assert got == slow_lines(rows)


def test_no_lines(make_docs):
    assert lines.drop_repeated(make_docs([])).count() == 0
    with pytest.raises(ValueError):
        lines.drop_repeated(make_docs([]), filter_bits=1000)


def glob_pattern(glob):
    return "".join("(?s:.*)" if p == "**" else "[^/]*" if p == "*" else re.escape(p) for p in re.split(r"(\*\*|\*)", glob))


def test_automaton_against_patterns():
    rng = random.Random(2)
    globs = ["".join(rng.choice(["a", "b", "/", "*", "**", "é"]) for _ in range(rng.randint(1, 9))) for _ in range(60)] + ["", "**"]
    globs = [re.sub(r"\*{3,}", "**", g) for g in globs]
    texts = ["".join(rng.choice("ab/é") for _ in range(rng.randint(0, 12))) for _ in range(400)] + [""]
    got = urls.Automaton(globs).accepts([t.encode() for t in texts])
    want = np.array([[re.fullmatch(glob_pattern(g), t) is not None for g in globs] for t in texts])
    assert (got == want).all()


def slow_judge(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    fits = [r for r in URL_RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def test_urls_against_brute_force(spark, sf_small):
    given = [r.url for r in table(spark, sf_small, "pages").select("url").collect()]
    given += [None, "", "no scheme.net/", "http://", "http://NET/", "http://net", "http://xnet/", "a://b.example.net/en/?x#y", "a://example.net/en", "a://ex.com/.net/", "a://Example.COM/de/x", "a://x.org/fr/", "a://x.org/FR/", "a://h?q://net/", "a://h.net/" + "x" * 50_000, "x://é.net/ü"]
    df = spark.createDataFrame([(k, u, "h", "p") for k, u in enumerate(given)], "page_id long, url string, host string, path string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(df, URL_RULES).collect()}
    assert got == {k: slow_judge(u) for k, u in enumerate(given)}
    assert urls.judge(df.where("page_id < 0"), URL_RULES).count() == 0
    globs = urls.judge(df, [], [("*.org/**", "block")], otherwise="keep").collect()
    assert {r.verdict for r in globs} == {"block", "keep"} and {r.rule for r in globs} == {None}
    assert {r.verdict for r in urls.judge(df, []).collect()} == {"allow"}


def slow_found(docs, items, threshold=0.8, width=5):
    def split(text):
        return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]

    def shingles(found, k):
        return {" ".join(found[i : i + k]) for i in range(len(found) - k + 1)}

    out = set()
    for item, text in items:
        found = split(text)
        want = shingles(found, min(width, len(found))) if found else set()
        for doc, body in docs:
            n = len(want & shingles(split(body), min(width, len(found))))
            if want and doc is not None and item is not None and n >= round(threshold * len(want), 9):
                out.add((doc, item, len(want), n))
    return out


def test_contamination_against_brute_force(spark, sf_small, make_docs):
    rng = random.Random(6)
    items = [(r.item_id, r.text) for r in table(spark, sf_small, "benchmark").collect()]
    items += [(900, None), (901, ""), (902, "Two words"), (903, "one two three four five"), (904, "one two three four five six"), (905, "solo"), (None, "no id here at all"), (906, "rep rep rep rep rep rep rep")]
    docs = [(r.doc_id, r.text) for r in table(spark, sf_small, "documents").limit(60).collect()]
    for k in range(60):
        found = (items[k % 20][1] or "x").split()
        for _ in range(k % 4):
            found[rng.randrange(len(found))] = f"changed{k}"
        docs.append((5_000 + k, " ".join(["pad"] * rng.randrange(400) + found + ["pad"] * rng.randrange(400))))
    docs += [(6_000, None), (6_001, ""), (6_002, "TWO  words\tsolo"), (6_003, "one two three four five"), (None, "two words"), (6_004, "rep " * 20_000), (6_002, "again two words")]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, hash string")
    got = contamination.found_items(make_docs(docs), benchmark).collect()
    assert {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in got} == slow_found(docs, items)
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})
    clean = contamination.clean_of(make_docs(docs), benchmark)
    bad = {r.doc_id for r in got}
    assert sorted(r.doc_id or -1 for r in clean.collect()) == sorted(i or -1 for i, _ in docs if i not in bad)
    assert contamination.found_items(make_docs([]), benchmark).count() == 0
    assert contamination.found_items(make_docs(docs), benchmark.where("item_id < 0")).count() == 0


def test_contamination_is_the_same_when_nothing_may_be_broadcast(spark, sf_small, make_docs, monkeypatch):
    items = table(spark, sf_small, "benchmark")
    docs = table(spark, sf_small, "documents")
    want = {tuple(r) for r in contamination.found_items(docs, items).collect()}
    monkeypatch.setattr(contamination, "BROADCAST_BYTES", -1)
    assert {tuple(r) for r in contamination.found_items(docs, items).collect()} == want and want


@pytest.mark.parametrize(
    "module, label, held, least", [(quality, "quality", (3, 1), 0.9), (toxicity, "toxic", (4, 2), 0.9)]
)
def test_held_out_accuracy(spark, module, label, held, least):
    import zlib

    docs, labels = (table(spark, "/root/testdata/sf0.01", name) for name in ("documents", "labels"))
    model = module.train(docs, labels)
    rows = {r.doc_id: r for r in module.score(docs, model).collect()}
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % held[0] == held[1]) for r in rows.values())
    judged = [(rows[r.doc_id].predicted, r[label]) for r in labels.collect() if rows[r.doc_id].held_out]
    assert sum(a == b for a, b in judged) / len(judged) >= least
    again = {r.doc_id: r.score for r in module.score(docs, module.train(docs.repartition(3), labels)).collect()}
    assert all(abs(again[i] - rows[i].score) < 1e-6 for i in rows)


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_models_on_odd_rows(spark, make_docs, module, label):
    rows = [(1, None), (2, ""), (None, "some text"), (3, "x" * 100_000), (4, "word " * 50_000), (4, "word " * 50_000), (5, "漢字" * 3000)]
    docs = make_docs(rows)
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    for labels in (none, spark.createDataFrame([(k, 1) for k in range(9)] + [(None, 0), (3, None)], f"doc_id long, {label} int")):
        model = module.train(docs, labels)
        got = module.score(docs, model).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
        assert module.score(make_docs([]), model).count() == 0


def test_rules_as_columns_are_the_rules(spark, sf_small):
    docs, labels = (table(spark, "/root/testdata/sf0.01", name) for name in ("documents", "labels"))
    model = quality.train(docs, labels)
    assert model.rules and all(w != 0 for w in model.weights)
    rows = quality.with_statistics(docs, [docs["doc_id"]], docs["text"]).withColumn("score", model.column()).toPandas()
    x = rows[[f"s_{n}" for n in model.names]].to_numpy(float)
    margin = model.intercept + sum(w * r.holds(x) for r, w in zip(model.rules, model.weights))
    assert np.allclose(rows["score"], 1 / (1 + np.exp(-margin)))
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == (rows["score"] >= 0.5).sum()


def test_lasso_meets_its_optimality_conditions():
    rng = np.random.default_rng(3)
    z = (rng.random((400, 12)) < 0.4).astype(float)
    y = (rng.random(400) < 1 / (1 + np.exp(-(2 * z[:, 0] - 1.5 * z[:, 1])))).astype(float)
    w, b = quality.lasso(z, y, 0.02)
    gradient = z.T @ (1 / (1 + np.exp(-(z @ w + b))) - y) / len(y)
    assert (abs(gradient[w == 0]) <= 0.02 + 1e-3).all()
    assert np.allclose(gradient[w != 0], -0.02 * np.sign(w[w != 0]), atol=1e-3)


def slow_kernel(a, b):
    def features(word):
        out = {}
        for i in range(len(word)):
            for j in range(i + 1, len(word)):
                for k in range(j + 1, min(len(word), i + toxicity.SPAN)):
                    u = (word[i], word[j], word[k])
                    out[u] = out.get(u, 0) + toxicity.DECAY ** (k - i + 1)
        return out

    x, y = features(a), features(b)
    norm = toxicity._norms()
    return sum(v * y.get(u, 0) for u, v in x.items()) / norm[len(a)] / norm[len(b)]


def test_kernel_and_its_collapsed_form():
    symbols, starts, sizes, _ = toxicity.windows(["idiot idi-ot i d i o t 1d1ot such an ididiots ÉTAIT"])
    raw = symbols.tobytes()
    found = [raw[a : a + n] for a, n in zip(starts, sizes)]
    assert found[0] == found[1] == found[2] == found[3]
    kernel = toxicity.Kernel([found[0], found[-2], found[4]])
    values = kernel.values(found)
    assert np.allclose(values, [[slow_kernel(f, z) for z in kernel.landmarks] for f in found])
    alpha = np.array([1.0, -0.5, 2.0])
    table_ = kernel.collapsed(alpha)
    worst = toxicity.worst_words(["idiot such", "", "ididiots"], table_, -1.0)
    assert np.allclose(worst, [max(values[0] @ alpha, values[4] @ alpha) - 1, -1, values[-2] @ alpha - 1], atol=1e-5)


def test_place_in_a_long_word_does_not_matter():
    symbols, starts, sizes, _ = toxicity.windows(["idiot complete"])
    raw = symbols.tobytes()
    kernel = toxicity.Kernel([raw[a : a + n] for a, n in zip(starts, sizes)])
    table_ = kernel.collapsed(np.array([1.0, 1.0]))
    for word in ("idiot", "complete.idiot", "c o m p l e t e_i-d-i-o-t"):
        texts = ["x" * at + word.replace(" ", "_") + "x" * (120 - at) for at in range(121)]
        worst = toxicity.worst_words(texts, table_, 0.0)
        assert np.allclose(worst, worst[0]) and worst[0] > 0


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(toxicity, "SLICE", 50)
    text = "alpha beta gamma delta " * 20
    parts = toxicity._slices(text)
    assert "".join(parts) == text and len(parts) > 5 and all(p[0] == " " for p in parts[1:])
