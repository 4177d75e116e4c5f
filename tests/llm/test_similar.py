import random

import numpy as np
import pytest

from plumbline.llm import similar, simhash


def family(n, spare, seed=1, length=200):
    """Texts that have most of their words in common, and places of their own."""
    rng = random.Random(seed)
    words = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    texts = []
    for _ in range(n):
        changed = list(words)
        for at in rng.sample(range(0, length, 10), spare):
            changed[at] = f"n{rng.randrange(10**9)}"
        texts.append(" ".join(changed))
    return texts


def similarity(a, b, size=5):
    x, y = (set(simhash.shingle_hashes(t.encode(), size).tolist()) for t in (a, b))
    return len(x & y) / len(x | y) if x | y else 1.0


def slow_groups(texts, share):
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if similarity(texts[a], texts[b]) >= share and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    return group


def test_one_of_each_group_of_near_copies_stays(make_docs, monkeypatch):
    monkeypatch.setattr(similar, "BLOCK", 8)
    monkeypatch.setattr(similar, "CELL", 2_000)
    rng = random.Random(1)
    rows, seeds = [], [[f"{s}v{rng.randrange(5000)}" for _ in range(300)] for s in range(30)]
    for s, words in enumerate(seeds):
        for c in range(s % 5 * 5 + 1):
            changed = list(words)
            for at in rng.sample(range(300), 2 * (c > 0)):
                changed[at] = f"n{rng.randrange(10**6)}"
            rows.append((1000 * s + c, " ".join(changed)))
    rows += [(50_000, None), (50_001, ""), (None, rows[0][1]), (None, None), (0, rows[0][1]), (60_000, "short text")]
    docs = make_docs(rows)
    kept = similar.one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert got == sorted([(False, 1000 * s) for s in range(30)] + [(False, 50_000), (False, 60_000), (True, 0), (True, 0)])
    assert similar.one_of_each(make_docs([])).count() == 0


def test_near_copies_are_those_that_share_their_shingles(make_docs):
    rng = random.Random(3)

    def changed(words, places):
        return [f"n{rng.randrange(10**9)}" if k in places else w for k, w in enumerate(words)]

    # Each change takes five of 296 shingles: six leave 0.816 in common, seven 0.788.
    near, far, aside = [], [], []
    for k in range(60):
        words = [f"k{k}w{rng.randrange(10**6)}" for _ in range(300)]
        near += [(10 * k, " ".join(words)), (10 * k + 1, " ".join(changed(words, range(10, 280, 50))))]
    for k in range(100, 160):
        words = [f"k{k}w{rng.randrange(10**6)}" for _ in range(300)]
        far += [(10 * k, " ".join(words)), (10 * k + 1, " ".join(changed(words, range(10, 280, 40))))]
    # The first two are apart, the third is a near copy of the second only.
    for k in range(200, 260):
        words = [f"k{k}w{rng.randrange(10**6)}" for _ in range(300)]
        second = changed(words, range(10, 280, 40))
        aside += [(10 * k, " ".join(words)), (10 * k + 1, " ".join(second)), (10 * k + 2, " ".join(changed(second, range(30, 280, 50))))]
    kept = {r.doc_id for r in similar.one_of_each(make_docs(near + far + aside)).select("doc_id").collect()}
    assert {i for i, _ in far} <= kept
    assert {i for i, _ in near} & kept == {i for i, _ in near if i % 10 == 0}
    assert {i for i, _ in aside} & kept == {i for i, _ in aside if i % 10 < 2}


@pytest.mark.parametrize("cell", [400_000, 1_500])
def test_against_brute_force_at_many_similarities(make_docs, monkeypatch, cell):
    monkeypatch.setattr(similar, "CELL", cell)
    monkeypatch.setattr(similar, "BLOCK", 16)
    texts = [t for spare in range(1, 8) for t in family(12, spare, seed=spare)]
    texts += [t for k in range(25) for t in family(3, 2, seed=100 + k, length=20 + k)]
    kept = {r.doc_id for r in similar.one_of_each(make_docs(list(enumerate(texts)))).select("doc_id").collect()}
    want = set(slow_groups(texts, 0.8))
    assert kept == want and 20 < len(want) < len(texts) - 20


def test_pairs_at_the_threshold_are_all_found(make_docs):
    """120 pairs at each of a few numbers of changed words; recall is whole at and above 0.8."""
    rng, rows, near = random.Random(5), [], []
    for k in range(360):
        words = [f"k{k}w{j}" for j in range(300)]
        other = list(words)
        for at in range(10, 10 + 50 * (6 - k % 3), 50):
            other[at] = f"n{rng.randrange(10**9)}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
        near.append(similarity(rows[-2][1], rows[-1][1]))
    kept = {r.doc_id for r in similar.one_of_each(make_docs(rows)).select("doc_id").collect()}
    assert min(near) >= 0.8 and min(near) < 0.82
    assert kept == {2 * k for k in range(360)}


def test_what_leaves_a_task_grows_with_the_rows(spark, make_docs, monkeypatch):
    """A family that is close in bits but below 0.8: edges are a tree, however many pairs there are."""
    seen = {}

    def counting(name):
        inner = getattr(similar, name)

        def run(*args):
            made = similar.stored(inner(*args), "counted")
            seen.setdefault(name, []).append(made.count())
            return made

        return run

    for name in ("_proposed", "_verified", "_compared"):
        monkeypatch.setattr(similar, name, counting(name))
    for n in (60, 120, 240):
        docs = make_docs(list(enumerate(family(n, 5, seed=n))))
        assert similar.one_of_each(docs).count() == n
    # The postings they share are as many for any number of texts.
    assert seen["_proposed"][2] <= 5 * seen["_proposed"][0]
    assert seen["_verified"] == seen["_compared"] == [0, 0, 0]


def test_near_fingerprints_meet_in_the_inverted_index(spark, make_docs, monkeypatch):
    """What differs in two bits of SimHash comes from the index over bytes, is verified, and is not proposed again."""
    words = [f"w{k}" for k in range(3000)]
    texts = [" ".join(words[:2990] + [f"n{c}"] + words[2990:]) for c in range(8)]
    texts += [" ".join(f"f{c}x{k}" for k in range(300)) for c in range(4)]
    bits = [np.frombuffer(simhash.wide_fingerprint(simhash.shingle_hashes(t.encode(), 5))[:8], "<u8")[0] for t in texts]
    near = [(a, b) for a in range(12) for b in range(a) if np.bitwise_count(bits[a] ^ bits[b]) <= similar.INDEXED]
    assert near and all(a < 8 for a, _ in near)
    seen = {}

    def counting(module, name):
        inner = getattr(module, name)

        def run(*args):
            made = similar.stored(inner(*args), "counted")
            seen.setdefault(name, []).append(made.count())
            return made

        monkeypatch.setattr(module, name, run)

    for name in ("linked", "_indexed", "_proposed", "_verified"):
        counting(similar, name)
    assert {r.doc_id for r in similar.one_of_each(make_docs(list(enumerate(texts)))).select("doc_id").collect()} == {0, 8, 9, 10, 11}
    group = list(range(8))
    for a, b in near:
        low, high = sorted((group[a], group[b]))
        group = [low if g == high else g for g in group]
    joined = 8 - len(set(group))
    assert seen["_indexed"] == [seen["_indexed"][0]] and seen["_indexed"][0] >= joined and seen["linked"]
    # Without the index seven edges would span the eight texts in every posting.
    assert seen["_proposed"][0] <= 7 * (len(set(group)) - 1) and seen["_verified"][0] >= joined
    # Fingerprints that are near although the texts are not fail on the shingles.
    monkeypatch.setattr(similar, "wide_fingerprint", lambda hashes: bytes(32))
    assert {r.doc_id for r in similar.one_of_each(make_docs(list(enumerate(texts)))).select("doc_id").collect()} == {0, 8, 9, 10, 11}


def test_overlaps_are_exact_by_both_ways(monkeypatch):
    rng = np.random.default_rng(3)
    for spread in (40, 400, 40_000):
        one, two = ([np.unique(rng.integers(0, spread, rng.integers(1, 60))).astype(np.uint64) for _ in range(n)] for n in (70, 30))
        want = [[len(np.intersect1d(a, b)) for b in two] for a in one]
        for at_once in (1 << 22, 64):
            monkeypatch.setattr(similar, "PAIRS_AT_ONCE", at_once)
            assert similar.overlaps(one, two).tolist() == want


def test_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(4)
    common = rng.integers(0, 255, similar.SKETCH_SLOTS).astype(np.uint8)
    for n in (1, 2, 4, 5, 9, 60, 300):
        whole = rng.integers(0, 2**63, n).astype(np.uint64)
        for gone in range(n // 5 + 1):
            a, b = np.unique(whole), np.unique(whole[gone:])
            if len(b) >= 0.8 * len(a):
                assert len(np.intersect1d(similar._prefix(a, common, 0.8), similar._prefix(b, common, 0.8)))
    assert len(similar._prefix(np.zeros(0, np.uint64), common, 0.8)) == 0
