import random
import re

import numpy as np
from xxhash import xxh64_intdigest

from plumbline.llm import components, embeddings, simhash
from plumbline.llm.shared import table


def groups(n, pairs):
    parent = list(range(n))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    return [top(k) for k in range(n)]


def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(found[k : k + 3]) for k in range(len(found) - 2)] or ([" ".join(found)] if found else [])
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(8, 60)] + [(3, 3)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {k: 100 for k in range(100, 141)} | {k: 7 for k in range(7, 60)}
    assert components.components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def test_fingerprints_and_components(spark, sf_small, make_docs):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_small, "documents").collect()]
    base = " ".join(f"w{k}" for k in range(600))
    rows += [(9_000, base), (9_001, base + " x"), (9_002, "ÉA b" + base), (9_003, None), (9_004, " \t"), (9_005, "One TWO"), (9_006, "one two"), (None, base), (9_000, base)]
    got = simhash.near_copies(make_docs(rows)).collect()
    assert len(got) == len(rows)
    ids = sorted({i for i, _ in rows if i is not None})
    fps = {i: slow_fingerprint(t or "") for i, t in rows if i is not None}
    tops = groups(len(ids), [(a, b) for a in range(len(ids)) for b in range(a) if (fps[ids[a]] ^ fps[ids[b]]).bit_count() <= 2])
    want = {i: ids[tops[k]] for k, i in enumerate(ids)}
    for r in got:
        if r.doc_id is None:
            assert r.component_id == want[9_000]
        else:
            assert (int(r.fingerprint, 16), len(r.fingerprint), r.component_id) == (fps[r.doc_id], 16, want[r.doc_id])
    assert simhash.near_copies(make_docs([])).count() == 0


def test_index_finds_every_pair_within_two_bits(spark):
    rng = random.Random(4)
    values = set()
    for _ in range(60):
        seed = rng.getrandbits(64)
        for _ in range(8):
            values.add(seed ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 2))))
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.linked(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    at = {v: k for k, v in enumerate(signed)}
    assert all((values[at[a]] ^ values[at[b]]).bit_count() <= 2 for a, b in edges)
    got = groups(len(values), [(at[a], at[b]) for a, b in edges])
    want = groups(len(values), [(a, b) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 2])
    assert got == want


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, key string, n long").repartition(3)


def test_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rng = np.random.default_rng(2)
    rows, k = [], 0
    for group in range(40):
        seed = rng.standard_normal(64)
        for _ in range(60 if group == 0 else 1 + group % 4):
            rows.append((k, (seed + 0.15 * rng.standard_normal(64)).astype(np.float32).tolist(), 0, "x", 1))
            k += 1
    rows += [(k + j, rows[0][1], 1, "x", 1) for j in range(30)]
    rows += [(k + 40, (np.array(rows[0][1]) * 3).tolist(), 1, "x", 1)]
    odd = [(900, None), (901, []), (902, [0.0] * 64), (903, [float("nan")] + [1.0] * 63), (904, [None] + [1.0] * 63), (905, [float("inf")] + [1.0] * 63), (906, [1.0, 2.0]), (907, [2.0, 4.0])]
    got = {r.vec_id: r for r in embeddings.near_vectors(vectors(spark, rows + [(i, v, 0, "x", 1) for i, v in odd])).collect()}
    assert len(got) == len(rows) + len(odd)
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    ids = [r[0] for r in rows]
    found = sum(got[i].n_links for i in ids)
    assert found >= 0.99 * near.sum()
    assert all(got[i].n_links <= n for i, n in zip(ids, near.sum(axis=1)))
    want = groups(len(ids), zip(*np.nonzero(near)))
    assert [got[i].component_id for i in ids] == [ids[k] for k in want]
    assert all(got[i].kept == (got[i].component_id == i) for i in got)
    for i in range(900, 906):
        assert (got[i].n_links, got[i].component_id) == (0, i)
    assert got[907].component_id == 906 and got[906].n_links == 1


def test_vectors_just_above_the_threshold_are_found(spark):
    rng = np.random.default_rng(8)
    rows = []
    for k in range(1200):
        x, other = rng.standard_normal((2, 64))
        x /= np.linalg.norm(x)
        other -= (other @ x) * x
        cosine = (0.9001, 0.91, 0.93)[k % 3]
        rows += [(2 * k, x.tolist()), (2 * k + 1, (cosine * x + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other)).tolist())]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embeddings.near_vectors(docs).collect()}
    for band in range(3):
        assert np.mean([got[2 * k] for k in range(band, 1200, 3)]) >= 0.9


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    arrays = np.random.default_rng(9)
    x = np.vstack([arrays.standard_normal((1, 20)) + 0.1 * arrays.standard_normal((40, 20)), arrays.standard_normal((80, 20))])
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embeddings.near_vectors(rows).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    seen = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    assert sum(got.values()) >= 0.9 * seen.sum() and all(got[k] <= n for k, n in enumerate(seen))


def test_codes_of_short_vectors_use_all_their_bits():
    x = np.random.default_rng(1).standard_normal((500, 20))
    mean, projections = embeddings.fit_codes(x / np.linalg.norm(x, axis=1)[:, None])
    for p in projections:
        code = embeddings.codes_of(x / np.linalg.norm(x, axis=1)[:, None], mean, p)
        ones = np.unpackbits(code.view(np.uint8).reshape(-1, 8), axis=1).mean(axis=0)
        assert ((ones > 0.2) & (ones < 0.8)).all()


def test_no_vectors(spark):
    assert embeddings.near_vectors(vectors(spark, [])).count() == 0
    only = embeddings.near_vectors(vectors(spark, [(1, None, 0, "x", 1)])).collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in only] == [(1, 0, 1, True)]


def test_rotation_balances_codes():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((2000, 64)) * np.linspace(0.1, 2, 64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    mean, projection = embeddings.fit_rotation(x)
    code = embeddings.codes_of(x, mean, projection)
    ones = np.unpackbits(code.view(np.uint8).reshape(-1, 8), axis=1).mean(axis=0)
    assert (abs(ones - 0.5) < 0.15).all()


def test_pairs_count_in_the_first_bucket_they_share():
    rng = np.random.default_rng(5)
    code = rng.integers(0, 2**63, 40, dtype=np.uint64)
    code[20:] = code[:20] ^ np.array([1 << int(b) for b in rng.integers(0, 63, 20)], np.uint64)
    slots, values = embeddings.bucket_keys(code, 4)
    for a in range(40):
        for b in range(40):
            met = [int(s) for s, x, y in zip(slots, values[a], values[b]) if x == y]
            assert embeddings.first_meeting(code[[a]] ^ code[[b]], 4)[0] == (met[0] if met else -1)
