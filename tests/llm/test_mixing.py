import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from plumbline.llm import mixing
from plumbline.llm.shared import stored, table


def test_targets_share_anew_what_capped_sources_leave():
    got = mixing.targets({"a": 10, "b": 100, None: 1000, "c": 50}, [5, 2, 1], 1.5, 2.0)
    assert got["a"] == 20 and got["b"] == 200 and got["c"] == 100
    assert sum(got.values()) == pytest.approx(1.5 * 1160)
    assert mixing.targets({}, [1], 1.5, 2) == {}


def test_flight_keeps_words_and_number():
    sizes = [float(1 + k * 37 % 101) for k in range(500)]
    begun = [0.37] * 500
    p = mixing.flight(sizes, begun, 3)
    still = [x for x in p if 1e-9 < x < 1 - 1e-9]
    assert len(still) <= 2
    assert sum(x * s for x, s in zip(p, sizes)) == pytest.approx(0.37 * sum(sizes), abs=1e-5)
    assert sum(p) == pytest.approx(0.37 * 500, abs=1e-6)
    landed = mixing.landing(sizes, begun, p)
    assert set(landed) <= {0.0, 1.0}
    assert abs(sum(x * s for x, s in zip(landed, sizes)) - 0.37 * sum(sizes)) < 2
    assert abs(sum(landed) - 185) < 4


def test_flight_takes_each_document_as_often_as_promised():
    taken = [0] * 30
    for seed in range(600):
        p = mixing.flight([1.0, 5.0, 2.0] * 10, [0.3] * 30, seed)
        taken = [t + x for t, x in zip(taken, p)]
    assert all(0.2 < t / 600 < 0.4 for t in taken)


@pytest.mark.parametrize("block_rows", [20_000, 16])
def test_every_source_comes_near_its_target(spark, sf_small, block_rows):
    docs = table(spark, sf_small, "documents")
    rows = mixing.mix(docs, block_rows=block_rows).collect()
    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs.collect()}
    taken, target = defaultdict(int), {}
    for r in rows:
        assert r.size == words[r.doc_id] and r.taken == r.times * r.size <= 2 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert len(rows) == len(words)
    assert sum(target.values()) == pytest.approx(1.5 * sum(words.values()))
    for source in target:
        assert abs(taken[source] - target[source]) <= 0.02 * target[source] + 60
    again = mixing.mix(docs.repartition(5), block_rows=block_rows).collect()
    assert {(r.doc_id, r.taken) for r in again} == {(r.doc_id, r.taken) for r in rows}


def test_odd_rows(make_docs):
    rows = [(1, None, None), (1, "a b", None), (1, "a b", None), (None, "c d e", "x"), (None, "c d e", "x"), (4, "", "y"), (5, "w " * 9_000, "z")]
    docs = make_docs(rows)
    got = mixing.mix(docs).collect()
    assert len(got) == 7
    by_source = {r.source: (r.source_size, r.target) for r in got}
    assert by_source["y"] == (0, 0.0) and by_source[None][0] == 4
    assert mixing.mix(make_docs([])).count() == 0
    repeated = mixing.mixed(docs)
    assert repeated.columns == docs.columns
    assert repeated.count() == sum(r.times for r in got)
    assert mixing.mixed(make_docs([])).count() == 0


def test_a_repeated_row_goes_to_all_blocks(spark):
    """A third of all rows alike, over many input partitions or in one."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source")
    )
    for parts in (1, 12):
        given = stored(mixing.numbered(rows.repartition(parts)), "mix-test")
        dealt = mixing.dealt(given, 7)
        assert dealt.count() == 3000 and dealt.select("uid").distinct().count() == 3000
        blocks = dealt.groupBy(F.pmod("deal", F.lit(60)).alias("b")).agg(F.count("*").alias("n"), F.count_if(F.col("doc_id") == 7).alias("hot"))
        found = blocks.collect()
        assert len(found) == 60 and max(r["n"] for r in found) < 100
        assert max(r["hot"] for r in found) - min(r["hot"] for r in found) <= 1


def test_repeated_rows_are_mixed_whole_and_alike(spark):
    rows = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("x y")).otherwise(F.repeat(F.lit("a "), (F.col("id") % 40).cast("int"))).alias("text"),
        F.when(F.col("id") % 2 == 0, "s").alias("source"),
    )
    runs = [
        sorted((r["doc_id"], r["size"], r["source"] or "", r["times"]) for r in mixing.mix(rows.repartition(n), block_rows=50).collect())
        for n in (1, 9)
    ]
    assert len(runs[0]) == 900 and runs[0] == runs[1]
