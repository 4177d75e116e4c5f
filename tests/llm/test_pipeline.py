import corpus_pipeline
from plumbline.llm import contamination, quality, similar
from plumbline.llm.shared import stored, table

SF = "/root/testdata/sf0.01"


def test_stages_take_effect_and_keep_the_columns(spark):
    docs = table(spark, SF, "documents").selectExpr("*", "'x' AS size", "1 AS uid")
    labels = table(spark, SF, "labels")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF), "test")
        ids = [r.doc_id for r in after.select("doc_id").collect()]
        before = [r.doc_id for r in docs.select("doc_id").collect()]
        assert set(ids) <= set(before)
        if name == "quality":
            scores = quality.score(docs, quality.train(docs, labels)).collect()
            assert set(ids) == {r.doc_id for r in scores if r.predicted == 1} and len(ids) < len(before)
        if name == "near_copies":
            assert similar.one_of_each(after).count() == len(ids) < len(before)
        if name == "decontamination":
            found = contamination.found_items(docs, table(spark, SF, "benchmark")).collect()
            assert set(ids) == set(before) - {r.doc_id for r in found} and found
        if name == "mixing":
            assert len(ids) > len(set(ids)) and len(set(ids)) < len(before)
        if name == "token_planes":
            assert sorted(ids) == sorted(before)
        else:
            assert after.columns == docs.columns
        seen[name], docs = len(ids), after
    assert list(seen) == ["quality", "near_copies", "decontamination", "mixing", "token_planes"]


def test_run_is_the_stages_together(spark):
    rows = corpus_pipeline.run(spark, SF).orderBy("start").collect()
    assert rows and rows[0].start == 0
    assert all(a.start + a.n_tokens == b.start and a.doc_id <= b.doc_id for a, b in zip(rows, rows[1:]))


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, SF, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
