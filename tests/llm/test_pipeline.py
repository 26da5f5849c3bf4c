"""The pipeline's stages one after another, against brute force on each one's input."""

import re

import brute
import corpus_pipeline
import fixture


def write(spark, tmp_path, rows, labels):
    fixture.frame(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(
        f"{tmp_path}/labels.parquet")


def test_stages(spark, tmp_path):
    rows = fixture.documents(seed=8)
    good = [i for i, t in rows[:60]]
    write(spark, tmp_path, rows, [(i, 1, 0) for i in set(good[:30])] + [(5000, 0, 0)])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        was = [(r.doc_id, r.text) for r in before.collect()]
        if name != "packing":
            assert docs.columns == before.columns
            now = [(r.doc_id, r.text) for r in docs.collect()]
            seen.append(len(now))
        if name == "quality_rules":  # only bad rows are labelled outside the table: the forest rejects none
            assert sorted(now, key=str) == sorted((r for r in was if not brute.rule_statistics(r[1])[1]), key=str)
        elif name == "exact_dedup":
            texts = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in now]
            assert len(set(texts)) == len(texts) == sum(r[3] for r in brute.exact_rows(was))
        elif name == "simhash_dedup":
            root = brute.linked([brute.fingerprint(t) for _, t in was])
            assert sorted(root[brute.fingerprint(t)] for _, t in now) == sorted(set(root.values()))
        elif name == "substring_dedup":
            want = {(i, s) for i, _, _, s in brute.windows_removed(was)}
            assert {(i, brute.sha(" ".join(brute.words(t)))) for i, t in now} == want
        else:
            pieces = docs.collect()
            assert {p.doc_id for p in pieces} == {i for i, _ in was}
            totals = {}
            for p in pieces:
                totals[p.sequence_id] = totals.get(p.sequence_id, 0) + p.length
            assert max(totals.values()) <= 2048
    assert seen[0] < len(rows) and seen == sorted(seen, reverse=True)


def test_run_equals_the_stages_on_an_empty_table(spark, tmp_path):
    write(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
