"""The corpus pipeline, stage by stage, against what each stage promises."""

import collections

import corpus_pipeline
from reelpath.llm import mixing
from reelpath.llm.common import read_table
from reelpath.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "MinHash near-dedup", "benchmark decontamination",
                                                       "mixing to target weights", "token output"]
    docs = read_table(spark, SF, "documents")
    columns, bench = docs.columns, [r.text for r in read_table(spark, SF, "benchmark").collect()]
    seen = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "test-stage")
        stage(spark, docs, SF).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        rows = docs.collect()
        if name != "token output":
            assert docs.columns == columns
            assert {r for r in rows} <= {r for r in seen[-1]}
        if name == "MinHash near-dedup":
            texts = [r.text.lower() for r in rows]
            assert len(texts) == len(set(texts)) and {r.text.lower() for r in seen[-1]} >= set(texts)
        if name == "benchmark decontamination":
            leaked = {r.doc_id for r in seen[-1] if any(b in r.text for b in bench)}
            assert leaked and not leaked & {r.doc_id for r in rows}
            assert len(rows) >= len(seen[-1]) - 2 * len(leaked)
        if name == "mixing to target weights":
            want = {r.doc_id: r.copies for r in mixing.decide(before).collect()}
            got = collections.Counter(r.doc_id for r in rows)
            assert all(got[i] == n for i, n in want.items())
        if name == "token output":
            assert len(rows) == len(seen[-1])
        seen.append(rows)
    assert corpus_pipeline.run(spark, SF).count() == len(seen[-1])
