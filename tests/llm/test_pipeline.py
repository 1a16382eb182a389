from __future__ import annotations

import os

import pytest

import corpus_pipeline
from tideline.llm import decontamination, exact_dedup, jaccard_join, language_id

SF = "/root/testdata/sf0.001"


def test_stages():
    assert [s for s, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "decontamination", "merge_dropout"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_each_stage_does_what_its_report_says(spark):
    docs, ids = corpus_pipeline.table(spark, SF, "documents"), lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    reports = [
        lambda d: language_id.language_report(d).filter("lang_pred <> 'und'"),
        lambda d: exact_dedup.exact_dedup(d).filter("kept"),
        lambda d: jaccard_join.jaccard_classes(d).filter("class_id = doc_id"),
        lambda d: decontamination.contamination_report(d, corpus_pipeline.table(spark, SF, "benchmark")).filter("not contaminated"),
    ]
    for (_, stage), report in zip(corpus_pipeline.STAGES, reports, strict=False):
        kept = corpus_pipeline.materialise(stage(spark, docs, SF), "stage")
        assert kept.columns == docs.columns and ids(kept) == ids(report(docs))
        docs = kept
    out = corpus_pipeline.encoded(spark, docs, SF).collect()
    assert sorted(r.doc_id for r in out) == ids(docs) and all(r.lossless for r in out)
