"""Every stage on its own: the columns of documents come out, decisions take effect, empty tables pass through."""

import corpus_pipeline as P
from plotloom.llm import simhash, toxicity
from plotloom.llm.common import read

SF = "/root/testdata/sf0.001"


def test_stages_run_in_order(spark):
    docs = read(spark, SF, "documents")
    assert [n for n, _ in P.STAGES] == ["quality_rules", "toxicity", "near_dedup", "decontamination", "packing"]
    before = docs
    for name, stage in P.STAGES[:-1]:
        after = stage(spark, before, SF)
        path_rows = after.collect()
        assert after.columns == docs.columns, name
        ids = [r.doc_id for r in path_rows]
        assert len(ids) == len(set(ids)) and set(ids) <= {r.doc_id for r in before.select("doc_id").collect()}, name
        before = spark.createDataFrame(path_rows, docs.schema)
    kept = {r.doc_id for r in before.collect()}
    packed = P.STAGES[-1][1](spark, before, SF).collect()
    assert {r.doc_id for r in packed} == kept and len(kept) > 100
    groups = [r.component_id for r in simhash.near_duplicates(before).collect()]
    assert len(groups) == len(set(groups))


def test_empty_documents_pass_through(spark):
    docs = read(spark, SF, "documents").limit(0)
    for name, stage in P.STAGES:
        assert stage(spark, docs, SF).count() == 0, name


def test_learning_leaves_held_out_labels_alone(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    drawn = {r.fold for r in toxicity.labelled(docs, labels).select("fold").distinct().collect()}
    assert toxicity.HELD_OUT not in drawn
