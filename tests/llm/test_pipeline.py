"""The stages, one after another, against what their operators say."""

import corpus_pipeline
from regweave.llm import jaccard_join, pii, quality
from regweave.llm.common import written

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    good = {r.doc_id for r in quality.verdicts(quality.measured(docs)).where("kept").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, written(stage(spark, docs, SF), "stage")
        assert k == 4 or docs.columns == columns, name
        if k == 0:
            assert {r.doc_id for r in docs.collect()} == good
        if k == 1:
            groups = {r.component_id for r in jaccard_join.join(before, size=5, percent=80).collect()}
            assert {r.doc_id for r in docs.collect()} == groups
        if k == 2:
            assert not any(pii.find(r.text or "", lambda z: ())[0] for r in docs.collect()) and docs.count() == before.count()
        if k == 3:
            known = {r.doc_id: r.text for r in before.collect()}
            assert all(r.text.strip() in known[r.doc_id] for r in docs.collect())
        if k == 4:
            fills = [r[1] for r in docs.groupBy("sequence_id").sum("length").collect()]
            assert max(fills) <= 1024 and len([f for f in fills if f < 1024]) <= before.rdd.getNumPartitions()


def test_every_operator_has_a_query():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
