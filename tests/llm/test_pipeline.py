import corpus_pipeline
from bidlines.llm import decontamination, simhash

SF = "/root/testdata/sf0.001"


def test_each_stage_does_its_work_on_what_its_predecessor_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, items = docs.columns, spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == columns
        texts.append({r["doc_id"]: r["text"] for r in docs.collect()})
    original = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert texts[0].items() <= original.items()
    seen = []
    for i in sorted(texts[1]):
        for line in texts[1][i].split("\n"):
            words = set(filter(None, line.split(" ")))
            assert not words or all(5 * len(words & s) < 4 * len(words | s) for s in seen)
            seen += [words] if words else []
    fps = [r["fp"] % (1 << 64) for r in simhash.fingerprints(spark.createDataFrame(list(texts[2].items()), "doc_id long, text string")).collect()]
    assert all((a ^ b).bit_count() > 3 for i, a in enumerate(fps) for b in fps[:i])
    assert texts[2].items() <= texts[1].items() and texts[3].items() <= texts[2].items()
    assert not decontamination.decontaminate(docs, items).where("contaminated").count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {(r["doc_id"], r["text"]) for r in last} <= texts[3].items()
    assert len({(r["doc_id"], r["copy_no"]) for r in last}) == len(last) and max(r["copy_no"] for r in last) <= 2
