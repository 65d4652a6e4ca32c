"""The pipeline's stages on the smallest tables."""

import corpus_pipeline
from conftest import SF_SMALL
from plantlake.llm import decontamination, near_dup


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "minhash_near_dup", "decontamination", "secret_scans", "bpe"]
    once = corpus_pipeline.drop_near_duplicates(spark, docs, SF_SMALL)
    assert once.columns == docs.columns
    kept = near_dup.near_duplicates(docs, n=5, num=4, den=5).where("kept").select("doc_id")
    assert sorted(r[0] for r in once.select("doc_id").collect()) == sorted(r[0] for r in kept.collect())
    clean = corpus_pipeline.drop_benchmark_leaks(spark, docs, SF_SMALL)
    leaked = {r.doc_id for r in decontamination.find_leaks(docs, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in clean.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()} - leaked
    masked = corpus_pipeline.mask_secrets(spark, docs, SF_SMALL)
    assert masked.columns == docs.columns and masked.count() == docs.count()


def test_run_ends_in_tokens(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    rows = out.select("doc_id", "n_tokens").collect()
    assert 0 < len(rows) == len({r.doc_id for r in rows})
