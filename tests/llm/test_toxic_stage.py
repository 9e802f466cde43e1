"""The toxicity stage removes what is labelled toxic, and little else."""

import zlib

import corpus_pipeline as pipeline
import numpy as np
import pytest


def test_held_out_toxic_documents_go(spark):
    path = "/root/testdata/sf0.1"
    try:
        docs = spark.read.parquet(f"{path}/documents.parquet")
    except Exception:
        pytest.skip("driver tables not present")
    kept = {r.doc_id for r in pipeline.reject_toxic(spark, docs, path).select("doc_id").collect()}
    given = {r.doc_id for r in docs.select("doc_id").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    judged = [d for d in given & set(labels) if zlib.crc32(str(d).encode()) % 4 == 2]
    assert np.mean([d not in kept for d in judged if labels[d] == 1]) > 0.85
    assert np.mean([d in kept for d in judged if labels[d] == 0]) > 0.9
