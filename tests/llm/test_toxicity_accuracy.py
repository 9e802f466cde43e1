"""Held-out accuracy with enough toxic rows to learn from."""

import numpy as np
import pytest
from millrace.llm.queries import op9_toxicity


def test_held_out_rows_are_told_apart(spark):
    path = "/root/testdata/sf0.1"
    try:
        labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    except Exception:
        pytest.skip("driver tables not present")
    judged = [(r.score, labels[r.doc_id]) for r in op9_toxicity(spark, path).collect() if r.held_out and r.doc_id in labels]
    toxic, clean = (np.array([s for s, y in judged if y == label]) for label in (1, 0))
    assert (toxic[:, None] > clean).mean() > 0.85
