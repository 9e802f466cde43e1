"""Each stage of the pipeline on its own input, against brute force."""

import corpus_pipeline as pipeline
import numpy as np
import pytest
from millrace.llm import packing, tokens
from millrace.sources.workspace import materialize
from test_minhash import brute as near_brute
from test_pseudonyms import brute as pii_brute
from tokenizers import Tokenizer


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    steps = []
    for name, stage in pipeline.STAGES:
        out = materialize(stage(spark, docs, sf_dir), name)
        if name != "packing":
            assert out.columns == columns
        steps.append((name, docs, out))
        docs = out
    rows = {name: ({r.doc_id: r.text for r in a.collect()}, b.collect()) for name, a, b in steps}

    given, kept = rows["toxicity"]
    ids = {r.doc_id for r in kept}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    clean = [d for d in given if labels.get(d) == 0]
    assert ids <= set(given) and np.mean([d in ids for d in clean]) > 0.9

    given, kept = rows["exact_dedup"]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    best = {}
    for d, t in sorted(given.items()):
        best[(t or "").translate(lower)] = d
    assert {r.doc_id for r in kept} == set(best.values())

    given, kept = rows["near_dedup"]
    order = sorted(given)
    classes = near_brute([given[d] for d in order], 0.8)
    assert {r.doc_id for r in kept} == {order[i] for i in set(classes)}

    given, kept = rows["pii"]
    assert {r.doc_id: (r.text, r.n_chars) for r in kept} == {
        d: (x := pii_brute(t, pipeline.KEY)[0], len(x)) for d, t in given.items()
    }

    given, pieces = rows["packing"]
    tokenizer = Tokenizer.from_file(tokens.default_path())
    got = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        got.setdefault(p.doc_id, []).extend(np.frombuffer(p.ids, "<u4").tolist())
    assert got == {d: tokenizer.encode(t, add_special_tokens=False).ids + [0] for d, t in given.items()}


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, "a", "en", "s", 1), (1, "A", None, "s", 1)]])
def test_odd_tables(spark, tmp_path, rows):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = pipeline.run(spark, str(tmp_path))
    assert out.count() <= max(1, len(rows)) and set(packing.PIECES.replace(",", "").split()[::2]) == set(out.columns)
