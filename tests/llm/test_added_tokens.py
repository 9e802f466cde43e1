"""Ids of the registered queries against the library at its defaults."""

import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from millrace.llm import tokens
from millrace.llm.queries import op2_packing, op8_token_files
from tokenizers import Tokenizer

LIBRARY = Tokenizer.from_file(tokens.default_path())
TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n y", "plain <|endoftext |> text", "", None, "z " * 3000 + "<|endoftext|>"]


def _library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("added"))
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").write.parquet(f"{path}/documents.parquet")
    return path


def test_the_token_is_one_id():
    assert _library(TEXTS[0]) == [64, 220, 50256, 275]
    ids, starts = tokens.encoder(tokens.default_path()).encode(pa.array(TEXTS, pa.string()))
    assert [x.tolist() for x in np.split(ids, starts[1:-1])] == [_library(t) for t in TEXTS]


def test_packing(spark, folder):
    found = defaultdict(list)
    for r in op2_packing(spark, folder).collect():
        found[r.doc_id].append(r)
    assert set(found) == set(range(len(TEXTS)))
    for doc, pieces in found.items():
        ids, at = [*_library(TEXTS[doc]), 0], 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), _crc(ids[at : at + p.length]))
            at += p.length
        assert at == len(ids)


def test_token_files(spark, folder):
    at = 0
    for r in sorted(op8_token_files(spark, folder).collect(), key=lambda r: r.doc_id):
        ids = [*_library(TEXTS[r.doc_id]), 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), _crc(ids))
        at += len(ids)


def test_pipeline_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = defaultdict(list)
    for p in sorted(corpus_pipeline.pack(spark, docs, folder).collect(), key=lambda p: (p.doc_id, p.start)):
        found[p.doc_id] += np.frombuffer(p.ids, "<u4").tolist()
    assert found == {i: [*_library(t), 0] for i, t in enumerate(TEXTS)}
