import hashlib
import zlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from millrace.llm import pieces
from millrace.llm.queries import op1_sentencepiece
from sentencepiece import sentencepiece_model_pb2 as schema

TEXTS = ["", None, " ", "   x  y ", "a\n\tb \n", "é 日本 語▁z \U0001f600", "the " * 3000, "internationalization", "<0x41> <s> </s>", "x" * 3000]


def _bpe():
    with open(pieces.default_path(), "rb") as f:
        return f.read()


def _unigram():
    """The same vocabulary read as a unigram model, with and without byte pieces."""
    model = schema.ModelProto()
    model.ParseFromString(_bpe())
    model.trainer_spec.model_type = pieces.UNIGRAM
    for p in model.pieces:
        p.score = p.score / 1000 if p.score > -1e8 else -50
    return model.SerializeToString()


KINDS = {"bpe": _bpe, "unigram": _unigram}
PAIRS = {k: (pieces.PieceModel(f()), sentencepiece.SentencePieceProcessor(model_proto=f())) for k, f in KINDS.items()}


def agree(kind, texts):
    mine, library = PAIRS[kind]
    for text, got in zip(texts, mine.encode(texts)):
        ids = np.frombuffer(got, "<u4").tolist()
        if kind == "bpe":
            assert ids == library.encode(text)
        else:
            # Segmentations of equal score are as good as each other.
            score = sum(library.get_score(i) for i in ids)
            assert score == pytest.approx(sum(library.get_score(i) for i in library.encode(text)), rel=1e-5)
        assert mine.decode(got) == library.decode(ids)


@pytest.mark.parametrize("kind", KINDS)
def test_edge_cases(kind):
    agree(kind, [t for t in TEXTS if t is not None])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=" \n\ttheinationsg.,1é日▁", max_size=25), max_size=5))
def test_bpe_equals_the_library(texts):
    agree("bpe", texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet=" theinationsg.,1é", max_size=25), max_size=5))
def test_unigram_scores_equal_the_library(texts):
    agree("unigram", texts)


def test_words_share_prefixes():
    mine = PAIRS["bpe"][0]
    words = ["▁nation", "▁national", "▁nationality", "▁natural"]
    assert dict(mine.segment(words[::-1])) == {w: next(p for _, p in mine.segment([w])) for w in words}


def test_rows(spark):
    df = spark.createDataFrame([(i, t, "a") for i, t in enumerate(TEXTS)] + [(None, "x", "b")], "doc_id bigint, text string, ids string")
    back = pieces.decode(pieces.encode(df)).collect()
    assert len(back) == len(TEXTS) + 1
    for r in back:
        text = "x" if r.doc_id is None else TEXTS[r.doc_id] or ""
        assert r.text == text.replace("▁", " ")
    assert pieces.piece_digests(df.limit(0)).count() == 0


def test_whole_table(spark, sf_dir):
    library = PAIRS["bpe"][1]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op1_sentencepiece(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode(docs[r.doc_id])
        assert (r.n_pieces, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert r.text_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_looks_back_no_further_than_a_piece_reaches():
    class Counted(dict):
        asked = 0

        def get(self, key, default=None):
            Counted.asked += 1
            return super().get(key, default)

    model = pieces.PieceModel(_bpe())
    model._endings = Counted(model._endings)
    word = "▁" + "zqxjkvwq" * 100
    assert dict(model.segment([word]))[word] == model._merge(word)
    assert len(word) < Counted.asked < 4 * len(word) and model.longest > 8


def test_a_block_beyond_the_table_is_forgotten():
    texts = [" ".join(f"w{i}x{j}" for j in range(50)) + " \U0001f600" for i in range(4)]
    small = pieces.PieceModel(_bpe(), remembered=60)
    assert [small.encode([t]) for t in texts] == [PAIRS["bpe"][0].encode([t]) for t in texts]
    assert len(small._known) == 60
