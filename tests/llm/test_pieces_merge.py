"""Merging of words that begin with several marks, in time that grows with their length."""

import random

import numpy as np
import pytest
import sentencepiece
from millrace.llm import pieces

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())


class Counting(dict):
    lookups = 0

    def get(self, *args):
        self.lookups += 1
        return super().get(*args)


def _model():
    with open(pieces.default_path(), "rb") as f:
        return pieces.PieceModel(f.read())


@pytest.mark.parametrize("text", [pieces.MARK * 2000 + "word", pieces.MARK * 2 + "internationalization" * 100])
def test_lookups_grow_with_the_length(text):
    model = _model()
    model.score = Counting(model.score)
    assert "".join(model._merge(text)) == text
    assert model.score.lookups < 5 * len(text)


@pytest.mark.parametrize("text", [" " * 200_000 + "word and  more", "  " + "abcdefgh" * 20_000])
def test_long_runs_equal_the_library(text):
    assert np.frombuffer(_model().encode([text])[0], "<u4").tolist() == LIBRARY.encode(text)


def _scanned(score, text):
    """All neighbours looked at again after each merge."""
    parts = list(text)
    while ranked := [(-score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in score]:
        i = min(ranked)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


def test_same_merges_as_a_full_scan():
    model, draw = _model(), random.Random(3)
    for _ in range(2000):
        text = "".join(draw.choices(pieces.MARK * 4 + "theinaosr1,é", k=draw.randint(0, 30)))
        assert model._merge(text) == _scanned(model.score, text)
