import random
import re

import pyarrow as pa
from millrace.llm import words as module
from millrace.llm.words import Words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def check(texts, array=None):
    found = Words(pa.array(texts, pa.string()) if array is None else array, 2)
    expected = [WORD.findall(t or "") for t in texts]
    flat = [w for words in expected for w in words]
    assert found.counts.tolist() == [len(words) for words in expected]
    assert [found.raw[a:b].tobytes().decode() for a, b in zip(found.first, found.last)] == flat
    for lane in found.lanes:
        numbers = dict(zip(flat, lane.tolist()))
        assert len(set(numbers.values())) == len(numbers)
        assert [numbers[w] for w in flat] == lane.tolist()


def test_words(monkeypatch):
    check([])
    check([None, "", " \n"])
    check(["x" * 500 + " " + "y" * 70, "x" * 500, "é ñ\x85x", "日本 語", "ab", "cd"])
    rng = random.Random(0)
    for size in (37, 1 << 20):
        monkeypatch.setattr(module, "SLICE", size)
        for _ in range(200):
            texts = [
                "".join(rng.choice("  \n\tabé") for _ in range(rng.randrange(60))) if rng.random() > 0.1 else None
                for _ in range(rng.randrange(8))
            ]
            check(texts)
            if len(texts) > 2:
                check(texts[1:-1], pa.array(texts, pa.string()).slice(1, len(texts) - 2))
