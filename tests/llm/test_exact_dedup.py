import hashlib
from collections import defaultdict

import oracle
import pytest
from millrace.llm.exact_dedup import drop_exact, exact_groups
from millrace.llm.queries import ORACLES, op3_exact_dedup
from pyspark.sql import functions as F

UPPER = {c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(rows, keep):
    groups = defaultdict(list)
    for doc, text in rows:
        groups["".join(UPPER.get(c, c) for c in text or "")].append(doc)
    out = []
    for doc, text in rows:
        key = "".join(UPPER.get(c, c) for c in text or "")
        ids = [d for d in groups[key] if d is not None]
        best = (max if keep == "largest" else min)(ids) if ids else None
        out.append((doc, best, len(groups[key]), hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=repr)


CASES = [
    [(i, "Same" if i % 3 else f"T{i % 7}") for i in range(400)],
    [(1, None), (2, ""), (3, "É"), (4, "é"), (None, "a"), (5, "A"), (None, "z"), (5, "a"), (6, "x" * 100000)],
    [],
]


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("rows", CASES)
def test_against_brute_force(spark, rows, keep):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(13)
    df = df.withColumns({"run": F.lit("r"), "digest": F.lit(1), "best": F.lit(None)})
    found = exact_groups(df, keep=keep, fan_in=2).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found], key=repr) == brute(rows, keep)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({r.text_sha256 for r in found}) and all(r.doc_id == r.keep_id for r in kept)


def test_whole_table(spark, sf_dir):
    duck = oracle.connect(sf_dir)
    assert oracle.differences(op3_exact_dedup(spark, sf_dir), duck, ORACLES["op3_exact_dedup"]) is None


def test_plan_is_native(spark, sf_dir):
    plan = op3_exact_dedup(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_columns_with_the_names_used_inside(spark):
    rows = [(1, "a", 7, 8, "x"), (2, "A", 7, 8, "x"), (2, "b", 7, 8, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, `__GONE` int, `__Row` int, `row` string")
    kept = drop_exact(df)
    assert kept.columns == df.columns and sorted(r.text for r in kept.collect()) == ["A", "b"]
