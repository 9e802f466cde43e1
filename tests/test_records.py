"""Records with quoted line breaks, split at any byte, against the csv module."""

import csv
import io
import random

import pytest

from millrace.contract import text_schema
from millrace.sources import records
from millrace.sources.files import RAW_LINE

COLUMNS = ["id", "a", "b", "c"]


@pytest.fixture
def splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in names}
    spark.conf.set(names[1], "1")
    yield lambda n: spark.conf.set(names[0], str(n))
    for k, v in old.items():
        spark.conf.set(k, v)


def dirty(rng, breaks):
    piece = ["x", "yy", " ", ",", '"', "", "7", "é", "1,fake,row,z", "\t"] + ["\n", "\r\n", '\n"', '"\n', "\n\n", '",\n"'] * breaks
    return "".join(rng.choice(piece) for _ in range(rng.randrange(0, 9)))


def written(rows, end):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=end).writerows([COLUMNS, *rows])
    return out.getvalue()


@pytest.mark.parametrize("end,breaks,size", [("\n", 1, 220), ("\r\n", 3, 301), ("\n", 3, 1 << 26)])
def test_against_csv(spark, tmp_path, splits, end, breaks, size):
    rng = random.Random(size + breaks)
    expected = []
    for n in range(3):
        rows = [[f"{n}-{i}", *(dirty(rng, breaks) for _ in range(3))] for i in range(30)]
        (tmp_path / f"{n}.csv").write_bytes(written(rows, end).encode())
        expected += rows
    splits(size)
    lines = records.text_lines(spark, str(tmp_path))
    if size < 1000:
        assert lines.rdd.getNumPartitions() > 3 * 3
    found = records.scan_records(spark, str(tmp_path), text_schema(COLUMNS)).collect()
    wanted = [(*[x or None for x in row], None) for row in expected]
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)


def read(spark, path, text, header=True, encoding="UTF-8"):
    path.write_bytes(text.encode(encoding))
    return [tuple(r) for r in records.scan_records(spark, str(path), text_schema(COLUMNS), encoding, header).collect()]


def test_a_break_in_the_last_column_is_not_cut(spark, tmp_path):
    rows = read(spark, tmp_path / "f.csv", 'id,a,b,c\r\nK1,1,2,"note one\r\nnote two"\r\nK2,1,2,x\r\n')
    assert sorted(rows) == [("K1", "1", "2", "note one\r\nnote two", None), ("K2", "1", "2", "x", None)]


def test_malformed_and_ragged_records_are_kept_whole(spark, tmp_path):
    bad = ['B1,"abc"def,1,2', "B2,1,2,3,4", 'B3,5" pipe,1,2']
    rows = read(spark, tmp_path / "f.csv", "\n".join(["id,a,b,c", "K1,1", *bad, '"K2","say ""hi""",,', ""]))
    assert sorted(r[4] for r in rows if r[4]) == sorted(bad)
    assert sorted(r for r in rows if not r[4]) == [("K1", "1", None, None, None), ("K2", 'say "hi"', None, None, None)]
    assert all(r[:4] == (None,) * 4 for r in rows if r[4])


def test_a_quote_that_never_closes(spark, tmp_path, splits):
    lines = [f"K{i},1,2,3" for i in range(40)]
    splits(60)
    rows = read(spark, tmp_path / "f.csv", "\n".join(["id,a,b,c", *lines[:20], 'B,1,2,"open', *lines[20:], ""]))
    assert len(rows) == 41
    assert {r[0] for r in rows if not r[4]} == {f"K{i}" for i in range(20)}
    assert {r[4] for r in rows if r[4]} == {'B,1,2,"open', *lines[20:]}


def test_records_of_very_many_lines_are_not_gathered(spark, tmp_path, monkeypatch, splits):
    monkeypatch.setattr(records, "MOST_LINES", 5)
    splits(50)
    text = "\n".join(["id,a,b,c", 'K1,1,2,"a', *"bcdefgh", 'i"', 'K2,1,2,"x', 'y"', ""])
    rows = read(spark, tmp_path / "f.csv", text)
    assert sorted(r[4] for r in rows if r[4]) == sorted(['K1,1,2,"a', *"bcdefgh", 'i"'])
    assert [r for r in rows if not r[4]] == [("K2", "1", "2", "x\ny", None)]


def test_headers(spark, tmp_path):
    assert read(spark, tmp_path / "a.csv", '﻿"id",a,b,"c"\nK1,,,\n') == [("K1", None, None, None, None)]
    with pytest.raises(ValueError, match="CSV header does not conform"):
        read(spark, tmp_path / "b.csv", "id,b,a,c\nK1,,,\n")
    with pytest.raises(ValueError, match="CSV header does not conform"):
        read(spark, tmp_path / "c.csv", "id,a,b,c,d\nK1,,,\n")
    assert read(spark, tmp_path / "d.csv", "K1,1,2,3\n\n  \nK2,,,", header=False) == [
        ("K1", "1", "2", "3", None),
        ("K2", None, None, None, None),
    ]
    assert read(spark, tmp_path / "e.csv", "id,a,b,c\n") == [] == read(spark, tmp_path / "f.csv", "")


def test_encodings(spark, tmp_path):
    assert read(spark, tmp_path / "l.csv", 'id,a,b,c\n1,"Zü\nrich",,\n', encoding="ISO-8859-1")[0][1] == "Zü\nrich"
    with pytest.raises(ValueError, match="cannot be told apart"):
        records.text_lines(spark, str(tmp_path), "UTF-16")


def test_long_fields_need_no_stack(spark, tmp_path):
    long = 'x""' * 200_000
    rows = read(spark, tmp_path / "f.csv", f'id,a,b,c\n1,"{long}\n{long}",,\n')
    assert rows[0][1] == (long + "\n" + long).replace('""', '"')


def test_no_row_moves_without_quoted_breaks(spark, tmp_path):
    (tmp_path / "f.csv").write_text('id,a,b,c\n1,"x,y",,\n')
    plan = records.scan_records(spark, str(tmp_path / "f.csv"), text_schema(COLUMNS))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and RAW_LINE in plan
