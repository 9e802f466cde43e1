import os

import pytest

from millrace.contract import text_schema
from millrace.sources import files
from millrace.sources.workspace import materialize
from millrace.streaming.ingest import ingest_available, staged_rows


def write(tmp_path, text, name="in.csv", encoding="utf-8"):
    path = tmp_path / name
    path.write_bytes(text.encode(encoding))
    return str(path)


CUSTOMERS = (
    "cust_id,cust_name,email,notes\r\n"
    "C1,Moor, Ada,ada@x.org,bare comma\r\n"
    'C2,"Moor, Ada",ADA@X.ORG,"said ""hi"", left"\r\n'
    "C3,Kit,,NA\r\n"
    "C4,short\r\n"
)


def test_quotes_line_ends_and_tokens(spark, tmp_path):
    path = write(tmp_path, CUSTOMERS)
    assert files.header_columns(spark, path) == ["cust_id", "cust_name", "email", "notes"]
    schema = text_schema(files.header_columns(spark, path))
    rows = {r.cust_id: r for r in files.extract(spark, path, schema).collect()}
    assert rows["C2"].cust_name == "Moor, Ada" and rows["C2"].notes == 'said "hi", left'
    assert rows["C3"].email is None and rows["C3"].notes is None


def test_ragged_rows_go_to_quarantine_untouched(spark, tmp_path):
    path = write(tmp_path, CUSTOMERS)
    scanned = files.scan_csv(spark, path, text_schema(files.header_columns(spark, path)), keep_raw_line=True)
    rows, quarantine = files.split_ragged(materialize(scanned, "test"))
    assert [r.raw_line for r in quarantine.collect()] == ["C1,Moor, Ada,ada@x.org,bare comma"]
    assert {r.cust_id: r.email for r in rows.collect()} == {"C2": "ADA@X.ORG", "C3": None, "C4": None}


def test_line_breaks_inside_quotes_need_the_option(spark, tmp_path):
    path = write(tmp_path, 'id,t\n1,"a\nb"\n2,c\n')
    rows = files.scan_csv(spark, path, text_schema(["id", "t"]), multi_line=True)
    assert [r.t for r in rows.collect()] == ["a\nb", "c"]
    assert files.count_records(rows).collect()[0].n_records == 2


def test_encoding(spark, tmp_path):
    path = write(tmp_path, "id,t\n1,Zürich\n", encoding="latin-1")
    rows = files.scan_csv(spark, path, text_schema(["id", "t"]), encoding="ISO-8859-1").collect()
    assert rows[0].t == "Zürich"


def test_wrong_header_is_an_error(spark, tmp_path):
    path = write(tmp_path, "id,x\n1,2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        files.scan_csv(spark, path, text_schema(["x", "id"])).collect()


def test_written_file_reads_back(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a "b", c'), ("2", None)], "id string, t string")
    files.write_csv(df, str(tmp_path / "out"))
    back = files.extract(spark, str(tmp_path / "out"), df.schema)
    assert sorted(back.collect()) == sorted(df.collect())


def test_stream_takes_each_file_once_and_batch_removes_repeats(spark, tmp_path):
    landing, staging, checkpoint = (str(tmp_path / n) for n in ("landing", "staging", "checkpoint"))
    os.mkdir(landing)
    schema = text_schema(["id", "t"])
    write(tmp_path / "landing", "id,t\n1,a\n2,NA\n", "one.csv")
    ingest_available(spark, landing, schema, staging, checkpoint, files_per_batch=1)
    write(tmp_path / "landing", "id,t\n2,b\n3,c\n", "two.csv")
    for _ in range(2):
        ingest_available(spark, landing, schema, staging, checkpoint, files_per_batch=1)
    assert spark.read.parquet(staging).count() == 4
    assert sorted(staged_rows(spark, staging, schema, ["id"]).collect()) == [("1", "a"), ("2", "b"), ("3", "c")]


def test_quotes_and_fields_are_counted_as_the_expressions_say(spark):
    texts = [None, "", ",", "a,b", "a,b,c", 'a,"b,c"', 'a,"b', '"a""b",c,d', 'x"y,z', '"a"b,c', "é,ü,", "\x00,,"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    old_odd = "coalesce(length(regexp_replace(t, '[^\"]', '')) % 2 = 1, false)"
    unquoted = """regexp_replace(t, r'"(?:[^"]++|"")*+"', '')"""
    old_ragged = f"(coalesce(size(split({unquoted}, ',', -1)), 0) > 2 OR {old_odd})"
    stripped = """regexp_replace(t, r'(?<![^,])"(?:[^"]++|"")*+"(?=,|\\z)', '')"""
    old_malformed = f"""coalesce({stripped} RLIKE r'(?<![^,])"', false)"""
    new = files.ragged_text_sql("t", 2), files.odd_quotes_sql("t"), files.malformed_sql("t")
    got = rows.selectExpr("t", *[f"{e} AS n{i}" for i, e in enumerate(new)], *[f"{e} AS o{i}" for i, e in enumerate((old_ragged, old_odd, old_malformed))])
    for r in got.collect():
        assert r[1:4] == r[4:7], r
