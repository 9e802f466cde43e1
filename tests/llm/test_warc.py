"""Archives written, split at any byte and read back, against a plain reader and DuckDB."""

import base64
import hashlib
import os
import re

import oracle
import pytest
from millrace.llm import queries, warc


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


FAKE = "WARC/1.1\r\nWARC-Type: response\r\nContent-Type: text/plain\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
PAYLOADS = [
    "",
    None,
    "<p>é😀</p>" * 50,
    "same",
    "same",
    "same",
    FAKE,
    FAKE * 40,
    "x" + FAKE + "WARC/1." * 30 + "tail",
    "WARC/1.",
    "WARC/1.1\r\nContent-Length: 99999999\r\n\r\n",
    "WARC/1.1\r\nContent-Length: -1\r\n\r\n" * 9,
    "long " * 4_000 + FAKE + "\r\n\r\n" * 2000,
    "\r\n\r\n",
    "WWARC/1WARC/1WARC/1.0\r\nContent-Length: 0\r\n\r\n\r\n\r\n" * 20,
    *[f"page {i} " * (i % 40) for i in range(60)],
]


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    for k, v in old.items():
        spark.conf.set(k, v)


def pages(spark, rows, parts=2):
    full = [(i, f"http://a/{i}", html, "x") for i, html in rows]
    return spark.createDataFrame(full, "page_id bigint, url string, html string, `row` string").repartition(parts)


@pytest.mark.parametrize("split,min_bytes", [(700, 0), (4096, 5), (1 << 26, 0)])
def test_round_trip(spark, tmp_path, small_splits, split, min_bytes):
    rows = [(i * 3, html) for i, html in enumerate(PAYLOADS)]
    warc.write_warc(pages(spark, rows), f"{tmp_path}/w", min_bytes)
    small_splits(split)
    found = {r.page_id: r for r in warc.read_warc(spark, f"{tmp_path}/w").collect()}
    assert len(found) == len(rows)
    best = {}
    for i, html in rows:
        if len((html or "").encode()) >= min_bytes:
            best[html or ""] = max(i, best.get(html or "", -1))
    for i, html in rows:
        r, text = found[i], html or ""
        first = best.get(text, i)
        assert (r.record_type, r.refers_to) == (("response", None) if first == i else ("revisit", first))
        assert (r.payload_digest, r.payload_bytes) == (digest(text), len(text.encode()))
        assert r.url == f"http://a/{i}"
        assert r.payload == (text.encode() if first == i else None)


def plain_records(data):
    """Records of an archive read from its start."""
    at, out = 0, []
    while at < len(data):
        assert data.startswith(b"WARC/1.1\r\n", at)
        head = data.index(b"\r\n\r\n", at)
        size = int(re.search(rb"\r\nContent-Length: (\d+)$", data[at:head]).group(1))
        out.append((data[at:head], data[head + 4 : head + 4 + size]))
        assert data[head + 4 + size :][:4] == b"\r\n\r\n"
        at = head + 8 + size
    return out


def test_files_are_archives(spark, tmp_path):
    rows = [(i, html) for i, html in enumerate(PAYLOADS)]
    warc.write_warc(pages(spark, rows), f"{tmp_path}/w")
    names = [n for n in os.listdir(tmp_path / "w") if n.startswith("part-")]
    records = [r for n in names for r in plain_records((tmp_path / "w" / n).read_bytes())]
    assert len(records) == len(rows)
    kinds = [re.search(rb"WARC-Type: (\w+)", head).group(1) for head, _ in records]
    assert kinds.count(b"revisit") == len(rows) - len({html or "" for _, html in rows})
    for head, block in records:
        if b"WARC-Type: revisit" in head:
            assert b"WARC-Profile: http" in head and block.endswith(b"\r\n\r\n") and block.startswith(b"HTTP/1.1 200 OK")


def test_null_and_repeated_ids_and_urls(spark, tmp_path):
    given = [(None, "u\r\nX: y", "a"), (None, None, "a"), (4, "http://x/WARC/1.0", "a"), (4, "b", "b"), (4, "b", "b"), (5, "", None)]
    df = spark.createDataFrame([(i, u, h, 1, 2) for i, u, h in given], "page_id bigint, url string, html string, `best` int, `key` int")
    warc.write_warc(df, f"{tmp_path}/w")
    found = warc.read_warc(spark, f"{tmp_path}/w").collect()
    assert sorted(((r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in found), key=repr) == sorted(
        [
            (None, digest("a"), "revisit", 4),
            (None, digest("a"), "revisit", 4),
            (4, digest("a"), "response", None),
            (4, digest("b"), "response", None),
            (4, digest("b"), "revisit", 4),
            (5, digest(""), "response", None),
        ],
        key=repr,
    )
    assert {r.url for r in found} == {"u%0D%0AX: y", None, "http://x/WARC%2F1.0", "b", ""}
    assert len({r.record_id for r in found}) == 6


def test_empty_table(spark, tmp_path):
    warc.write_warc(pages(spark, []), f"{tmp_path}/w")
    assert warc.read_warc(spark, f"{tmp_path}/w").collect() == []


def test_broken_archives_are_errors(spark, tmp_path):
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    for name, data in {"cut": record * 3 + record[:-2], "junk": record + b"junk" + record, "head": b"x" + record}.items():
        (tmp_path / name).write_bytes(data)
        with pytest.raises(ValueError, match="no unbroken chain"):
            warc.read_warc(spark, str(tmp_path / name))
    (tmp_path / "lie").write_bytes(record.replace(b"Content-Length", b"WARC-Payload-Digest: sha1:AAAA\r\nContent-Length"))
    with pytest.raises(Exception, match="contradicts its digest"):
        warc.read_warc(spark, str(tmp_path / "lie")).collect()


def test_other_archives(spark, tmp_path):
    record = b"WARC/1.0\r\nWARC-Type: %s\r\ncontent-length:%d\r\n\r\n%s\r\n\r\n"
    bodies = [(b"warcinfo", b"software: x"), (b"resource", bytes(range(256))), (b"response", b"\xff\xfe WARC/1.0\r\n\r\n")]
    (tmp_path / "a.warc").write_bytes(b"".join(record % (kind, len(body), body) for kind, body in bodies))
    found = warc.read_warc(spark, str(tmp_path / "a.warc")).collect()
    assert sorted(r.record_type for r in found) == ["resource", "response", "warcinfo"]
    assert [bytes(r.payload) for r in found if r.payload is not None] == [bodies[2][1]]


def test_query(spark, sf_dir):
    df = queries.QUERIES["op12_warc"](spark, sf_dir)
    assert oracle.differences(df, oracle.connect(sf_dir), queries.ORACLES["op12_warc"]) is None
