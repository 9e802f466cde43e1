"""Web archives: records written once per payload, and read back by verified boundary chains."""

from __future__ import annotations

import base64
import hashlib
import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.clean import col
from millrace.llm.rows import numbered_rows
from millrace.sources.workspace import materialize

#: What a record begins with, ends with, and the profile of a revisit.
MAGIC = "WARC/1."
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: A payload that more than one of so many repeated rows share is looked up by broadcast,
#: which therefore holds fewer rows than this.
HOT = 1000

FIELDS = (
    "record_type string, record_id string, page_id bigint, refers_to bigint, url string, "
    "payload_digest string, payload_bytes bigint, payload_start bigint, sound boolean"
)
PIECES = f"file string, block bigint, file_size bigint, rel bigint, size bigint, need bigint, piece binary, {FIELDS}"
_FIELD_NAMES = [part.split()[0] for part in FIELDS.split(", ")]
_PIECE_NAMES = [part.split()[0] for part in PIECES.split(", ")]


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 160 bits are 32 letters, four in every five hex digits."""
    digits = F.sha1(payload.cast("binary"))

    def letter(i: Column) -> Column:
        group = F.conv(F.substring(digits, (i / 4).cast("int") * 5 + 1, F.lit(5)), 16, 10).cast("int")
        five = F.call_function("shiftright", group, (3 - i % 4) * 5).bitwiseAND(F.lit(31))
        return F.substring(F.lit(BASE32), five + 1, F.lit(1))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), letter), "")


def revisits(pages: DataFrame, row: str, id_col: str, payload: Column, min_bytes: int) -> DataFrame:
    """``row``, ``refers_row`` and ``refers_to`` of every row that repeats a payload.

    Of rows with equal payloads of at least ``min_bytes`` the one with the largest id (then
    row) is referred to.  Groups are counted by digest, which combines in each task; the few
    payloads that very many rows share are joined by broadcast, so no task holds one.
    """
    keyed = pages.select(
        col(row).alias("row"), col(id_col).cast("bigint").alias("id"), F.sha2(payload, 256).alias("key"), F.octet_length(payload).alias("bytes")
    ).where(F.col("bytes") >= min_bytes)
    groups = keyed.groupBy("key").agg(F.max(F.struct("id", "row")).alias("best"), F.count("*").alias("n"))
    groups = materialize(groups.where("n > 1"), "payloads")
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    crowded = F.col("n") * HOT > total
    marked = keyed.select("row", "key").join(F.broadcast(groups.where(crowded).select("key", "best")), "key", "left")
    rare = groups.where(~crowded).select("key", "best")
    found = marked.where("best IS NOT NULL").unionByName(marked.where("best IS NULL").drop("best").join(rare, "key"))
    links = found.where("row <> best.row").selectExpr("row", "best.row AS refers_row", "best.id AS refers_to")
    return materialize(links, "revisits")


def write_warc(
    pages: DataFrame,
    uri: str,
    min_bytes: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write one WARC/1.1 record per row under ``uri``, a new folder in any store Spark can write.

    Of rows with equal payloads of at least ``min_bytes`` bytes the one with the largest id
    becomes a ``response``; the others are ``revisit`` records that name it and carry its
    digest and HTTP header, without the payload.  Smaller payloads are all responses.  Record
    ids are ``<urn:millrace:row>``; ``Page-ID`` and ``Refers-To-Page-ID`` carry the ids.

    A record is one line of Spark's text writer, whose line end is the end of a record, so
    files are committed like any other output and a repeated task leaves nothing behind.
    Rows do not move unless the list of revisits is too large to broadcast.

    A null payload is empty, a null url or id is left out, repeated or null ids get records of
    their own (the last such row counts as the largest); line breaks and the magic in a url
    are percent-encoded; other columns are ignored; an empty table gives no records.
    """
    given = pages.select(col(id_col).alias("page_id"), col(url_col).alias("url"), F.coalesce(col(payload_col), F.lit("")).alias("html"))
    numbered, row = numbered_rows(given, "page_id")
    numbered = numbered.select(F.col(row).alias("row"), F.col("page_id").cast("bigint"), "url", "html")
    links = revisits(numbered, "row", "page_id", F.col("html"), min_bytes)
    linked = numbered.join(links, "row", "left")
    again = F.col("refers_row").isNotNull()
    url = F.replace(F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit(MAGIC), F.lit("WARC%2F1."))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("html").cast("string"), F.lit(END)
    )
    block = F.when(again, http).otherwise(F.concat(http, F.col("html")))

    def urn(c: str) -> Column:
        return F.concat(F.lit("<urn:millrace:"), F.col(c).cast("string"), F.lit(">"))

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value)

    header = F.concat_ws(
        "\r\n",
        F.lit(f"{MAGIC}1"),
        field("WARC-Type", F.when(again, "revisit").otherwise("response")),
        field("WARC-Record-ID", urn("row")),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", url),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("html")))),
        field("WARC-Profile", F.when(again, PROFILE)),
        field("WARC-Refers-To", urn("refers_row")),
        field("Page-ID", F.col("page_id").cast("string")),
        field("Refers-To-Page-ID", F.col("refers_to").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response"),
        field("Content-Length", F.octet_length(block).cast("string")),
    )
    linked.select(F.concat(header, F.lit(END), block)).write.option("lineSep", END).text(uri)


def _need(value: bytes) -> tuple[int | None, int]:
    """Bytes of the record that begins before ``value``, and where its block begins in it."""
    at = value.find(b"\r\n\r\n")
    if at < 0:
        return None, 0
    for line in value[:at].split(b"\r\n")[1:]:
        name, _, number = line.partition(b":")
        if name.strip().lower() == b"content-length":
            number = number.strip()
            return (len(MAGIC) + at + 4 + int(number) + 4, at + 4) if number.isdigit() else (None, 0)
    return None, 0


def _parse(value: bytes, start: int) -> tuple:
    """The `FIELDS` of a whole record without its magic, whose block begins at ``start``."""
    lines = value[: start - 4].decode("utf-8", "replace").split("\r\n")[1:]
    header = {n.strip().lower(): v.strip() for n, _, v in (line.partition(":") for line in lines)}
    kind = header.get("warc-type")
    block, length, sound, at = value[start:-4], None, True, start
    digest = header.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if header.get("content-type", "").startswith("application/http"):
        cut = block.find(b"\r\n\r\n") + 4
        at = start + cut
        for line in block[: cut - 4].split(b"\r\n")[1:]:
            name, _, number = line.partition(b":")
            if name.strip().lower() == b"content-length" and number.strip().isdigit():
                length = int(number)
        block = block[cut:]
    if kind == "response":
        found = base64.b32encode(hashlib.sha1(block).digest()).decode()
        length, sound, digest = len(block), digest in (None, found), found

    def number(name: str) -> int | None:
        text = header.get(name)
        return int(text) if text else None

    ids = number("page-id"), number("refers-to-page-id")
    return kind, header.get("warc-record-id"), *ids, header.get("warc-target-uri"), digest, length, at, sound


def _pieces(batches):
    """Every stretch between two magics, with the record it would be if one began before it."""
    import pyarrow as pa

    types = [pa.string(), *[pa.int64()] * 5, pa.binary(), pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 2, *[pa.int64()] * 2, pa.bool_()]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], _PIECE_NAMES)

    here, rel, rows, held = None, 0, [], 0
    for given in batches:
        for file, block, total, value in zip(*(given.column(i).to_pylist() for i in range(4))):
            if (file, block) != here:
                here, rel = (file, block), 0
            size = len(value) + len(MAGIC)
            need, start = _need(value)
            fields = _parse(value, start) if need == size else (None,) * len(_FIELD_NAMES)
            rows.append((file, block, total, rel, size, need, value, *fields))
            rel, held = rel + size, held + size
            if held > 16 << 20 or len(rows) == 5000:
                yield batch(rows)
                rows, held = [], 0
    if rows:
        yield batch(rows)


def _exits(group):
    """Where the chain from each candidate of a block leaves the block; -1: it breaks off."""
    import pandas as pd

    group = group[group.need.notna()].sort_values("at")
    at = group["at"].to_numpy(np.int64)
    after = at + group["need"].to_numpy(np.int64)
    place = np.searchsorted(at, after)
    out = after.copy()
    for i in range(len(at) - 1, -1, -1):
        j = place[i]
        if j < len(at):
            out[i] = out[j] if at[j] == after[i] else -1
    return pd.DataFrame({"file": group["file"], "at": at, "leaves": out})


def _owners(group):
    """Pieces that are not whole records by themselves, with the record that they belong to.

    The last row, without a place, names the last record that begins in the block.
    """
    import pandas as pd

    group = group.sort_values("at")
    at, need = group["at"].to_numpy(np.int64), group["need"].fillna(0).to_numpy(np.int64)
    entries = np.flatnonzero(group["entry"].to_numpy(bool))
    kept = np.zeros(len(at), bool)
    i = entries[0] if len(entries) else len(at)
    while i < len(at) and at[i] >= 0:
        kept[i] = True
        following = at[i] + need[i]
        i = np.searchsorted(at, following)
        if i < len(at) and at[i] != following:
            break
    last = np.maximum.accumulate(np.where(kept, np.arange(len(at)), -1))
    whole = kept & (need == group["size"].to_numpy(np.int64))
    loose = np.flatnonzero(~whole)
    owner = [int(at[last[j]]) if last[j] >= 0 else None for j in loose] + [int(at[last[-1]]) if last[-1] >= 0 else None]
    places = [int(x) for x in group["rel"].to_numpy(np.int64)[loose]] + [None]
    made = pd.DataFrame({"rel": pd.array(places, "Int64"), "owner": pd.array(owner, "Int64")})
    return made.assign(file=group["file"].iloc[0], block=group["block"].iloc[0])[["file", "block", "rel", "owner"]]


def reachable(places: DataFrame, blocks: DataFrame) -> DataFrame:
    """Offsets (``file``, ``at``) where a file's true chain enters a block, and its end.

    Each block is first contracted: a candidate points to where its chain leaves the block.
    Pointers of those that another block points to are then doubled, so a file of b blocks
    takes log b rounds, whatever its number of records.
    """
    jumps = materialize(places.groupBy("file", "block").applyInPandas(_exits, "file string, at bigint, leaves bigint"), "exits")
    targets = jumps.where("leaves > 0").select("file", F.col("leaves").alias("at")).distinct()
    roots = jumps.where("at = 0").select("file", "at")
    nodes = jumps.where("leaves > 0").join(targets.unionByName(roots).distinct(), ["file", "at"], "left_semi")
    nodes, reached = materialize(nodes, "nodes"), roots
    most = blocks.groupBy("file").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    rounds = math.ceil(math.log2(most + 1)) if most else 0
    for i in range(rounds):
        ahead = reached.join(nodes, ["file", "at"]).select("file", F.col("leaves").alias("at"))
        reached = materialize(reached.unionByName(ahead).distinct(), "reached")
        if i + 1 < rounds:
            second = nodes.select("file", F.col("at").alias("leaves"), F.col("leaves").alias("then"))
            doubled = nodes.join(second, ["file", "leaves"], "left").select("file", "at", F.coalesce("then", "leaves").alias("leaves"))
            nodes = materialize(doubled, "nodes")
    return reached


def read_warc(spark: SparkSession, uri: str) -> DataFrame:
    """The records of uncompressed WARC files: the columns of `FIELDS` but the last two, and ``payload``.

    Files are split at any byte.  Tasks cut their split at every magic and note, for each
    piece, where a record that begins there would end; numbers of bytes per split, summed in
    order, turn places into offsets.  Only records reached from a file's start by following
    these ends are kept, so a magic inside a payload begins none; its pieces are put together
    again with the record they belong to.

    ``payload`` is the body of a response and null for others; its digest is worked out anew
    and a record that contradicts its own digest is an error, as are files whose chain does
    not end at their end.  ``page_id`` and ``refers_to`` are those of `write_warc`, null in
    other archives.  A header must not hold the magic itself.  A folder without records gives
    no rows; equal records each count.
    """
    lines = spark.read.option("lineSep", MAGIC).text(uri).selectExpr(
        "_metadata.file_path AS file", "_metadata.file_block_start AS block", "_metadata.file_size AS file_size", "CAST(value AS binary) AS value"
    )
    # Offsets hold for one way of splitting only, so pieces are stored with them.
    path_pieces = lines.mapInArrow(_pieces, PIECES)
    pieces = materialize(path_pieces, "pieces", compression="zstd")
    sums = pieces.groupBy("file", "block").agg(F.sum("size").alias("bytes"), F.max("file_size").alias("file_size"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per split: at most a file's bytes over the size of a split for one file.
    blocks = materialize(sums.withColumn("base", F.coalesce(F.sum("bytes").over(before), F.lit(0))), "blocks")
    places = pieces.select("file", "block", "rel", "size", "need").join(blocks.select("file", "block", "base"), ["file", "block"])
    places = places.withColumn("at", F.col("base") + F.col("rel") - len(MAGIC)).drop("base")
    entries = reachable(places, blocks)
    ends = blocks.select("file", "file_size").distinct()
    broken = ends.join(entries.withColumnRenamed("at", "file_size"), ["file", "file_size"], "left_anti").count()
    if broken:
        raise ValueError(f"{broken} files under {uri} are no unbroken chain of records")
    marked = places.join(entries.withColumn("entry", F.lit(True)), ["file", "at"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    owners = marked.groupBy("file", "block").applyInPandas(_owners, "file string, block bigint, rel bigint, owner bigint")
    owners = materialize(owners, "owners")
    carried = owners.where("rel IS NULL").select(
        "file", "block", F.last("owner", ignorenulls=True).over(before).alias("carried")
    )
    loose = owners.where("rel IS NOT NULL").join(carried, ["file", "block"])
    loose = materialize(loose.select("file", "block", "rel", F.coalesce("owner", "carried").alias("owner")), "loose")
    key = ["file", "block", "rel"]
    plain = pieces.join(loose.select(*key), key, "left_anti").select("piece", *_FIELD_NAMES)
    parts = pieces.select(*key, "piece").join(loose.where("owner IS NOT NULL"), key)
    # A record's pieces: together no longer than the record.
    grouped = parts.groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("block", "rel", "piece"))).alias("parts"))
    joined = grouped.select(F.col("parts.piece").alias("parts")).mapInArrow(_rebuilt, f"piece binary, {FIELDS}")
    records = plain.unionByName(joined)
    digest = F.when(F.col("sound"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("a payload contradicts its digest")).cast("string"))
    # A piece still has the end of its record.
    body = F.expr("substring(piece, CAST(payload_start AS int) + 1, CAST(payload_bytes AS int))")
    return records.select(
        "record_type", "record_id", "page_id", "refers_to", "url", digest.alias("payload_digest"), "payload_bytes",
        F.when(F.col("record_type") == "response", body).alias("payload"),
    )


def _rebuilt(batches):
    """Records put together from the pieces around magics in their payloads."""
    import pyarrow as pa

    types = [pa.binary(), pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 2, *[pa.int64()] * 2, pa.bool_()]
    for given in batches:
        for parts in given.column(0):
            value = MAGIC.encode().join(p.as_py() for p in parts.values)
            need, start = _need(value)
            fields = _parse(value, start) if need else (None,) * len(_FIELD_NAMES)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((value, *fields), types)], ["piece", *_FIELD_NAMES])


def page_records(spark: SparkSession, uri: str) -> DataFrame:
    """What the archives hold of every page, without the payloads."""
    records = read_warc(spark, uri).where(F.col("record_type").isin("response", "revisit"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def warc_sql() -> str:
    """The same rows by DuckDB."""
    five = "((CAST('0x' || substr(h, (i // 4) * 5 + 1, 5) AS BIGINT) >> CAST((3 - i % 4) * 5 AS INT)) & 31) + 1"
    return f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
    g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS best FROM p)
    SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
           array_to_string([substr('{BASE32}', {five}, 1) FOR i IN range(32)], '') AS payload_digest,
           CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> best THEN best END AS refers_to
    FROM g
    """
