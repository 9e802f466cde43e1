"""Flat files of token ids with 64-bit document offsets."""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.clean import col
from millrace.llm import tokens

MANIFEST = "manifest.json"
READ = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _put(store, path: str, name: str, parts: list, tag: str) -> None:
    """Write a file under a name of this attempt, then give it its own name."""
    hidden = posixpath.join(path, f".{name}.{tag}")
    with store.open_output_stream(hidden) as out:
        for part in parts:
            out.write(part)
    store.move(hidden, posixpath.join(path, name))


def write_token_files(
    docs: DataFrame,
    uri: str,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
) -> None:
    """Write the ids of all documents, in ascending id order, under ``uri``.

    ``uri`` must be reachable by every executor.  Part ``i`` is three files: ``.ids`` (flat
    unsigned integers, 16 bits wide where the vocabulary fits, else 32), ``.offsets``
    (unsigned 64-bit, in ids, one more than documents, counted from the part's start) and
    ``.docs`` (signed 64-bit document ids).  ``manifest.json`` lists the parts with their
    bases: the ids and documents of all parts before, by prefix sums.

    Documents are dealt by ranges of their id, so a part is one task's work and no other
    column matters; a part is written again under the same names if its task is repeated.
    A null text is empty; rows with a null id come first and are marked in ``.nulls``; of
    equal ids the smaller text comes first; an empty table gives a manifest without parts.
    The tokenizer's added tokens are read in the texts, as the library does.
    """
    path = tokenizer or tokens.default_path()
    vocabulary = max(tokens.encoder(path).vocabulary, end_id + 1)
    width = 2 if vocabulary <= 1 << 16 else 4
    _store(uri)[0].create_dir(_store(uri)[1], recursive=True)

    def write(batches):
        import pyarrow as pa

        context = TaskContext.get()
        part, tag = context.partitionId(), str(context.taskAttemptId())
        store, folder = _store(uri)
        doc_ids, lengths = [], []
        name = f"part-{part:06d}"
        hidden = posixpath.join(folder, f".{name}.ids.{tag}")
        out = None
        for docs, ids, starts in tokens.encoded(batches, path):
            out = out or store.open_output_stream(hidden)
            lengths.append(np.diff(starts) + 1)
            out.write(memoryview(np.insert(ids, starts[1:], end_id).astype(f"<u{width}")).cast("B"))
            doc_ids += docs
        if out is None:
            return
        out.close()
        store.move(hidden, posixpath.join(folder, f"{name}.ids"))
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype("<u8")
        _put(store, folder, f"{name}.offsets", [offsets.tobytes()], tag)
        _put(store, folder, f"{name}.docs", [np.array([d or 0 for d in doc_ids], "<i8").tobytes()], tag)
        nulls = np.array([d is None for d in doc_ids], "u1")
        if nulls.any():
            _put(store, folder, f"{name}.nulls", [nulls.tobytes()], tag)
        row = [part], [len(doc_ids)], [int(offsets[-1])], [bool(nulls.any())]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in row], ["part", "docs", "tokens", "nulls"])

    source = docs.select(col(id_col).cast("bigint").alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    ordered = source.repartitionByRange("id").sortWithinPartitions("id", "text")
    # One row per part: bounded by the number of tasks, not by the documents.
    parts = sorted(ordered.mapInArrow(write, "part bigint, docs bigint, tokens bigint, nulls boolean").collect())
    bases = [0, *accumulate(p.tokens for p in parts)]
    firsts = [0, *accumulate(p.docs for p in parts)]
    listed = [
        {"name": f"part-{p.part:06d}", "docs": p.docs, "tokens": p.tokens, "nulls": p.nulls, "base": base, "first_doc": first}
        for p, base, first in zip(parts, bases, firsts)
    ]
    manifest = {"width": width, "tokens": bases[-1], "docs": firsts[-1], "parts": listed}
    store, folder = _store(uri)
    _put(store, folder, MANIFEST, [json.dumps(manifest).encode()], "new")


def read_manifest(uri: str) -> dict:
    store, folder = _store(uri)
    with store.open_input_stream(posixpath.join(folder, MANIFEST)) as f:
        return json.loads(f.read())


def _mapped(store, path: str, dtype: str) -> np.ndarray:
    """The file as an array: memory-mapped where the store is a mounted folder."""
    import pyarrow as pa
    from pyarrow import fs

    if not store.get_file_info(path).size:
        return np.empty(0, dtype)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with store.open_input_file(path) as f:
        return np.frombuffer(pa.py_buffer(f.read()), dtype)


def part_blocks(uri: str, part: dict, width: int, most_ids: int = 4_000_000) -> Iterator[tuple]:
    """(document ids, where each begins among all ids, ids) of one part, in blocks of whole documents."""
    store, folder = _store(uri)
    at = posixpath.join(folder, part["name"])
    ids = _mapped(store, f"{at}.ids", f"<u{width}")
    offsets = _mapped(store, f"{at}.offsets", "<u8").astype(np.int64)
    docs = _mapped(store, f"{at}.docs", "<i8")
    nulls = _mapped(store, f"{at}.nulls", "u1").astype(bool) if part["nulls"] else np.zeros(len(docs), bool)
    start = 0
    while start < len(docs):
        stop = min(len(docs), max(start + 1, int(np.searchsorted(offsets, offsets[start] + most_ids))))
        here = offsets[start : stop + 1]
        yield np.ma.array(docs[start:stop], mask=nulls[start:stop]), part["base"] + here, ids[here[0] : here[-1]]
        start = stop


def read_token_files(spark: SparkSession, uri: str) -> DataFrame:
    """One row per document of the files: id, start, n_tokens and ids (unsigned 32-bit)."""
    manifest = read_manifest(uri)
    parts, width = manifest["parts"], manifest["width"]

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for number in batch.column(0).to_pylist():
                for docs, starts, ids in part_blocks(uri, parts[number], width):
                    offsets = pa.py_buffer((4 * (starts - starts[0])).astype("<i4"))
                    texts = pa.Array.from_buffers(pa.binary(), len(docs), [None, offsets, pa.py_buffer(ids.astype("<u4"))])
                    columns = [pa.array(docs.data, mask=np.ma.getmaskarray(docs)), pa.array(starts[:-1]), pa.array(np.diff(starts)), texts]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])

    return spark.range(0, len(parts), 1, max(1, len(parts))).mapInArrow(read, READ)


def file_digests(spark: SparkSession, uri: str) -> DataFrame:
    """The documents of the files with a checksum in place of the ids."""
    return read_token_files(spark, uri).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
