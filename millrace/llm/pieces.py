"""SentencePiece encoding and decoding by a Viterbi pass over a trie of words."""

from __future__ import annotations

import functools
import heapq
import re
import struct
from collections.abc import Iterable, Iterator
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.clean import col
from millrace.llm.tokens import text_blocks

MARK = "▁"
#: Words a worker remembers; the rest of a block is encoded and forgotten.
REMEMBERED = 200_000
#: Pairs of pieces for which it remembers whether they merge.
REMEMBERED_PAIRS = 300_000
#: Kinds of pieces in a model file, and the kinds of models.
NORMAL, USER_DEFINED, BYTE = 1, 4, 6
UNIGRAM, BPE = 1, 2
#: Fixed value: how much an unknown character scores below the worst piece.
UNKNOWN_PENALTY = 10.0


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceModel:
    """Pieces of a SentencePiece model with identity normalisation.

    The best segmentation of a prefix does not depend on what follows, so distinct words
    are sorted, which lists them as a depth-first walk of their trie, and the states of a
    common prefix are worked out once.

    Unigram models: the state of a prefix is its best total score and last piece (Viterbi).
    BPE models: merging leaves exactly one last piece for each prefix, namely the one that
    merging alone leaves whole and that does not merge across its border with the last
    piece of the rest; so the state is that piece, and a step asks the same question of
    every piece that ends here.  Words that begin with several marks, where pieces of equal
    rank compete, are merged directly.
    """

    def __init__(self, serialized: bytes, remembered: int = REMEMBERED) -> None:
        from sentencepiece import sentencepiece_model_pb2 as schema

        model = schema.ModelProto()
        model.ParseFromString(serialized)
        normal = model.normalizer_spec
        if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces:
            raise ValueError("only models with identity normalisation and escaped blanks")
        self.kind = model.trainer_spec.model_type
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models")
        self.prefix = normal.add_dummy_prefix
        self.pieces = [p.piece for p in model.pieces]
        kinds = {p.type for p in model.pieces}
        if USER_DEFINED in kinds or 5 in kinds:
            raise ValueError("user-defined or unused pieces")
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.unknown = model.trainer_spec.unk_id
        bytes_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.byte_ids = [bytes_of[f"<0x{b:02X}>"] for b in range(256)] if len(bytes_of) == 256 else None
        self.longest = max(map(len, self.ids), default=1)
        self.worst = min(self.score.values(), default=0.0) - UNKNOWN_PENALTY
        inner = {c for piece in self.ids if len(piece) > 1 for c in piece}
        # A mark after another character never lies inside a piece, nor does a character
        # that only stands alone: words may be cut there.
        if any(MARK in piece.lstrip(MARK) for piece in self.ids):
            raise ValueError("a piece spans two words")
        lone = "".join(c for c in "\n\t\r\x0b\x0c" if c not in inner)
        self._cut = re.compile(f"[{re.escape(lone)}]|{MARK}+[^{MARK}{re.escape(lone)}]*|[^{MARK}{re.escape(lone)}]+" if lone else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        # Every ending of a piece: whether it is one that merging alone leaves whole.
        self._endings = {piece[at:]: False for piece in self.ids for at in range(len(piece) - 1)}
        if self.kind == BPE:
            self._endings |= {piece: True for piece in self.ids if len(piece) > 1 and self._merge(piece) == [piece]}
        self._packed = {piece: struct.pack("<I", i) for piece, i in self.ids.items()}
        self._apart: dict[tuple[str, str], bool] = {}
        self._known: dict[str, bytes] = {}
        self._remembered = remembered
        self._raw = [self._piece_bytes(p.piece, p.type) for p in model.pieces]

    @staticmethod
    def _piece_bytes(piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == NORMAL:
            return piece.replace(MARK, " ").encode()
        return b"" if kind == 3 else " ⁇ ".encode()

    def words(self, text: str) -> list[str]:
        """The marked words of a text."""
        marked = text.replace(" ", MARK)
        if not text:
            return []
        return self._cut.findall(MARK + marked if self.prefix else marked)

    def _merge(self, text: str) -> list[str]:
        """Merge neighbours whose union ranks highest, the leftmost of equals, until none can."""
        parts, n, get = list(text), len(text), self.score.get
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(-rank, i, 2) for i in range(n - 1) if (rank := get(text[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i]
            # Of pairs that have changed since, another entry tells.
            if not parts[i] or j == n or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i], parts[j] = parts[i] + parts[j], ""
            after[i] = j = after[j]
            if j < n:
                before[j] = i
            for a, b in ((before[i], i), (i, j)):
                if a >= 0 and b < n and (rank := get(parts[a] + parts[b])) is not None:
                    heapq.heappush(heap, (-rank, a, len(parts[a]) + len(parts[b])))
        return [part for part in parts if part]

    def _fits(self, left: str, right: str) -> bool:
        if len(self._apart) >= REMEMBERED_PAIRS:
            self._apart.clear()
        fits = self._apart[left, right] = self._merge(left + right) == [left, right]
        return fits

    def segment(self, words: Iterable[str]) -> Iterator[tuple[str, list[str]]]:
        """Each distinct word with its pieces, in sorted order: a depth-first walk of the trie."""
        before, last, total = "", [""], [0.0]
        score, longest, unigram = self.score, self.longest, self.kind == UNIGRAM
        ending, apart, fits = self._endings.get, self._apart, self._fits
        for word in sorted(set(words)):
            if not unigram and word.startswith(MARK + MARK):
                yield word, self._merge(word)
                continue
            depth = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                depth += 1
            del last[depth + 1 :], total[depth + 1 :]
            before = word
            for end in range(depth + 1, len(word) + 1):
                found = word[end - 1]
                if unigram:
                    best = total[end - 1] + score.get(found, self.worst)
                    for start in range(max(0, end - longest), end - 1):
                        piece = word[start:end]
                        if piece in score and total[start] + score[piece] > best:
                            found, best = piece, total[start] + score[piece]
                    total.append(best)
                else:
                    # Pieces that end here, shortest first, as far back as any piece reaches.
                    ends_here = []
                    for start in range(end - 2, -1, -1):
                        piece = word[start:end]
                        whole = ending(piece)
                        if whole is None:
                            break
                        if whole:
                            ends_here.append(piece)
                    while ends_here:
                        piece = ends_here.pop()
                        left = last[end - len(piece)]
                        if left:
                            fit = apart.get((left, piece))
                            if not (fits(left, piece) if fit is None else fit):
                                continue
                        found = piece
                        break
                last.append(found)
            pieces, end = [], len(word)
            while end:
                pieces.append(last[end])
                end -= len(last[end])
            yield word, pieces[::-1]

    def _ids_of(self, pieces: list[str]) -> list[int]:
        out = []
        for piece in pieces:
            found = self.ids.get(piece)
            if found is not None:
                out.append(found)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in piece.encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)  # a run of unknown characters is one piece
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        cut, known, packed = [self.words(text) for text in texts], self._known, self._packed
        new, room = set().union(*cut).difference(known), max(0, self._remembered - len(known))
        for word, pieces in self.segment(new):
            try:
                known[word] = b"".join([packed[piece] for piece in pieces])
            except KeyError:  # characters without a piece
                ids = self._ids_of(pieces)
                known[word] = struct.pack(f"<{len(ids)}I", *ids)
        out = [b"".join(map(known.__getitem__, words)) for words in cut]
        if len(new) > room:
            # The first ones stay, in the order of the table; the rest of the block is forgotten.
            for word in list(islice(reversed(known), len(new) - room)):
                del known[word]
        return out

    def decode(self, ids: bytes) -> str:
        """The text of some ids; the blank put before a text is taken away."""
        raw = self._raw
        out = b"".join([raw[i] for (i,) in struct.iter_unpack("<I", ids)])
        if self.prefix and out.startswith(b" "):
            out = out[1:]
        return out.decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def loaded(path: str) -> PieceModel:
    """One model per worker process and file."""
    with open(path, "rb") as f:
        return PieceModel(f.read())


def encode(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit) of every document.

    ``model`` is a file that every worker has.  A null text is empty, a null id stays null,
    rows are encoded one by one where they are read; other columns are ignored.
    """
    path = model or default_path()

    def run(batches):
        import pyarrow as pa

        encoder = loaded(path).encode
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for start, block in text_blocks(texts):
                columns = [ids.slice(start, len(block)), pa.array(encoder(block), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids"])

    source = docs.select(col(id_col).cast("bigint").alias("doc_id"), col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id bigint, ids binary")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """The rows of `encode` with ``text`` worked out from the ids; null ids give null."""
    path = model or default_path()

    def run(batches):
        import pyarrow as pa

        decoder = loaded(path).decode
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.slice(at, 1000)
                texts = [None if ids is None else decoder(ids) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids binary, text string")


def piece_digests(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Number of pieces, checksum of the ids, and digest of the decoded text."""
    back = decode(encode(docs, model), model)
    return back.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        F.sha2("text", 256).alias("text_sha256"),
    )
