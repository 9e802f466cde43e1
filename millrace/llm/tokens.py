"""Token ids of whole texts, with the merges of a repeated word done once."""

from __future__ import annotations

import functools
import os
import string
import struct
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np

#: Fixed value: the split that the byte-level vocabulary was made with.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words a worker remembers; the rest of a batch is encoded and forgotten.
REMEMBERED = 200_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class WordEncoder:
    """Ids of texts under a byte-level BPE file of the ``tokenizers`` library.

    No pretoken goes on past a visible character into white space, or past a letter or digit into
    a mark, so a text may be cut there and its words encoded apart.  A block's words are made
    distinct by Arrow; distinct words, and the pretokens inside words not seen before, are
    looked up in two bounded tables, and only new pretokens reach the library.  A text that
    holds one of the file's added tokens (``<|endoftext|>``) goes to the library whole.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = False
        self._added = [t.content.encode() for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._pretokens = regex.compile(PRETOKENS).findall
        self._visible, self._pack = _visible_bytes(), struct.pack
        self._words: dict[bytes, bytes] = {}
        self._parts: dict[str, bytes] = {}
        self._remembered = remembered
        self.vocabulary = self._tokenizer.get_vocab_size()

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of an Arrow string array, one text after the other, and where each text's begin.

        ``starts`` has one entry more than there are texts.  A null text is empty.
        """
        raw, bounds = _buffers(texts)
        ids, starts = self._encode_plain(raw, bounds)
        data = raw.tobytes()
        if not any(token in data for token in self._added):
            return ids, starts
        holding = [i for i in range(len(bounds) - 1) if any(t in data[bounds[i] : bounds[i + 1]] for t in self._added)]
        parts = np.split(ids, starts[1:-1])
        for i in holding:
            text = data[bounds[i] : bounds[i + 1]].decode()
            parts[i] = np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _encode_plain(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        import pyarrow as pa

        cuts = _cuts(raw, bounds)
        offsets = pa.py_buffer(np.append(cuts, len(raw)).astype("<i4"))
        words = pa.Array.from_buffers(pa.binary(), len(cuts), [None, offsets, pa.py_buffer(raw)]).dictionary_encode()
        runs = self._runs(words.dictionary.to_pylist())
        lengths = np.fromiter(map(len, runs), np.int64, len(runs)) // 4
        firsts = np.cumsum(lengths) - lengths
        pool = np.frombuffer(b"".join(runs), "<u4")
        codes = words.indices.to_numpy()
        sizes = lengths[codes]
        before = np.concatenate([[0], np.cumsum(sizes)])
        places = np.repeat(firsts[codes] - before[:-1], sizes) + np.arange(before[-1])
        return pool[places], before[np.searchsorted(cuts, bounds)]

    def _runs(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as bytes."""
        known = self._words
        fresh = [w for w in words if w not in known]
        room = max(0, self._remembered - len(known))
        known.update(zip(fresh, self._encode_words(fresh)))
        out = list(map(known.__getitem__, words))
        # The rest of the block is forgotten.
        for word in fresh[room:]:
            del known[word]
        return out

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        """Their ids; a pretoken that is not a word of its own is remembered too."""
        known, out = self._parts, []
        # The model takes bytes as visible characters and needs no second split.
        merge, visible, pack, pretokens = self._tokenizer.model.tokenize, self._visible, self._pack, self._pretokens
        room = max(0, self._remembered - len(known))
        fresh: dict[str, bytes] = {}
        for word in words:
            blank = word[:1] == b" "
            body = word[1:] if blank else word
            if body.isalpha() or body.isdigit():
                # ASCII letters or digits are one pretoken, and visible as they are.
                ids = [t.id for t in merge(("\u0120" if blank else "") + body.decode("ascii"))]
                out.append(pack(f"<{len(ids)}I", *ids))
                continue
            runs = []
            for part in pretokens(word.decode()):
                run = known.get(part) or fresh.get(part)
                if run is None:
                    ids = [t.id for t in merge(part.encode().decode("latin-1").translate(visible))]
                    run = fresh[part] = pack(f"<{len(ids)}I", *ids)
                runs.append(run)
            out.append(b"".join(runs))
        known.update(islice(fresh.items(), room))
        return out


def _visible_bytes() -> dict[int, str]:
    """Printable Latin-1 bytes stand for themselves, the rest for 256 and up."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in own)
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


#: Last bytes of white space outside ASCII, and the bytes before those.
_BLANK_LAST = np.isin(np.arange(256), [*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF])
_BLANK_BEFORE = np.isin(np.arange(256), [0xC2, 0x80, 0x81, 0x9A])
_VISIBLE = np.arange(256) > 0x20


def _bytes_of(text: str) -> np.ndarray:
    return np.isin(np.arange(256), list(text.encode("ascii")))


_LETTER = _bytes_of(string.ascii_letters)
_ENDING = _LETTER | _bytes_of(string.digits)
_MARK = _bytes_of(string.punctuation)


def _cuts(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where words begin: at each text, at a blank behind what is surely visible, at a mark behind a letter or digit.

    Only characters of ASCII, and of Latin letters in two bytes, are surely letters.  Where a
    word could have been cut and is not, it is only longer.
    """
    if not len(raw):
        return np.empty(0, np.int64)
    begins = np.zeros(len(raw), bool)
    last = raw[:-1]
    before = np.concatenate([raw[:1] * 0, raw[:-2]])
    blank = (raw[1:] == 0x20) & _VISIBLE[last] & (last != 0x7F) & ~(_BLANK_LAST[last] & _BLANK_BEFORE[before])
    latin = (before == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7)
    begins[1:] = blank | (_MARK[raw[1:]] & (_ENDING[last] | latin))
    # Texts may be empty: none of their words begin.
    begins[bounds[:-1][np.diff(bounds) > 0]] = True
    return np.flatnonzero(begins)


def _buffers(texts) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string array, nulls as empty texts."""
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n, at = len(texts), texts.offset
    offsets = np.frombuffer(texts.buffers()[1], "<i8")[at : at + n + 1] if n else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] else np.empty(0, np.uint8)
    return raw, offsets - offsets[0]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file."""
    return WordEncoder(path)


def text_blocks(texts: list[str], most_chars: int = 4_000_000) -> Iterator[tuple[int, list[str]]]:
    """Blocks of whole texts of about so many characters, with the index of their first."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most_chars:
            yield start, texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def array_blocks(texts, most_bytes: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of an Arrow string array of about so many bytes."""
    _, bounds = _buffers(texts)
    start, n = 0, len(texts)
    while start < n:
        stop = int(np.searchsorted(bounds, bounds[start] + most_bytes, "left"))
        stop = min(n, max(start + 1, stop))
        yield start, stop
        start = stop


def encoded(batches: Iterable, path: str) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(document ids, ids, starts) of blocks of Arrow batches with the columns ``id`` and ``text``."""
    encode = encoder(path).encode
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1)
        for start, stop in array_blocks(texts):
            yield ids[start:stop], *encode(texts.slice(start, stop - start))
