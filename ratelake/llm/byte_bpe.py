"""Byte-level BPE through a sentencepiece model written from a rank file.

The vocabulary (bytes and rank of every token) becomes a sentencepiece BPE
model without training: every byte maps to one character, so every token is a
piece of such characters, scored by its negative rank; the normaliser is the
identity. Merging the best-scored pair first is then the same as merging the
pair of lowest rank first. Texts are split by the vocabulary's pattern, every
pre-token is encoded by itself, and ids are decoded by the inverse map from
pieces to bytes.

The serialised model (a few megabytes, fixed by the vocabulary) is broadcast;
documents are independent, so there is no shuffle. A task works on a group of
documents after the other, a long one in parts: the new pre-tokens of a group
go to the model in one call, since each call has a cost of its own. It keeps the
pre-tokens it has seen in a table that starts anew beyond ``CACHE`` entries.
Ids are decoded by one gather from the pieces' bytes for a whole batch.

Rules: a null text is an empty one and has no ids; a null id of a row stays
null; rows that repeat give rows that repeat; all other columns are left out,
whatever their names. An id outside the vocabulary raises in ``decode``, a
null list of ids decodes to no bytes.
"""

from __future__ import annotations

import base64
import struct
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate, chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: pre-tokens whose ids a task remembers, and their characters
CACHE = 1 << 18
CACHE_CHARS = 1 << 22
#: characters of texts split at once
PART = 1 << 18
#: ids in one batch of results
BATCH_IDS = 1 << 18

#: the character of byte b is the one b places after this one
_FIRST = 0x100
#: encodes to the byte 255
_APART = "\udcff"
#: a place where no match of the pattern can go on: before the white space
#: that follows other characters
_CUT = regex.compile(r"(?<=\S)\s")


class Vocabulary(NamedTuple):
    """All that a worker needs: the serialised model, the split pattern and
    the characters whose class differs between the regular expressions used
    here and those of the tokenizer library, with a stand-in of its class."""

    model: bytes
    pattern: str
    stand_ins: dict[int, str]


def _mapped(data: bytes) -> str:
    """One character for each byte; in UTF-8 each takes two bytes."""
    code = np.frombuffer(data, np.uint8).astype(np.uint16) + _FIRST
    wide = np.stack([0xC0 | code >> 6, 0x80 | code & 0x3F], axis=1).astype(np.uint8)
    return wide.tobytes().decode()


def _bytes(piece: str) -> bytes:
    return bytes(ord(c) - _FIRST for c in piece)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _message(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model (protocol buffer) of a vocabulary. Field
    numbers are those of the public model format: pieces (1) of text, score
    and kind, trainer (2) with the model kind, normaliser (3)."""
    normal, unknown, bpe = 1, 2, 2

    def piece(text: str, score: float, kind: int) -> bytes:
        return _message(1, _message(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))

    pieces = [piece(_mapped(token), -float(rank), normal) for token, rank in sorted(ranks.items(), key=lambda x: x[1])]
    # no text holds the unknown piece: every byte has a piece of its own
    pieces.append(piece("<unk>", 0.0, unknown))
    # no dummy prefix, no white space removed, none escaped
    identity = _message(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _message(2, _number(3, bpe)) + _message(3, identity)


def _classes(members: Callable[[str], set[str]]) -> dict[str, str]:
    """Class of every letter, number and white space by its stand-in."""
    return {c: sign for sign, kind in (("a", r"\p{L}"), ("0", r"\p{N}"), ("\n", r"\s")) for c in members(kind)}


def _stand_ins() -> dict[int, str]:
    """Characters that the two libraries' Unicode tables put in different
    classes: the splitting must be the tokenizer library's."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([b]): b for b in range(256)}

    def theirs(kind: str) -> set[str]:
        # text that does not match the pattern is left out of the encoding
        matcher = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks=single, special_tokens={})
        return set(bytes(matcher.encode_ordinary(every)).decode())

    here, there = _classes(lambda kind: set(regex.findall(kind, every))), _classes(theirs)
    return {ord(c): there.get(c, "!") for c in here.keys() | there.keys() if here.get(c) != there.get(c)}


def vocabulary(path: str, pattern: str) -> Vocabulary:
    """Read a rank file (base64 token and rank per line), on the driver. The
    ranks must be 0, 1, ... and every single byte a token."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}
    if sorted(ranks.values()) != list(range(len(ranks))) or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError(f"{path} must hold every byte and the ranks 0 to n - 1")
    return Vocabulary(serialise(ranks), pattern, _stand_ins())


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, vocab: Vocabulary) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_proto=vocab.model)
        texts = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size() - 1)]
        self.whole = {text: np.int32(i).tobytes() for i, text in enumerate(texts)}
        self.pieces = pa.array([_bytes(text) for text in texts], pa.binary())
        self.split = regex.compile(vocab.pattern).findall
        self.spans = regex.compile(vocab.pattern).finditer
        self.stand_ins = vocab.stand_ins
        self.odd = np.zeros(0x110000, bool)
        self.odd[list(vocab.stand_ins)] = True
        self.seen: dict[str, bytes] = {}
        self.held = 0

    def pre_tokens(self, text: str) -> list[str]:
        if text.isascii() or not self.odd[np.frombuffer(text.encode("utf-32-le"), np.uint32)].any():
            return self.split(text)
        return [text[m.start() : m.end()] for m in self.spans(text.translate(self.stand_ins))]

    def _learn(self, words: Iterable[str]) -> None:
        """Put the ids of all distinct pre-tokens into the table, as bytes."""
        if len(self.seen) > CACHE or self.held > CACHE_CHARS:
            self.seen, self.held = {}, 0
        new = list(set(words).difference(self.seen))
        if not new:
            return
        self.held += sum(map(len, new))
        # the byte 255 is in no text's encoding and parts the pre-tokens
        texts = _mapped(_APART.join(new).encode("utf-8", "surrogateescape")).split(_mapped(b"\xff"))
        # a token stands for itself, even where no series of merges makes it
        found = list(map(self.whole.get, texts))
        rest = [t for t, ids in zip(texts, found) if ids is None]
        encoded = self.model.encode(rest, out_type=int, num_threads=1) if rest else []
        flat = np.fromiter(chain.from_iterable(encoded), dtype=np.int32).tobytes()
        ends = list(accumulate(map(len, encoded)))
        cuts = iter([flat[4 * a : 4 * z] for a, z in zip([0, *ends], ends)])
        self.seen.update((w, next(cuts) if ids is None else ids) for w, ids in zip(new, found))

    def _groups(self, texts: Iterable[str]) -> Iterator[list[list[str] | None]]:
        """Pre-tokens of the texts' parts, in groups of ``PART`` characters;
        None stands where a text ends."""
        group, chars = [], 0
        for text in texts:
            for part in parts(text):
                group.append(self.pre_tokens(part))
                chars += len(part) + 1
                if chars >= PART:
                    yield group
                    group, chars = [], 0
            group.append(None)
        yield group

    def encode_all(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order. Reads ahead by a group of texts."""
        out = []
        for group in self._groups(texts):
            self._learn(chain.from_iterable(words for words in group if words))
            for words in group:
                if words is None:
                    yield np.frombuffer(out[0] if len(out) == 1 else b"".join(out), dtype=np.int32)
                    out = []
                else:
                    out.append(b"".join(map(self.seen.__getitem__, words)))

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all([text]))

    def decode_all(self, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
        """The bytes of each list of ids; list r has ids[starts[r]:starts[r + 1]]."""
        if ids.size and int(ids.min()) < 0:
            raise ValueError(f"{int(ids.min())} is no id of the vocabulary")
        found = self.pieces.take(pa.array(ids))
        _, ends, data = found.buffers()
        ends = np.frombuffer(ends, np.int32)[found.offset :][starts] if ids.size else np.zeros(starts.size, np.int32)
        return pa.Array.from_buffers(pa.binary(), starts.size - 1, [None, pa.py_buffer(ends), data])

    def decode(self, ids: np.ndarray) -> bytes:
        return self.decode_all(ids, np.array([0, ids.size]))[0].as_py()


def parts(text: str) -> Iterator[str]:
    """Cut a text where no pre-token can cross: behind a character and before
    white space. A text without such places stays whole."""
    at = 0
    while len(text) - at > PART:
        cut = _CUT.search(text, at + PART)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


#: one codec per worker process, for the vocabulary it used last
_codec: list[tuple[bytes, Codec]] = []


def _codec_of(vocab: Vocabulary) -> Codec:
    if not _codec or _codec[0][0] != vocab.model:
        _codec[:] = [(vocab.model, Codec(vocab))]
    return _codec[0][1]


def _flush(docs: list, keys: list[np.ndarray], codec: Codec | None) -> pa.RecordBatch:
    starts = np.concatenate([[0], np.cumsum([k.size for k in keys])]).astype(np.int32)
    ids = np.concatenate(keys)
    columns = {"doc_id": pa.array(docs, pa.int64()), "ids": pa.ListArray.from_arrays(pa.array(starts), pa.array(ids))}
    if codec is not None:
        columns["decoded"] = codec.decode_all(ids, starts)
    return pa.RecordBatch.from_pydict(columns)


def _encoder(held, back: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        codec = _codec_of(held.value)
        docs = deque()

        def texts():
            for batch in batches:
                for doc, text in zip(batch.column("doc_id"), batch.column("text")):
                    docs.append(doc.as_py())
                    yield text.as_py() or ""

        keys, n = [], 0
        for key in codec.encode_all(texts()):
            keys.append(key)
            n += key.size + 1
            if n >= BATCH_IDS:
                yield _flush([docs.popleft() for _ in keys], keys, codec if back else None)
                keys, n = [], 0
        if keys:
            yield _flush([docs.popleft() for _ in keys], keys, codec if back else None)

    return run


def _share(df: DataFrame, vocab: Vocabulary):
    return df.sparkSession.sparkContext.broadcast(vocab)


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """``doc_id, ids``: the token ids of every whole ``text``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_encoder(_share(docs, vocab), False), "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """``doc_id, ids, decoded``: ``encode``, and the bytes that the ids
    decode to, in one pass over the texts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_encoder(_share(docs, vocab), True), "doc_id long, ids array<int>, decoded binary")


def decode(encoded: DataFrame, vocab: Vocabulary) -> DataFrame:
    """``doc_id, decoded`` from ``doc_id, ids``."""
    held = _share(encoded, vocab)

    def run(batches):
        codec = _codec_of(held.value)
        for batch in batches:
            data = (codec.decode(np.array(x.as_py() or (), dtype=np.int64)) for x in batch.column("ids"))
            for doc, out in zip(batch.column("doc_id"), data):
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array([doc.as_py()], pa.int64()), "decoded": pa.array([out], pa.binary())})

    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, decoded binary")
