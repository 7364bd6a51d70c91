"""SentencePiece encoding and decoding with the tokenizers library as the engine.

The model file is a protobuf message; the few fields that matter are read straight from its wire
format. From them a tokenizer is rebuilt: the normaliser, the marker that stands for blanks, the
pieces with their scores (a Unigram model, or BPE merges in the order of the scores) and the
fallback to bytes. Before it is used it is held against SentencePiece itself on probe texts.
"""

from __future__ import annotations

import os
import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

MARK = "▁"
THREADS = "2"
# Texts encoded together, in characters.
BATCH_CHARS = 1 << 20
# Words whose ids a worker remembers, and the longest of them in characters.
KEPT_WORDS = 1 << 18
KEPT_CHARS = 64

WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")

# Kinds of pieces and of models in the message.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2

PROBES = (
    "",
    " ",
    "a",
    "Hello world",
    "  two  blanks   three ",
    "tab\tand\nline\r\nend",
    "naïve café Ünïcödé ñandú",
    "日本語 и русский 🙂 \x00\x01",
    "<s> </s> <unk> <0x41> ▁ _",
    "1234567890 3.14 ½ ①",
    "don't stop!!! (really?) [x] {y} #*$%&|<>",
)


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        shift += 7
        if byte < 0x80:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The numbered fields of a protobuf message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            if kind == 2:
                size, at = _varint(data, at)
            elif kind in (1, 5):
                size = 8 if kind == 1 else 4
            else:
                raise ValueError(f"wire type {kind} is not used by model files")
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class Model(NamedTuple):
    pieces: list[tuple[str, float, int]]
    kind: int
    byte_fallback: bool
    charsmap: bytes
    dummy_prefix: bool
    squeeze: bool
    escape: bool


def parse(data: bytes) -> Model:
    pieces, trainer, normalizer = [], {}, {}
    for number, value in fields(data):
        if number == 1:
            piece = dict(fields(value))
            score = struct.unpack("<f", piece.get(2, bytes(4)))[0]
            pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(fields(value))
        elif number == 3:
            normalizer = dict(fields(value))
    return Model(
        pieces,
        trainer.get(3, UNIGRAM),
        bool(trainer.get(35, 0)),
        normalizer.get(2, b""),
        bool(normalizer.get(3, 1)),
        bool(normalizer.get(4, 1)),
        bool(normalizer.get(5, 1)),
    )


def merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Every way to put a piece together from two others, the best-scored piece first."""
    normal = {p for p, _, kind in pieces if kind in (NORMAL, USER_DEFINED)}
    ranked = sorted(
        (-score, i, p) for i, (p, score, kind) in enumerate(pieces) if p in normal and len(p) > 1
    )
    return [
        (p[:cut], p[cut:])
        for _, _, p in ranked
        for cut in range(1, len(p))
        if p[:cut] in normal and p[cut:] in normal
    ]


def parts_at_marks(model: Model) -> bool:
    """Whether no piece goes on behind a marker: a text's ids are then those of its words."""
    return not any(MARK in p.lstrip(MARK) for p, _, kind in model.pieces if kind == NORMAL)


def rebuild(model: Model) -> Tokenizer:
    unknown = next(i for i, (_, _, kind) in enumerate(model.pieces) if kind == UNKNOWN)
    if model.kind == UNIGRAM:
        scored = [(p, s) for p, s, _ in model.pieces]
        tokenizer = Tokenizer(
            models.Unigram(scored, unk_id=unknown, byte_fallback=model.byte_fallback)
        )
    elif model.kind == BPE:
        tokenizer = Tokenizer(
            models.BPE(
                {p: i for i, (p, _, _) in enumerate(model.pieces)},
                merges(model.pieces),
                unk_token=model.pieces[unknown][0],
                fuse_unk=True,
                byte_fallback=model.byte_fallback,
            )
        )
    else:
        raise ValueError(f"models of kind {model.kind} are not rebuilt")
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    blank = MARK if model.escape else " "
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(blank))
    if model.escape:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    if parts_at_marks(model):
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(WORD.pattern), "isolated")
    back = [decoders.Replace(MARK, " ")] if model.escape else []
    if model.byte_fallback:
        back.append(decoders.ByteFallback())
    back.append(decoders.Fuse())
    if model.dummy_prefix:
        back.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(back)
    return tokenizer


class Codec:
    """The rebuilt tokenizer, and the ids of words that a worker met before.

    Where words part at the markers, a batch goes to the tokenizer as its distinct new words;
    what is remembered is bounded and forgotten as a whole.
    """

    def __init__(self, model: Model):
        self.tokenizer = rebuild(model)
        self.plain = model.escape and not (model.charsmap or model.squeeze)
        self.prefix = MARK if model.dummy_prefix else ""
        self.by_word = model.escape and parts_at_marks(model)
        self.words = Tokenizer(self.tokenizer.model)
        self.kept: dict[str, bytes] = {}
        self.blank = " " if model.escape else MARK
        self.strip = model.dummy_prefix
        self.pieces = [
            bytes([int(p[3:5], 16)])
            if kind == BYTE and model.byte_fallback
            else p.replace(MARK, self.blank).encode()
            for p, _, kind in model.pieces
        ]

    def _words(self, text: str) -> list[str]:
        if self.plain and "  " not in text and MARK not in text and text[:1] != " ":
            words = text.replace(" ", f" {MARK}").split(" ")
            words[0] = self.prefix + words[0]
            return words if text else []
        if self.plain:
            return WORD.findall(self.prefix + text.replace(" ", MARK)) if text else []
        return WORD.findall(self.tokenizer.normalizer.normalize_str(text))

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return _ids(self.tokenizer, texts)
        words = [self._words(t) for t in texts]
        wanted = {w for own in words for w in own}
        if len(self.kept) + len(wanted) > KEPT_WORDS:
            self.kept = {}
        known = self.kept
        new = list(wanted.difference(known))
        known.update(zip(new, _ids(self.words, new)))
        out = [b"".join(map(known.__getitem__, own)) for own in words]
        for word in new:
            if len(word) > KEPT_CHARS:
                del known[word]
        return out

    def decode(self, ids: bytes) -> str:
        """The pieces put together; the library mends bytes that are no text."""
        numbers = array("I", ids)
        try:
            text = b"".join(map(self.pieces.__getitem__, numbers)).decode()
        except (IndexError, UnicodeDecodeError):
            return self.tokenizer.decode(numbers.tolist(), skip_special_tokens=False)
        return text[1:] if self.strip and text[:1] == " " else text


def _ids(tokenizer: Tokenizer, texts: list[str]) -> list[bytes]:
    found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    return [array("I", x.ids).tobytes() for x in found]


def verify(path: str, texts: tuple[str, ...] | list[str] = PROBES) -> None:
    """Raise where ids or decoded texts differ from SentencePiece's."""
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=path)
    codec = load(path)
    for text, found in zip(texts, codec.encode(list(texts))):
        ids = array("I", found).tolist()
        expected = own.encode(text)
        if ids != expected:
            raise ValueError(f"ids differ for {text[:60]!r}")
        if codec.decode(found) != own.decode(expected):
            raise ValueError(f"decoded texts differ for {text[:60]!r}")


@lru_cache(maxsize=4)
def load(path: str) -> Codec:
    """The rebuilt tokenizer; one per worker, which keeps it between tasks."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
    os.environ.setdefault("RAYON_NUM_THREADS", THREADS)
    with open(path, "rb") as file:
        return Codec(parse(file.read()))


def _batches(values: list[str]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, value in enumerate(values):
        total += len(value)
        if total >= BATCH_CHARS:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(values):
        yield start, len(values)


def encode(path: str, text: str | Column = "text") -> Column:
    """The ids of a text column as binary: unsigned 32-bit little-endian numbers.

    No begin, end or other token is added, nothing is cut off. A null or empty text has no ids.
    The model file must be at ``path`` on every machine.
    """
    verify(path)

    @F.arrow_udf("binary")
    def ids(column: pa.Array) -> pa.Array:
        codec, out = load(path), []
        texts = [t or "" for t in column.to_pylist()]
        for a, b in _batches(texts):
            out.extend(codec.encode(texts[a:b]))
        return pa.array(out, pa.binary())

    return ids(F.col(text) if isinstance(text, str) else text)


def there_and_back(path: str, text: str | Column = "text") -> Column:
    """A struct of the ``ids`` as ``encode`` gives them and the ``text`` that ``decode`` makes of
    them. As one function: two would encode each text twice."""
    verify(path)

    @F.arrow_udf("ids binary, text string")
    def both(column: pa.Array) -> pa.Array:
        codec, ids, back = load(path), [], []
        texts = [t or "" for t in column.to_pylist()]
        for a, b in _batches(texts):
            found = codec.encode(texts[a:b])
            ids.extend(found)
            back.extend(map(codec.decode, found))
        columns = [pa.array(ids, pa.binary()), pa.array(back, pa.string())]
        return pa.StructArray.from_arrays(columns, names=["ids", "text"])

    return both(F.col(text) if isinstance(text, str) else text)


def decode(path: str, ids: str | Column = "ids") -> Column:
    """The text of ids as ``encode`` gives them; null for null."""

    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        codec = load(path)
        out = [None if v is None else codec.decode(v) for v in column.to_pylist()]
        return pa.array(out, pa.string())

    return text(F.col(ids) if isinstance(ids, str) else ids)
