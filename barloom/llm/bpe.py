"""Byte-level BPE through a sentencepiece model made straight from a rank file.

Every byte is written as one printable character, so that a piece of bytes is a
piece of characters; a piece's score is its negative rank, so that sentencepiece
merges the pair of lowest rank first, from the left, as the ranks ask. Pre-tokens
are encoded one by one. Decoding maps pieces back to their bytes.
"""

from __future__ import annotations

import base64
import hashlib
from dataclasses import dataclass

import numpy as np
import regex
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as proto

from barloom.llm import frames

#: Pre-tokens remembered by a task.
REMEMBERED = 200_000


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it prints, else one from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in prints]
    return [chr(b) if b in prints else chr(0x100 + rest.index(b)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The vocabulary of a rank file (base64 token, rank), by rank without gaps."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranks[i] for i in range(len(ranks))]


def model_proto(vocabulary: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece ``i`` is token ``i``; the unknown piece comes last."""
    characters = byte_characters()
    model = proto.ModelProto()
    for rank, token in enumerate(vocabulary):
        model.pieces.add(piece="".join(characters[b] for b in token), score=-float(rank))
    model.pieces.add(piece="<unk>", score=0.0, type=proto.ModelProto.SentencePiece.UNKNOWN)
    spec = model.trainer_spec
    spec.model_type, spec.vocab_size = proto.TrainerSpec.BPE, len(model.pieces)
    spec.unk_id, spec.bos_id, spec.eos_id, spec.pad_id = len(vocabulary), -1, -1, -1
    normal = model.normalizer_spec
    normal.name = "identity"
    normal.add_dummy_prefix = normal.remove_extra_whitespaces = normal.escape_whitespaces = False
    return model.SerializeToString()


def splitter(pattern: str):
    """The compiled pattern, with white space as Unicode defines it."""
    return regex.compile(pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\p{White_Space}\p{L}\p{N}]").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


class Codec:
    """Encodes texts to packed little-endian 32-bit ids, and back to bytes."""

    def __init__(self, model: bytes, pattern: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        characters = byte_characters()
        self.to_characters = dict(enumerate(characters))
        to_byte = {c: b for b, c in enumerate(characters)}
        n = self.processor.get_piece_size() - 1  # all but the unknown piece
        self.pieces = [bytes(to_byte[c] for c in self.processor.id_to_piece(i)) for i in range(n)]
        self.split = splitter(pattern).findall
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        tokens = [self.split(text) for text in texts]
        known = self.known
        new = list({t for own in tokens for t in own if t not in known})
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list({t for own in tokens for t in own})
        mapped = [t.encode().decode("latin-1").translate(self.to_characters) for t in new]
        for token, ids in zip(new, self.processor.encode(mapped, num_threads=1)):
            known[token] = np.array(ids, "<u4").tobytes()
        return [b"".join(map(known.__getitem__, own)) for own in tokens]

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@dataclass(frozen=True)
class Vocabulary:
    """The place of a rank file, on every machine or added with ``SparkContext.addFile``, and the split pattern."""

    path: str
    pattern: str


def _codec_of(df: DataFrame, vocabulary: Vocabulary):
    """``start`` of a codec: the model (about 1 MB) is made once here and sent to the tasks."""
    model = df.sparkSession.sparkContext.broadcast(model_proto(read_ranks(vocabulary.path)))
    pattern = vocabulary.pattern
    return lambda: Codec(model.value, pattern)


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``df`` with ``n_tokens``, ``ids`` (packed little-endian unsigned 32-bit) of the whole text.

    A null or empty text has no ids. Columns of these names are replaced, others kept;
    repeated rows are encoded alike; an empty table stays empty. No special tokens.
    """
    codec = _codec_of(df, vocabulary)

    def start():
        own = codec()
        return lambda texts: [(len(ids) // 4, ids) for ids in own.encode([t or "" for t in texts])]

    return frames.extend(df, [frames.col(text)], start, {"n_tokens": "bigint", "ids": "binary"})


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``: the bytes of the packed ids; null or empty ids give no bytes."""
    codec = _codec_of(df, vocabulary)

    def start():
        own = codec()
        return lambda packed: [(own.decode(p or b""),) for p in packed]

    return frames.extend(df, [frames.col(ids)], start, {"decoded": "binary"})


def roundtrip(df: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``encode``, with the text as decoded from the ids, in one pass; null or empty texts become empty."""
    codec = _codec_of(df, vocabulary)

    def start():
        own = codec()

        def work(texts):
            for ids in own.encode([t or "" for t in texts]):
                yield len(ids) // 4, ids, own.decode(ids).decode()

        return work

    return frames.extend(df, [frames.col(text)], start, {"n_tokens": "bigint", "ids": "binary", text: "string"})


def digests(df: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``df`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``, encoded and decoded in one pass."""
    codec = _codec_of(df, vocabulary)

    def start():
        own = codec()

        def work(texts):
            for ids in own.encode([t or "" for t in texts]):
                yield len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest()

        return work

    fields = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    return frames.extend(df, [frames.col(text)], start, fields)
