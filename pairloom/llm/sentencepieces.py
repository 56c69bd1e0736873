"""SentencePiece encoding that keeps each piece's place in the original bytes, and decoding.

Normalisation walks the text with the model's compiled character map: a double-array trie gives the longest prefix with a replacement,
and every normalised byte records the source byte it came from.  A model without a map copies characters; then only
spaces change, and places follow from piece lengths alone.

The ids are those of the sentencepiece library; the pieces, laid end to end, are the normalised text, so the recorded sources of their ends
project each of them to its span in the original.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from .common import small_batches

MARK = "▁"


class Normalizer:
    """A model's character map with source alignment."""

    def __init__(self, spec: sentencepiece_model_pb2.NormalizerSpec) -> None:
        blob = spec.precompiled_charsmap
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.trie = np.frombuffer(blob[4 : 4 + size], dtype="<u4").tolist()
        self.text = blob[4 + size :]
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.plain = not self.trie and not self.squeeze and self.prefix and self.escape

    def longest(self, data: bytes, at: int) -> tuple[bytes, int]:
        """The replacement of the longest known prefix at a place, and that prefix's length; else one character as it is."""
        best, size, node = None, 0, 0
        if self.trie:
            unit = self.trie[0]
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            for k in range(at, len(data)):
                node ^= data[k]
                if node >= len(self.trie):
                    break
                unit = self.trie[node]
                if unit & 0x800000FF != data[k]:
                    break
                node ^= (unit >> 10) << ((unit & 0x200) >> 6)
                if unit >> 8 & 1:
                    best, size = self.trie[node] & 0x7FFFFFFF, k + 1 - at
        if best is not None:
            return self.text[best : self.text.index(b"\0", best)], size
        first = data[at]
        size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return data[at : at + size], size

    def normalize(self, text: str) -> tuple[bytes, list[int]]:
        """Normalised bytes, and for each of them, and the end, the place of its source byte."""
        data = text.encode("utf-8", "replace")
        mark = MARK.encode() if self.escape else b" "
        out, source, at = bytearray(), [], 0
        if self.squeeze:
            while at < len(data):
                new, size = self.longest(data, at)
                if new != b" ":
                    break
                at += size
        if at >= len(data):
            return b"", [at]
        if self.prefix:
            out += mark
            source += [at] * len(mark)
        space = self.squeeze
        while at < len(data):
            new, size = self.longest(data, at)
            if self.squeeze:
                while space and new.startswith(b" "):
                    new = new[1:]
            if new:
                for k in range(len(new)):
                    piece = mark if new[k : k + 1] == b" " else new[k : k + 1]
                    out += piece
                    source += [at] * len(piece)
                space = self.squeeze and new.endswith(b" ")
            at += size
        if self.squeeze:
            while out.endswith(mark):
                del out[-len(mark) :]
                at = source[len(out)]
                del source[len(out) :]
        return bytes(out), [*source, at]


class Encoder:
    """Encodes texts to ids with byte spans; made once in each worker."""

    def __init__(self, model: bytes) -> None:
        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        if not proto.trainer_spec.byte_fallback:
            raise ValueError("needs a model with byte fallback: the length of an unknown piece can't be told from its id")
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.normalizer = Normalizer(proto.normalizer_spec)
        #: Bytes of each piece in normalised text; a byte piece is one.
        self.size = np.array([1 if p.type == 6 else len(p.piece.encode()) for p in proto.pieces], dtype=np.int32)
        #: Bytes of each piece where a mark stands for one source byte.
        self.plain_size = self.size - np.array([2 * p.piece.count(MARK) for p in proto.pieces], dtype=np.int32)
        self.decimal = np.array([b"%d," % i for i in range(len(proto.pieces))])

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text: ids, and start and end bytes of the pieces in the original."""
        for text, ids in zip(texts, self.processor.encode(texts, return_type="numpy", num_threads=1), strict=True):
            if self.normalizer.plain and MARK not in text:  # the map is the identity but for the first mark, which stands for no byte
                bound = np.cumsum(np.concatenate(([-1], self.plain_size[ids])), dtype=np.int32)
                np.maximum(bound, 0, out=bound)
                yield ids, bound[:-1], bound[1:]
            else:
                place = np.array(self.normalizer.normalize(text)[1], dtype=np.int32)
                bound = place[np.cumsum(np.concatenate(([0], self.size[ids])))]
                yield ids, bound[:-1], bound[1:]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.processor.decode(ids) if ids else []


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values) if values else np.array([], dtype=np.int32)))


def full(encoder: Encoder, texts: list[str]) -> dict[str, pa.Array]:
    got = list(encoder.encode(texts))
    return {"ids": _lists([g[0] for g in got]), "starts": _lists([g[1] for g in got]), "ends": _lists([g[2] for g in got]), "decoded": pa.array(encoder.decode([g[0] for g in got]), pa.string())}


def digest(encoder: Encoder, texts: list[str]) -> dict[str, pa.Array]:
    """What the query returns of the same results, without moving the arrays out of the worker."""
    got = list(encoder.encode(texts))
    decimal = [encoder.decimal[ids].tobytes().replace(b"\0", b"")[:-1] for ids, _, _ in got]
    out = {
        "ids_sha256": decimal,
        "spans_sha256": [start.astype("<i4").tobytes() + end.astype("<i4").tobytes() for _, start, end in got],
        "decoded_sha256": [t.encode() for t in encoder.decode([ids for ids, _, _ in got])],
    }
    return {"n_tokens": pa.array([len(ids) for ids, _, _ in got], pa.int64())} | {k: pa.array([hashlib.sha256(x).hexdigest() for x in v]) for k, v in out.items()}


FULL = "ids array<int>, starts array<int>, ends array<int>, decoded string"
DIGEST = "n_tokens long, ids_sha256 string, spans_sha256 string, decoded_sha256 string"


def encode(df: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", results: Callable[[Encoder, list[str]], dict[str, pa.Array]] = full, schema: str = FULL) -> DataFrame:
    """The id column and the results for each row: ids, byte spans [start, end) in the UTF-8 text, decoded text.

    model: the model file's bytes (a fixed size; broadcast).  Null and empty texts have no pieces and decode to an empty text.
    Texts are encoded whole; rows and null ids stay; other columns take no part.
    """
    small_batches(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(sent.value)
        for b in batches:
            texts = b.column(1).to_pylist()
            for at in range(0, len(b), 64):
                got = results(encoder, [t or "" for t in texts[at : at + 64]])
                part = b.column(0).slice(at, 64)
                yield pa.RecordBatch.from_arrays([part, *(got[n] for n in names)], ["id", *names])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, {schema}").withColumnRenamed("id", id_col)
