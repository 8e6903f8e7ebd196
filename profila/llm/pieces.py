"""Operator 12 — SentencePiece encoding and decoding that keeps offsets.

``encode`` works in four steps, each carrying bytes of the text along:

1. *Normalisation.*  At every place the longest key of the model's compiled
   character map (a double array of bytes) is replaced; what no key starts is
   copied.  User-defined pieces go before the map and stay as they are.  For
   every byte of the result the byte of the text it came from is recorded.
2. *White space.*  Runs of spaces collapse where the model says so, spaces
   become ``▁`` and the dummy prefix is put in front; the record follows.
3. *Segmentation* of the normalised text by the library, with a model from
   which the normaliser is taken out.
4. *Projection.*  The bytes of each piece in the normalised text are read off
   the record: piece i stands for the bytes begin[i] to end[i] of the UTF-8
   text (end exclusive).  A byte piece gets its byte.  Of several pieces made
   from one replaced key the last one gets its bytes, the others are empty;
   the dummy prefix has no bytes.

Ids are the library's own, without begin and end ids; ``decode`` is the
library's decoding of a list of ids.  The model is read on the driver, by path
or by Spark, and goes to the tasks with the job (it is refused beyond
``MAX_MODEL`` bytes).

Each text is worked on alone, so no task gathers more than a slice of a batch
(about ``TEXT_BYTES`` of text, or one longer text).  A null or empty text has
no pieces and decodes to an empty text.  Rows are kept as they are: repeated
rows and null ids stay, other columns are kept if asked for by ``keep``.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_bytes, lists_of, prepare, read

MODEL = "piece_bpe_32k.model"
MAX_MODEL = 64 << 20
SPACE = "▁".encode()
_USER_DEFINED, _BYTE = 4, 6


class CharacterMap:
    """The compiled map: 4 bytes with the size of the double array, the array
    of 4-byte units, and the replacements, each ended by a zero byte."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.texts = blob[4 + size:]
        self.first = np.zeros(256, bool)        # bytes that are a key
        self.pair = np.zeros((256, 256), bool)  # pairs of bytes that start a key
        for a in range(256):
            at = self._step(self._start(), a)
            if at is not None:
                self.first[a] = self.units[at] >> 8 & 1
                base = at ^ self._offset(self.units[at])
                for b in range(256):
                    self.pair[a, b] = self._step(base, b) is not None

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit >> 6) & 8)

    def _start(self) -> int:
        return self._offset(self.units[0])

    def _step(self, base: int, byte: int) -> int | None:
        at = base ^ byte
        return at if at < len(self.units) and self.units[at] & 0x800000FF == byte else None

    def longest(self, text: bytes, place: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key at a place."""
        base, found = self._start(), None
        for k in range(place, len(text)):
            at = self._step(base, text[k])
            if at is None:
                break
            base = at ^ self._offset(self.units[at])
            if self.units[at] >> 8 & 1:
                found = k + 1 - place, self.units[base] & 0x7FFFFFFF
        if not found:
            return None
        return found[0], self.texts[found[1]:self.texts.index(b"\0", found[1])]

    def candidates(self, data: np.ndarray) -> np.ndarray:
        """Places where a key may start (all places where one does)."""
        after = np.append(data[1:], 0)
        return np.flatnonzero(self.first[data] | self.pair[data, after])


class Codec:
    """One model: normalisation, segmentation and projection of UTF-8 texts."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto

        self.library = SentencePieceProcessor(model_proto=model)
        spec = proto.ModelProto()
        spec.ParseFromString(model)
        norm, trainer = spec.normalizer_spec, spec.trainer_spec
        self.map = CharacterMap(norm.precompiled_charsmap) if norm.precompiled_charsmap else None
        self.dummy, self.collapse, self.escape = norm.add_dummy_prefix, norm.remove_extra_whitespaces, norm.escape_whitespaces
        self.suffix = trainer.treat_whitespace_as_suffix
        user = sorted((p.piece.encode() for p in spec.pieces if p.type == _USER_DEFINED), key=len, reverse=True)
        self.user = re.compile(b"|".join(map(re.escape, user))) if user else None
        # bytes that a piece takes of the normalised text; unknown ones are measured
        self.bytes_of = np.array([1 if p.type == _BYTE else len(p.piece.encode()) for p in spec.pieces], np.int64)
        self.unknown = None if trainer.byte_fallback else self.library.unk_id()
        norm.precompiled_charsmap = b""
        norm.add_dummy_prefix = norm.remove_extra_whitespaces = norm.escape_whitespaces = False
        self.segmenter = SentencePieceProcessor(model_proto=spec.SerializeToString())

    def replaced(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The text under the character map, and where each byte came from."""
        data = np.frombuffer(text, np.uint8)
        spans = [m.span() for m in self.user.finditer(text)] if self.user else []
        parts, origin, done = [], [], 0

        def copied(a, b):
            parts.append(data[a:b])
            origin.append(np.arange(a, b))

        places = self.map.candidates(data).tolist() if self.map else []
        spans.append((len(text), len(text)))
        kept = iter(spans)
        start, stop = next(kept)
        for place in places:
            while place >= stop and stop < len(text):
                start, stop = next(kept)
            if place < done or start <= place < stop:
                continue
            hit = self.map.longest(text, place)
            if hit and data[place] & 0xC0 != 0x80:  # keys start where characters do
                copied(done, place)
                parts.append(np.frombuffer(hit[1], np.uint8))
                origin.append(np.full(len(hit[1]), place))
                done = place + hit[0]
        copied(done, len(text))
        return np.concatenate(parts), np.concatenate(origin)

    def normalise(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the byte
        of the text that it stands for."""
        if not text:
            return b"", np.zeros(1, np.int64)
        data, origin = (self.replaced(text) if self.map or self.user
                        else (np.frombuffer(text, np.uint8), np.arange(len(text))))
        head, end = 0, len(text)
        if self.collapse:
            space = data == 0x20
            solid = np.flatnonzero(~space)
            if not len(solid):
                return b"", np.zeros(1, np.int64)
            if solid[-1] + 1 < len(data):
                end = int(origin[solid[-1] + 1])
            head = int(origin[solid[0]])
            keep = ~space
            keep[1:] |= ~space[:-1]
            keep[:solid[0]] = keep[solid[-1] + 1:] = False
            data, origin = data[keep], origin[keep]
        mark = SPACE if self.escape else b" "
        if self.escape:
            times = np.where(data == 0x20, len(SPACE), 1)
            out, origin = data.tobytes().replace(b" ", SPACE), np.repeat(origin, times)
        else:
            out = data.tobytes()
        if self.dummy and not self.suffix:
            out, origin = mark + out, np.concatenate([np.full(len(mark), head), origin])
        if self.dummy and self.suffix:
            out, origin = out + mark, np.concatenate([origin, np.full(len(mark), end)])
        return out, np.append(origin, end)

    def encode(self, texts: list[bytes]) -> tuple[list, list, list]:
        """ids, begins and ends of each text's pieces."""
        normal = [self.normalise(t) for t in texts]
        whole = [n.decode() for n, _ in normal]
        found = [np.array(x, np.int32) for x in self.segmenter.encode(whole, out_type=int, num_threads=1)]
        begins, ends = [], []
        for text, ids, (_, origin) in zip(whole, found, normal):
            takes = self.bytes_of[ids]
            if self.unknown is not None and (ids == self.unknown).any():
                takes = [len(p.encode()) for p in self.segmenter.encode(text, out_type=str)]
            edges = origin[np.append(0, np.cumsum(takes, dtype=np.int64))]
            begins.append(edges[:-1])
            ends.append(edges[1:])
        return found, begins, ends

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1)


@lru_cache(maxsize=4)
def codec(model: bytes) -> Codec:
    """The model's codec, kept by a Python worker for its later tasks."""
    return Codec(model)


def model_bytes(spark: SparkSession, path: str) -> bytes:
    """A model file by a path that Spark can read."""
    row = spark.read.format("binaryFile").load(path).select("content", "length").first()
    if row["length"] > MAX_MODEL:
        raise ValueError(f"{path}: models beyond {MAX_MODEL} bytes are not sent to every task")
    return bytes(row["content"])


def public_model(name: str = MODEL) -> str:
    """Path of an installed public tokenizer's file."""
    import public_tokenizers
    return "file://" + public_tokenizers.path(name)


def encode(docs: DataFrame, model: str | None = None, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """The columns ``keep``, the arrays ids, begins and ends over the pieces, and
    covered, the bytes of the text that the pieces stand for."""
    spark = docs.sparkSession
    prepare(spark)
    blob = model_bytes(spark, model or public_model())
    fields = [docs.schema[c] for c in keep]
    rows = docs.select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)),
                       F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))

    def run(batches):
        own = codec(blob)
        for batch in batches:
            for part in by_bytes(batch, "text"):
                found = own.encode(part.column("text").to_pylist())
                covered = pa.array([int((e - b).sum()) for b, e in zip(*found[1:])], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *map(lists_of, found), covered],
                                                 [*part.schema.names[:-1], "ids", "begins", "ends", "covered"])

    kinds = ", ".join(f"k{i} {f.dataType.simpleString()}" for i, f in enumerate(fields))
    out = rows.mapInArrow(run, ", ".join(filter(None, [kinds, "ids array<int>, begins array<int>, ends array<int>, covered long"])))
    return out.select(*(F.col(f"k{i}").alias(f.name) for i, f in enumerate(fields)), "ids", "begins", "ends", "covered")


def decode(tokens: DataFrame, model: str | None = None, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns and the text that the ids decode to (null ids: empty)."""
    from pyspark.sql.types import StringType, StructField, StructType

    spark = tokens.sparkSession
    prepare(spark)
    blob = model_bytes(spark, model or public_model())

    def run(batches):
        own = codec(blob)
        for batch in batches:
            column = batch.column(ids)
            flat = column.flatten().to_numpy(zero_copy_only=False).tolist()
            ends = np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)).tolist()
            texts = own.decode([flat[a:b] for a, b in zip([0, *ends], ends)]) if ends else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    return tokens.mapInArrow(run, StructType([*tokens.schema.fields, StructField(out, StringType())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: digests of every document's ids and decoded text."""
    found = decode(encode(read(spark, sf_dir, "documents")).select("doc_id", "ids", "covered"))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "covered")
