"""SentencePiece encoding and decoding on the tokenizers library.

The model protobuf is parsed here (no sentencepiece import): pieces with scores and kinds, trainer and normaliser settings.
From it a ``Tokenizer`` is rebuilt: the character map, whitespace squeezing and the dummy prefix of the normaliser, the
metaspace marker, then either unigram scores or merges ranked by score, with byte fallback. Batches of about a hundred
thousand characters go through the library's thread pool, whole texts at a time.

Null texts encode like empty ones: no ids, decoded to the empty string. Control symbols in a text are ordinary text.
Decoding gives the normalised text (equal to the text itself wherever normalisation changes nothing).
"""

from __future__ import annotations

import functools
import hashlib
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.llm.textbytes import lean
from moraine.llm.common import table

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message; fixed-width values stay bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            if b < 128:
                return out
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at : at + size]
        at += size


@dataclass
class Spec:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    suffix: bool = False
    charsmap: bytes = b""
    prefix: bool = True
    squeeze: bool = True
    escape: bool = True


def parse(data: bytes) -> Spec:
    """Field numbers are those of the public sentencepiece_model.proto."""
    spec = Spec()
    for n, value in fields(data):
        if n == 1:
            own = dict(fields(value))
            spec.pieces.append((own.get(1, b"").decode(), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
        elif n == 2:
            own = dict(fields(value))
            spec.kind, spec.byte_fallback, spec.suffix = own.get(3, UNIGRAM), bool(own.get(35, 0)), bool(own.get(24, 0))
        elif n == 3:
            own = dict(fields(value))
            spec.charsmap, spec.prefix, spec.squeeze, spec.escape = own.get(2, b""), bool(own.get(3, 1)), bool(own.get(4, 1)), bool(own.get(5, 1))
    return spec


def merges(spec: Spec) -> list[tuple[str, str]]:
    """Every way to join two pieces into a third, best third first."""
    ids = {p: i for i, (p, _, k) in enumerate(spec.pieces) if k in (NORMAL, USER, UNUSED)}
    found = []
    for piece, score, kind in spec.pieces:
        if kind == NORMAL:
            for cut in range(1, len(piece)):
                if (a := ids.get(piece[:cut])) is not None and (b := ids.get(piece[cut:])) is not None:
                    found.append((-score, a, b, piece[:cut], piece[cut:]))
    found.sort(key=lambda x: x[:3])
    return [x[3:] for x in found]


class Codec:
    """encode() and decode() of batches; ids are those of the model's own piece list."""

    def __init__(self, data: bytes):
        from tokenizers import Regex, Tokenizer, models, normalizers

        self.spec = spec = parse(data)
        if spec.suffix or not spec.escape or spec.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models with escaped, leading white space")
        if any(k == USER for _, _, k in spec.pieces):
            raise ValueError("models with user-defined pieces, which are matched before all others, are not supported")
        unknown = next((i for i, x in enumerate(spec.pieces) if x[2] == UNKNOWN), None)
        if spec.kind == UNIGRAM:  # only normal and user pieces may match a text
            low = min((s for _, s, _ in spec.pieces), default=0.0) - 1e6
            vocab = [(p, s if k in (NORMAL, USER, BYTE, UNKNOWN) else low) for p, s, k in spec.pieces]
            model = models.Unigram(vocab, unknown, spec.byte_fallback)
        else:
            vocab = {p: i for i, (p, _, _) in enumerate(spec.pieces)}
            unk = spec.pieces[unknown][0] if unknown is not None else None
            model = models.BPE(vocab=vocab, merges=merges(spec), unk_token=unk, fuse_unk=True, byte_fallback=spec.byte_fallback)
        self.tokenizer = Tokenizer(model)
        steps = [normalizers.Precompiled(spec.charsmap)] if spec.charsmap else []
        if spec.squeeze:
            steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
        self.normal = normalizers.Sequence(steps) if steps else None
        self.surface = [p.replace(MARK, " ").encode() if k in (NORMAL, USER, UNUSED) else bytes([int(p[3:5], 16)]) if k == BYTE else b"" for p, _, k in spec.pieces]
        if unknown is not None:
            self.surface[unknown] = " \u2047 ".encode()

    def normalised(self, text: str | None) -> str:
        """The text as the model sees it, with spaces for markers and without the dummy prefix."""
        text = (text or "").replace(MARK, " ")
        return self.normal.normalize_str(text) if self.normal else text

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        marked = []
        for text in texts:
            own = self.normalised(text)
            marked.append((" " * (self.spec.prefix and own != "") + own).replace(" ", MARK))
        return [x.ids for x in self.tokenizer.encode_batch_fast(marked, add_special_tokens=False)]

    def decode(self, batch: list[list[int]]) -> list[str]:
        out = []
        for ids in batch:
            text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")
            out.append(text[1:] if self.spec.prefix and text[:1] == " " else text)
        return out


@functools.lru_cache(2)
def codec(data: bytes, threads: int) -> Codec:
    os.environ["RAYON_NUM_THREADS"], os.environ["TOKENIZERS_PARALLELISM"] = str(threads), "true"
    return Codec(data)


def pieces(values: list, weigh, most: int = 1 << 17) -> Iterator[tuple[int, int]]:
    """(from, to) of runs of about ``most`` characters or ids, so that memory does not follow the batch."""
    at = weight = 0
    for i, v in enumerate(values):
        weight += weigh(v)
        if weight >= most:
            yield at, i + 1
            at, weight = i + 1, 0
    if at < len(values):
        yield at, len(values)


def size(value) -> int:
    return len(value or ())


def read_model(path: str) -> bytes:
    """A model file on the driver; its bytes travel to the executors."""
    with open(path, "rb") as f:
        return f.read()


def _mapped(df: DataFrame, schema: str, model: bytes, threads: int, make) -> DataFrame:
    """mapInArrow with make(codec, table) over short runs of rows."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # a model file: its size does not follow the data

    def run(batches):
        own = codec(shared.value, threads)
        for batch in batches:
            yield from make(own, batch)

    return df.mapInArrow(lean(run), schema)


def encode(docs: DataFrame, model: bytes, text: str = "text", into: str = "ids", threads: int = 2) -> DataFrame:
    """docs with an array<int> column of ids; an existing column of that name is replaced."""
    kept = docs.drop(into)
    schema = T.StructType([*kept.schema.fields, T.StructField(into, T.ArrayType(T.IntegerType()))])

    def make(own, batch):
        texts = batch[text].to_pylist()
        for a, b in pieces(texts, size):
            part = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(own.encode(texts[a:b]), pa.list_(pa.int32()))], [*part.schema.names, into])

    return _mapped(kept, schema, model, threads, make)


def decode(docs: DataFrame, model: bytes, ids: str = "ids", into: str = "text", threads: int = 2) -> DataFrame:
    """docs with the decoded text; null ids give the empty text."""
    kept = docs.drop(into) if into != ids else docs
    schema = T.StructType([*kept.schema.fields, T.StructField(into, T.StringType())])

    def make(own, batch):
        rows = batch[ids]
        for a, b in pieces(rows.value_lengths().to_pylist(), lambda n: n or 0):
            part = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(own.decode([x or [] for x in part[ids].to_pylist()]), pa.string())], [*part.schema.names, into])

    return _mapped(kept, schema, model, threads, make)


def audit(docs: DataFrame, model: bytes, doc_id: str = "doc_id", text: str = "text", threads: int = 2) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids as little-endian int32), round_trip, parity with the sentencepiece library, of every document."""
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([kept.schema["doc_id"], *T._parse_datatype_string("n_tokens long, ids_sha256 string, round_trip boolean, parity boolean").fields])

    def make(own, batch):
        import sentencepiece

        other = getattr(own, "other", None)
        if other is None:
            other = own.other = sentencepiece.SentencePieceProcessor(model_proto=shared_bytes.value)
        texts = [t or "" for t in batch["text"].to_pylist()]
        out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "round_trip": [], "parity": []}
        for a, b in pieces(texts, size):
            ids = own.encode(texts[a:b])
            out["n_tokens"] += map(len, ids)
            out["ids_sha256"] += [hashlib.sha256(np.array(x, "<i4").tobytes()).hexdigest() for x in ids]
            out["round_trip"] += [x == own.normalised(t) for x, t in zip(own.decode(ids), texts[a:b], strict=True)]
            out["parity"] += [x == y for x, y in zip(other.encode(texts[a:b], num_threads=1), ids, strict=True)]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(v, k) for v, k in zip(out.values(), (pa.int64(), pa.string(), pa.bool_(), pa.bool_()), strict=True))], schema.names)

    shared_bytes = docs.sparkSession.sparkContext.broadcast(model)
    return _mapped(kept, schema, model, threads, make)


MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"


def query(spark: SparkSession, sf_dir: str, model_path: str = MODEL_PATH) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), read_model(model_path))
