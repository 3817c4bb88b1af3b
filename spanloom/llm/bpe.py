"""Byte-level BPE through a sentencepiece model that is written from the vocabulary.

The vocabulary lists byte strings by rank. Each becomes a piece of printable characters,
one for each byte, scored by its negative rank; with identity normalisation, sentencepiece
then merges as byte-level BPE does: always the pair whose union has the lowest rank.
Texts are split into pre-tokens, each pre-token is encoded for itself, and ids are decoded
by mapping pieces back to bytes. Nothing is trained.

Defined results: a null text has null ids and a null decoded text; an empty one an empty
list and ''. Encoding then decoding gives every text back exactly. Strings that look
like special tokens are ordinary text. Decoding a null list gives null; an id outside
the vocabulary, or a null one, raises; bytes that aren't UTF-8 decode to U+FFFD. Rows
with null or repeated keys are encoded each for itself, and other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from . import textkit as tk
from .tables import key_type, map_arrow, table, two_columns

#: Folder of the public vocabulary files, and the file that is used.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens whose ids a worker remembers; it forgets all of them when there are more.
REMEMBERED = 150_000


def read_ranks(path: str = VOCABULARY) -> list[bytes]:
    """The vocabulary's byte strings in order of rank."""
    lines = [x.split() for x in Path(path).read_bytes().splitlines() if x.strip()]
    ranks = {int(rank): base64.b64decode(piece) for piece, rank in lines}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks aren't 0 to {len(ranks) - 1}")
    return [ranks[i] for i in range(len(ranks))]


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is printable, else one from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


def build_model(pieces: list[bytes]) -> bytes:
    """A serialised sentencepiece model: ids are ranks, the id after the last is for unknown."""
    chars = byte_characters()
    if missing := {bytes([b]) for b in range(256)} - set(pieces):
        raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
    model = model_pb2.ModelProto()
    for rank, piece in enumerate(pieces):
        model.pieces.add(piece="".join(chars[b] for b in piece), score=-float(rank), type=model_pb2.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=0.0, type=model_pb2.ModelProto.SentencePiece.UNKNOWN)
    t, n = model.trainer_spec, model.normalizer_spec
    t.model_type, t.vocab_size, t.unk_id, t.bos_id, t.eos_id, t.pad_id = model_pb2.TrainerSpec.BPE, len(pieces) + 1, len(pieces), -1, -1, -1
    n.name, n.add_dummy_prefix, n.remove_extra_whitespaces, n.escape_whitespaces = "identity", False, False, False
    return model.SerializeToString()


class Codec:
    """Encoder and decoder of one worker, made from a serialised model and the vocabulary's bytes."""

    def __init__(self, model: bytes, pieces: list[bytes]):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(PATTERN).findall
        self.table = dict(enumerate(byte_characters()))
        self.pieces, self.known = pieces, {}

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, number of ids of each)."""
        tokens = [self.split(t) if t else () for t in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = list(set(chain.from_iterable(tokens)).difference(self.known))
        mapped = [t.encode("utf-8").decode("latin-1").translate(self.table) for t in new]
        self.known.update(zip(new, map(tuple, self.processor.encode(mapped, num_threads=1))))
        ids = [list(chain.from_iterable(map(self.known.__getitem__, t))) for t in tokens]
        return np.fromiter(chain.from_iterable(ids), np.int32), np.fromiter(map(len, ids), np.int64, len(ids))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")


class Shared:
    """A broadcast model; each worker makes its codec once."""

    def __init__(self, spark: SparkSession, path: str):
        pieces = read_ranks(path)
        self.data = spark.sparkContext.broadcast((build_model(pieces), pieces))

    def codec(self) -> Codec:
        if not hasattr(self.data, "codec"):
            self.data.codec = Codec(*self.data.value)
        return self.data.codec


def _lists(ids: np.ndarray, counts: np.ndarray, null: np.ndarray) -> pa.ListArray:
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), mask=np.append(null, False) if null.any() else None)
    return pa.ListArray.from_arrays(offsets, pa.array(ids))


def encode(docs: DataFrame, path: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, token_ids) of every row."""
    shared = Shared(docs.sparkSession, path)
    schema = T.StructType([T.StructField(id_col, key_type(docs, id_col)), T.StructField("token_ids", T.ArrayType(T.IntegerType()))])

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in tk.chunks(batch, "text"):
            text = part.column("text")
            ids, counts = shared.codec().encode(text.to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("key"), _lists(ids, counts, text.is_null().to_numpy(zero_copy_only=False))], schema.names)

    return map_arrow(two_columns(docs, id_col, text_col), make, schema)


def decode(encoded: DataFrame, path: str = VOCABULARY, ids_col: str = "token_ids", to: str = "text") -> DataFrame:
    """The rows with the text of their ids in a column ``to``, which replaces one of that name."""
    shared = Shared(encoded.sparkSession, path)

    @F.arrow_udf(T.StringType())
    def text(col: pa.Array) -> pa.Array:
        codec = shared.codec()
        if (col.flatten().to_numpy(zero_copy_only=False) < 0).any():
            raise IndexError("an id is below 0")
        return pa.array((x if x is None else codec.decode(x) for x in col.to_pylist()), pa.string())

    return encoded.withColumn(to, text(F.col(f"`{ids_col}`")))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_tokens(table(spark, sf_dir, "documents"))


def with_tokens(docs: DataFrame, path: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, token_ids, decoded) of every row: encoded, and the ids decoded again, in one pass."""
    shared = Shared(docs.sparkSession, path)
    schema = T.StructType([T.StructField(id_col, key_type(docs, id_col)), T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        codec = shared.codec()
        for part in tk.chunks(batch, "text"):
            text = part.column("text")
            null = text.is_null().to_numpy(zero_copy_only=False)
            ids, counts = codec.encode(text.to_pylist())
            ends = np.cumsum(counts)
            flat = ids.tolist()
            back = [None if n else codec.decode(flat[b - c : b]) for n, b, c in zip(null, ends.tolist(), counts.tolist())]
            yield pa.RecordBatch.from_arrays([part.column("key"), _lists(ids, counts, null), pa.array(back, pa.string())], schema.names)

    return map_arrow(two_columns(docs, id_col, text_col), make, schema)
