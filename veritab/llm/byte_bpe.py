"""Byte-level BPE encoding and decoding by prefix dynamic programming (operator 9).

Each match of the tokenizer's pattern is encoded on its own: for every byte prefix its unique valid last token is
stored, and the ids are read back from the last prefix.  bpe.EditableEncoding keeps those last tokens of one word for
exact appends and for encoding again near an edit.
"""

from __future__ import annotations

import hashlib
import struct
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from veritab.llm.bpe import PrefixAutomaton, load_ranks
from veritab.llm.frames import held, in_batches, strings_of


class Encoder(dict):
    """Ids of matches as little-endian unsigned 32-bit integers, worked out when a match is first met."""

    def __init__(self, path: str, pattern: str, max_words: int, max_states: int):
        table = load_ranks(path)
        self.automaton = PrefixAutomaton(table, False, max_states)
        self.bytes = table.bytes
        self.matches = regex.compile(pattern).findall
        self.max_words = max_words

    def __missing__(self, match: str) -> bytes:
        ids = self.automaton.encode(match.encode().decode("latin-1"))
        packed = struct.pack(f"<{len(ids)}I", *ids)
        # a match of a megabyte of one kind of character is not worth keeping
        if len(match) <= 64:
            if len(self) >= self.max_words:
                self.clear()
            self[match] = packed
        return packed

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.matches(text)))

    def decode(self, packed: bytes) -> bytes:
        ids = array("I", packed)
        if struct.pack("=I", 1) != struct.pack("<I", 1):
            ids.byteswap()
        return b"".join(map(self.bytes.__getitem__, ids))


def encoder(path: str, pattern: str, max_words: int = 400_000, max_states: int = 250_000) -> Encoder:
    """One per Python worker: what it has compiled serves all its tasks.  It keeps at most so many words and states."""
    return held(f"encoder {path} {pattern} {max_words} {max_states}", lambda: Encoder(path, pattern, max_words, max_states))


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """docs with ids, an array of int.  Null and empty texts give an empty array; a column named ids is replaced."""
    kept = [c for c in docs.columns if c != "ids"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks_path, pattern)
        for batch in batches:
            ids = [memoryview(enc.encode(t)).cast("I").tolist() for t in strings_of(batch.column(text))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))], [*batch.schema.names, "ids"])

    return in_batches(docs.select(*kept), work, docs.select(*kept).schema.add("ids", ArrayType(IntegerType())))


def decode(encoded: DataFrame, ranks_path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """encoded with decoded, the bytes that its ids stand for.  Null gives no bytes; ids without a token are an error."""
    kept = [c for c in encoded.columns if c != "decoded"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks_path, pattern)
        for batch in batches:
            out = [b"".join(map(enc.bytes.__getitem__, x or ())) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "decoded"])

    return in_batches(encoded.select(*kept), work, encoded.select(*kept).schema.add("decoded", "binary"))


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", max_words: int = 400_000, max_states: int = 250_000) -> DataFrame:
    """Per row: key as doc_id, n_tokens, and SHA-256 of the packed ids and of the bytes they decode to.

    Null texts are empty: 0 tokens and the digest of nothing.  Repeated rows give repeated results; an empty table gives no
    rows.  max_words and max_states bound what a worker keeps, not what it encodes.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks_path, pattern, max_words, max_states)
        for batch in batches:
            n, coded, back = [], [], []
            for t in strings_of(batch.column(1)):
                packed = enc.encode(t)
                n.append(len(packed) // 4)
                coded.append(hashlib.sha256(packed).hexdigest())
                back.append(hashlib.sha256(enc.decode(packed)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return in_batches(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), work, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
