"""Byte-level BPE by a rank file: encoding with the tokenizers library, decoding by byte table.

The library works on characters, so each byte stands for one character (``byte_characters``);
merges are rebuilt from the ranks. Decoding goes back from characters to bytes. A token may
end inside a character: bytes are put together first and read as UTF-8 last.

A null text is empty: no tokens, no bytes. Other columns are ignored; repeated rows stay.
"""

from __future__ import annotations

import codecs

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lotwise.llm.common import kept, map_arrow
from lotwise.llm.tokens import byte_characters, encoder, slices


def byte_table(path: str, pattern: str) -> list[bytes]:
    """The bytes of each id: the characters of the library's vocabulary turned back."""

    def build():
        byte = {char: b for b, char in byte_characters().items()}
        vocabulary = encoder(path, pattern).tokenizer.get_vocab()
        table = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            table[i] = bytes(byte[c] for c in token)
        return table

    return kept(("byte table", path, pattern), build)


def decode(ids: bytes, table: list[bytes]) -> bytes:
    return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])


def token_texts(ids: bytes, table: list[bytes]) -> list[str]:
    """Text that each token completes; a character split over tokens belongs to its last one."""
    reader = codecs.getincrementaldecoder("utf-8")()
    return [reader.decode(table[i]) for i in np.frombuffer(ids, "<u4").tolist()]


def offsets(ids: bytes, table: list[bytes]) -> list[tuple[int, int]]:
    """Begin and end of each token in characters; tokens of one split character share its place."""
    out, at, open_bytes = [], 0, False
    for i in np.frombuffer(ids, "<u4").tolist():
        starts = sum(b & 0xC0 != 0x80 for b in table[i])
        begin = at - 1 if open_bytes and table[i] and table[i][0] & 0xC0 == 0x80 else at
        at += starts
        out.append((begin, at))
        open_bytes = at > 0
    return out


def encode(docs: DataFrame, path: str, pattern: str, with_offsets: bool = False) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit) and, if asked for, character offsets."""

    def run(batches):
        own = encoder(path, pattern)
        for batch in batches:
            doc_ids = batch.column(0)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in slices(texts):
                ids = own.encode(texts[lo:hi])
                columns = [doc_ids.slice(lo, hi - lo), pa.array(ids, pa.binary())]
                names = ["doc_id", "ids"]
                if with_offsets:
                    table = byte_table(path, pattern)
                    places = [[{"begin": a, "end": b} for a, b in offsets(i, table)] for i in ids]
                    columns.append(pa.array(places, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))))
                    names.append("offsets")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, ids binary" + (", offsets array<struct<begin: int, end: int>>" if with_offsets else "")
    return map_arrow(docs.select("doc_id", "text"), run, schema, remembers=True)


def with_decoded(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Adds ``decoded``, the bytes that the ids stand for."""

    def run(batches):
        table = byte_table(path, pattern)
        for batch in batches:
            ids = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([decode(i, table) for i in ids], pa.binary())],
                ["doc_id", "ids", "decoded"],
            )

    return map_arrow(encoded.select("doc_id", "ids"), run, "doc_id long, ids binary, decoded binary", remembers=True)
