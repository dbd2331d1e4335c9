"""Byte-level BPE encoding and decoding with the tiktoken library.

The rank file is local and its path a parameter; every executor reads it
once per Python worker.  A text is encoded whole: long texts are first
cut at places where the pattern can never match across, so each match of
the pattern is still merged separately and the ids are those of the
uncut text.

Defined results: null and empty texts have no ids and decode to empty
bytes; repeated rows are encoded each by itself; an empty table gives an
empty result; other columns of the input pass through untouched, and an
input column that clashes with an output column is replaced.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.bytetext import chunks, lists
from tessera.session import ship_package

#: White space of Unicode, as the pattern's \s has it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE_CHARS = 1 << 16
LONG_RUN = 1 << 12
ROWS = 256  # decoded together

# No match holds white space after its first character unless it is all
# white space, so a place between a visible and a white character is safe.
_SAFE = re.compile(f"[^{SPACE}](?=[{SPACE}])")
_RUN = re.compile(f"[{SPACE}]{{{LONG_RUN},}}")


def split_safely(text: str, size: int = PIECE_CHARS) -> Iterator[tuple[str, bool]]:
    """Pieces of the text and whether each is a single match.

    Very long runs of white space, on which the library's regular
    expression overflows its stack, come as one match: a run before a
    visible character gives up its last character to what follows.
    """
    at = 0
    for run in _RUN.finditer(text) if len(text) >= LONG_RUN else ():
        yield from ((piece, False) for piece in _cut(text[at:run.start()], size))
        at = run.end() if run.end() == len(text) else run.end() - 1
        yield text[run.start():at], True
    yield from ((piece, False) for piece in _cut(text[at:], size))


def _cut(text: str, size: int) -> Iterator[str]:
    at = 0
    while len(text) - at > size and (safe := _SAFE.search(text, at + size)):
        yield text[at:safe.end()]
        at = safe.end()
    if at < len(text):
        yield text[at:]


_CODERS: dict[tuple[str, str], object] = {}


def coder(path: str, pattern: str):
    """The encoding of a rank file, built once per Python process."""
    if (path, pattern) not in _CODERS:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _CODERS[path, pattern] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _CODERS[path, pattern]


def encode_text(text: str, enc) -> list[int]:
    if len(text) < LONG_RUN:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for piece, single in split_safely(text):
        ids += enc._encode_single_piece(piece) if single else enc.encode_ordinary(piece)
    return ids


def _replace(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    new = {f.name.lower() for f in fields}
    return T.StructType([f for f in schema.fields if f.name.lower() not in new] + list(fields))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids",
           decoded: str | None = None) -> DataFrame:
    """Add ``ids`` (array<int>) of each whole text; ``text`` stays.
    ``decoded`` names a further column (binary) for the bytes that the ids
    decode to, made in the same pass."""
    ship_package(docs.sparkSession)
    new = [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)]
    new += [T.StructField(decoded, T.BinaryType(), False)] if decoded else []
    schema = _replace(docs.schema, *new)
    names = schema.names[:-len(new)]

    def run(batches):
        enc = coder(path, pattern)
        for batch in chunks(batches, text):
            rows, raw = [], []
            for t in batch.column(batch.schema.names.index(text)):
                got = encode_text(t.as_py() or "", enc)
                rows.append(np.array(got, np.int32))
                if decoded:
                    raw.append(enc.decode_bytes(got))
            flat = np.concatenate([np.zeros(0, np.int32), *rows])
            columns = [lists(flat, np.cumsum([0, *map(len, rows)]), pa.int32())]
            columns += [pa.array(raw, pa.binary())] if decoded else []
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.names.index(n)) for n in names), *columns], schema.names)

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out`` (binary): the bytes that the ids stand for."""
    ship_package(encoded.sparkSession)
    schema = _replace(encoded.schema, T.StructField(out, T.BinaryType(), False))
    names = schema.names[:-1]

    def run(batches):
        enc = coder(path, pattern)
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            column = batch.column(batch.schema.names.index(ids))
            got = [enc.decode_bytes(row.values.to_numpy().tolist()) if row.is_valid else b"" for row in column]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.names.index(n)) for n in names), pa.array(got, pa.binary())], [*names, out])

    return encoded.mapInArrow(run, schema)


def ids_digest(ids: str = "ids"):
    """Lowercase hex SHA-256 of the decimal ids joined by one space."""
    return F.sha2(F.concat_ws(" ", F.col(ids).cast("array<string>")), 256)
