"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Long texts are cut where the splitting pattern always has a match boundary, so that the pieces' ids, one after the
other, are the whole text's. A match of the pattern is white space alone, or one space and no more of it, or begins with a
letter, number or sign and goes on with its kind. So there is a boundary before a space or line break that follows
anything but white space, in any script; before the last of several that something follows (the pattern leaves that one to
the next match); and, for scripts without spaces, between a letter and a sentence's punctuation. A run of LONG_RUN white spaces or more, less its last one if anything follows, is one match;
it is encoded as such without the pattern, whose engine recurses over runs. Decoding gives raw bytes, so ids that cut a
character are no loss.

Edges, all tested: null and empty texts have no ids; a text of any length is encoded whole; strings that look like
special tokens are ordinary text; repeated rows each return a row; an empty table returns no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator, Mapping
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from .common import keeps, trimmed

#: Characters of a text that are encoded at once, about.
AT_ONCE = 50_000
#: Letters of blocks that are letters throughout, in every version of Unicode that the engines know.
LETTERS = "A-Za-z\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
BOUNDARY = re.compile(rf"(?<=\S)(?=[ \n])|(?<=[ \n])(?=[ \n]\S)|(?<=[{LETTERS}])(?=[,.;:!?\u3001\u3002\uff0c\uff01\uff1f\uff1b\uff1a])")

#: Unicode's white space, as the pattern's engine has it (Python's own class has four control characters more).
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = 10_000
RUNS = re.compile(f"[{WHITE}]{{{LONG_RUN},}}")
#: A pattern that takes a text whole.
WHOLE = r"(?s:.+)"


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


keeps("byte_bpe", encoding.cache_clear)


def pieces(text: str, at_once: int = AT_ONCE) -> Iterator[str]:
    """The text in pieces of about at_once characters, or more where it has no safe boundary."""
    start = 0
    while len(text) - start > at_once:
        cut = BOUNDARY.search(text, start + at_once)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def encode(text: str | None, path: str, pattern: str) -> list[int]:
    coder, text, ids, at = encoding(path, pattern), text or "", [], 0
    for run in RUNS.finditer(text) if len(text) >= LONG_RUN else ():
        end = run.end() - (run.end() < len(text))
        for piece in pieces(text[at : run.start()]):
            ids += coder.encode_ordinary(piece)
        ids += encoding(path, WHOLE).encode_ordinary(text[run.start() : end])
        at = end
    for piece in pieces(text[at:]):
        ids += coder.encode_ordinary(piece)
    return ids


def _round_trip(path: str, pattern: str, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(path, pattern)
        for batch in trimmed(batches, "byte_bpe"):
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows: list[tuple] = []
                for text in part.column(0).to_pylist():
                    ids = encode(text, path, pattern)
                    decoded = coder.decode_bytes(ids)
                    rows.append((len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded).hexdigest(), ids if keep_ids else None, decoded if keep_ids else None))
                kinds = [pa.int64(), pa.string(), pa.string()] + [pa.list_(pa.int32()), pa.binary()] * keep_ids
                columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *columns], names=[*part.schema.names[1:], "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: len(part.columns) - 1 + len(kinds)])

    return run


def round_trip(docs: DataFrame, text: Column, path: str, pattern: str, keep: Mapping[str, Column], keep_ids: bool = False) -> DataFrame:
    """Encode and decode every text: the columns in keep, n_tokens, ids_sha256, decoded_sha256, and with keep_ids the
    ids and the decoded bytes too. A row per input row, no shuffle."""
    rows = docs.select(text.cast("string").alias("__text"), *[c.alias(k) for k, c in keep.items()])
    made = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    made += [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())] * keep_ids
    return rows.mapInArrow(_round_trip(path, pattern, keep_ids), T.StructType([*rows.schema.fields[1:], *made]))
