"""Hierarchical multi-length packing of documents into training sequences.

A document's ids end with one separator. Its whole windows of the longest tier are sequences of their own; the tail is
routed to the shortest tier that holds it. Tiers are packed from the longest to the shortest: the longest tail left opens
a window, and the window's gap takes the longest tails, of this or a shorter tier, that fit it. Gaps that no whole tail
fits are filled exactly by the contents of the tier's emptiest windows, cut where the gaps end, and what is left of all
tiers, less than one window of each, is cut at powers of two. So every sequence has just the size of its context: a tier,
or a smaller power of two, and nothing is padded. Sequences are dealt to step groups, the largest first and each to the
group with the fewest tokens, so that training steps cost the same.

Documents are packed in groups of about GROUP_TOKENS tokens where they are read: no shuffle, and a task holds the ids of
one group, or of one document that is larger. A lost task packs the same again. Ids are those of the tokenizer's file; the
tiktoken library makes them from that file's vocabulary, which gives the ids of the tokenizers library (tests compare) in
about a quarter of its time.

Edges, all tested: null and empty texts are the separator alone; strings that look like special tokens are ordinary text;
a text of any length is encoded whole and may fill many sequences; repeated rows and rows without an id are packed one by
one; an empty table returns no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from .bpe import LONG_RUN, RUNS, WHOLE, pieces
from .common import keeps, trimmed

#: Context sizes, longest first; each divides the one before it.
TIERS = (1024, 512, 256)
GROUP_TOKENS = 1 << 20
STEP_TOKENS = 1 << 16
SEPARATOR = 0
IDS = np.dtype("<u4")

Piece = tuple[int, int, int]  # which document, from which of its ids, how many


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes as: printable ones as themselves, the others from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=4)
def encodings(path: str, pattern: str) -> tuple[tiktoken.Encoding, tiktoken.Encoding]:
    """The vocabulary of a tokenizer's file, with the splitting pattern and for texts taken whole."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    alphabet = byte_alphabet()
    ranks = {bytes(alphabet[c] for c in token): rank for token, rank in model["vocab"].items() if all(c in alphabet for c in token)}
    return tuple(tiktoken.Encoding("packing", pat_str=p, mergeable_ranks=ranks, special_tokens={}) for p in (pattern, WHOLE))


keeps("packing", encodings.cache_clear)


def encode(text: str | None, path: str, pattern: str) -> np.ndarray:
    """The ids of a text and the separator."""
    split, whole = encodings(path, pattern)
    text, found, at = text or "", [], 0
    for run in RUNS.finditer(text) if len(text) >= LONG_RUN else ():
        end = run.end() - (run.end() < len(text))
        found += [split.encode_to_numpy(p, disallowed_special=()) for p in pieces(text[at : run.start()])]
        found.append(whole.encode_to_numpy(text[run.start() : end], disallowed_special=()))
        at = end
    found += [split.encode_to_numpy(p, disallowed_special=()) for p in pieces(text[at:])]
    return np.concatenate([*found, [SEPARATOR]]).astype(IDS)


def cut_into(sizes: Sequence[int], content: Sequence[Piece]) -> list[list[Piece]]:
    """Content cut, in order, to parts of the sizes, and a last one with what is left."""
    parts: list[list[Piece]] = []
    left = list(reversed(content))
    for size in sizes:
        part: list[Piece] = []
        while size:
            doc, start, length = left.pop()
            took = min(size, length)
            part.append((doc, start, took))
            if took < length:
                left.append((doc, start + took, length - took))
            size -= took
        parts.append(part)
    return [*parts, left[::-1]]


def pack_group(lengths: Sequence[int], tiers: Sequence[int] = TIERS) -> list[list[Piece]]:
    """Sequences of pieces that hold all the documents' ids; each has the size of a tier, or of a smaller power of two."""
    top = tiers[0]
    sequences = [[(doc, start, top)] for doc, length in enumerate(lengths) for start in range(0, length - top + 1, top)]
    tails: list[list[Piece]] = [[] for _ in range(top)]
    held = 0  # bit n is set where there is a tail of length n
    for doc, length in enumerate(lengths):
        if tail := length % top:
            tails[tail].append((doc, length - tail, tail))
            held |= 1 << tail

    def longest(most: int) -> Piece | None:
        nonlocal held
        n = (held & ((1 << (most + 1)) - 1)).bit_length() - 1
        if n < 1:
            return None
        piece = tails[n].pop()
        if not tails[n]:
            held &= ~(1 << n)
        return piece

    rest: list[Piece] = []
    for i, size in enumerate(tiers):
        least = tiers[i + 1] if i + 1 < len(tiers) else 0
        windows: list[tuple[int, list[Piece]]] = []
        while held.bit_length() - 1 > least:
            window, gap = [], size
            while gap and (piece := longest(gap)):
                window.append(piece)
                gap -= piece[2]
            windows.append((size - gap, window))
        sequences += [window for used, window in windows if used == size]
        part = sorted((w for w in windows if w[0] < size), key=lambda w: -w[0])
        kept = sum(used for used, _ in part) // size
        filled = cut_into([size - used for used, _ in part[:kept]], [piece for _, window in part[kept:] for piece in window])
        sequences += [window + more for (_, window), more in zip(part, filled[:-1])]
        rest += filled[-1]
    left, sizes = sum(piece[2] for piece in rest), []
    while left:
        sizes.append(min(top, 1 << (left.bit_length() - 1)))
        left -= sizes[-1]
    return sequences + cut_into(sizes, rest)[:-1]


def step_groups(sizes: Sequence[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A step group for each sequence, so that the groups have about the same number of tokens."""
    loads = [(0, group) for group in range(-(-sum(sizes) // step_tokens))]
    found = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        load, group = heapq.heappop(loads)
        found[i] = group
        heapq.heappush(loads, (load + sizes[i], group))
    return found


OUTPUT = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier long, step_group long"


def _pack(path: str, pattern: str, tiers: tuple[int, ...], group_tokens: int, step_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        group: list[tuple[object, np.ndarray]] = []
        tokens = sequence = step = 0

        def packed() -> pa.RecordBatch:
            nonlocal sequence, step
            found = pack_group([len(ids) for _, ids in group], tiers)
            sizes = [sum(p[2] for p in s) for s in found]
            steps = step_groups(sizes, step_tokens)
            rows = []
            for n, (pieces_, size, to) in enumerate(zip(found, sizes, steps)):
                offset = 0
                for doc, start, length in pieces_:
                    ids = group[doc][1]
                    rows.append((group[doc][0], start, length, ids[start : start + length].tobytes(), len(ids), base + sequence + n, offset, size, base + step + to))
                    offset += length
            sequence += len(found)
            step += max(steps, default=-1) + 1
            kinds = [kind, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 5]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        for batch in trimmed(batches, "packing"):
            kind, names = batch.schema.field(1).type, [batch.schema.field(1).name, *[c.split()[0] for c in OUTPUT.split(", ")]]
            for i in range(batch.num_rows):
                ids = encode(batch.column(0)[i].as_py(), path, pattern)
                group.append((batch.column(1)[i].as_py(), ids))
                tokens += len(ids)
                if tokens >= group_tokens:
                    yield packed()
                    group, tokens = [], 0
        if group:
            yield packed()

    return run


def pack(docs: DataFrame, doc_id: Column, text: Column, path: str, pattern: str, tiers: tuple[int, ...] = TIERS, group_tokens: int = GROUP_TOKENS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """A row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset, tier
    (the sequence's size) and step_group. path: a byte-level tokenizer's JSON file. The longest tier is a power of two."""
    if any(a % b for a, b in zip(tiers, tiers[1:])) or tiers[0] & (tiers[0] - 1):
        raise ValueError(f"each tier divides the one before it, the first is a power of two: {tiers}")
    rows = docs.select(text.cast("string").alias("__text"), doc_id.alias("doc_id"))
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL(OUTPUT).fields])
    return rows.mapInArrow(_pack(path, pattern, tuple(tiers), group_tokens, step_tokens), schema)
