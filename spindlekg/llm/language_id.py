"""Language identification by segmentation-marginalised unigrams.

Each language holds a probability for every piece of a fixed public vocabulary. A word's likelihood is the sum over
all ways of cutting it into pieces, found by a forward pass over its UTF-8 bytes (single bytes are pieces too, so every
word has one). Piece probabilities are fitted by expectation-maximisation: a forward-backward pass gives the expected
piece counts of each training word, Spark adds them up, and the driver only sees one number per (language, piece).

Edges, all tested: null text and text without a letter give `und` with score 0.0; an empty table gives no rows; repeated
rows each give a row; ties go to the label that sorts first; with no usable label every text gives `und`. Words of any
length are counted and scored whole. Extra columns of the input are not read and not returned.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import groupby
from operator import itemgetter

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hash_share, keeps, materialize, trimmed

UNKNOWN = "und"
#: Words up to this many bytes are summed as they are, words of one length together; longer ones one by one.
SHORT_WORD = 24
#: Training words of up to so many bytes are counted together, those of one length at a time; longer ones one by one, in
#: blocks of so many bytes. The sums are the same.
LONG_WORD, COUNT_BLOCK = 256, 1 << 16
#: Words whose scores a worker holds, and the bytes that these scores take at most, whatever the number of labels.
CACHED_WORDS, CACHED_BYTES = 200_000, 16 << 20
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class LanguageModel:
    """probabilities: a row per piece and one of zeros at the end, a column per label."""

    vocabulary: str
    labels: tuple[str, ...]
    priors: np.ndarray
    probabilities: np.ndarray


class Vocabulary:
    """Pieces by number, in order."""

    def __init__(self, pieces: Iterable[bytes]):
        self.ids = {piece: i for i, piece in enumerate(sorted(pieces))}
        self.longest = max(map(len, self.ids))

    def __len__(self) -> int:
        return len(self.ids)

    @cached_property
    def machine(self) -> ahocorasick.Automaton:
        """Finds every piece in a text of which each character stands for a byte: its size and number."""
        found = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            found.add_word(piece.decode("latin-1"), (len(piece), i))
        found.make_automaton()
        return found


@lru_cache(maxsize=2)
def pieces(path: str) -> Vocabulary:
    """The vocabulary's pieces that can occur in a lower-cased word with a space before it, and every single byte."""
    with open(path, "rb") as file:
        found = [base64.b64decode(line.split()[0]) for line in file if line.strip()]
    kept = {bytes([b]) for b in range(256)}
    for piece in found:
        text = piece.decode("utf-8", "ignore")
        if text == text.lower() and all(c.isalpha() or (i == 0 and c == " ") for i, c in enumerate(text)):
            kept.add(piece)
    return Vocabulary(kept)


def _ids(words: list[bytes], vocabulary: Vocabulary) -> list[list[np.ndarray]]:
    """For words of one length: at [end - 1][k] the words' pieces of k + 1 bytes that end there."""
    none, get, n = len(vocabulary), vocabulary.ids.get, len(words)
    return [[np.fromiter([get(w[j - k - 1 : j], none) for w in words], np.int32, n) for k in range(min(j, vocabulary.longest))] for j in range(1, len(words[0]) + 1)]


def _forward(ids: list[list[np.ndarray]], p: np.ndarray) -> list[np.ndarray]:
    alpha = [np.ones((len(ids[0][0]), p.shape[1]))]
    for j, ending in enumerate(ids, 1):
        alpha.append(sum(alpha[j - k - 1] * p[piece] for k, piece in enumerate(ending)))
    return alpha


def _long_score(word: bytes, p: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """The same sum for one word of any length: only a window of it is held, and is scaled as it goes."""
    span = vocabulary.longest
    held, scale, at = np.zeros((4096 + span, p.shape[1])), np.zeros(p.shape[1]), span
    held[at] = 1.0  # held[at - k] is the sum up to k bytes before
    for _, ending in groupby(vocabulary.machine.iter(word.decode("latin-1")), key=itemgetter(0)):
        sizes, numbers = zip(*[piece for _, piece in ending], strict=True)
        at += 1
        held[at] = (held[at - np.array(sizes)] * p[list(numbers)]).sum(axis=0)
        if at % 8 == 0 or at == len(held) - 1:
            top = held[at].copy()
            held[at - span : at + 1] /= top
            scale += np.log(top)
        if at == len(held) - 1:
            held[: span + 1] = held[at - span :].copy()
            at = span
    return np.log(held[at]) + scale


def word_scores(words: list[bytes], p: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Log-likelihood of each word, summed over all segmentations, by label."""
    out = np.empty((len(words), p.shape[1]))
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        if len(w) <= SHORT_WORD:
            by_length.setdefault(len(w), []).append(i)
        else:
            out[i] = _long_score(w, p, vocabulary)
    for at in by_length.values():
        for start in range(0, len(at), 4096):
            some = at[start : start + 4096]
            out[some] = np.log(_forward(_ids([words[i] for i in some], vocabulary), p)[-1])
    return out


def _long_counts(words: list[bytes], weights: np.ndarray, p: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Expected uses of each piece in words of one length, by forward and backward sums in logarithms."""
    n, m, none = len(words[0]), len(words), len(vocabulary)
    ids, longest = _ids(words, vocabulary), vocabulary.longest
    alpha, beta = np.zeros((n + 1, m)), np.zeros((n + 1, m))
    for j in range(1, n + 1):
        now = sum(p[piece] * np.exp(alpha[j - k - 1] - alpha[j - 1]) for k, piece in enumerate(ids[j - 1]))
        alpha[j] = alpha[j - 1] + np.log(now)
    for i in range(n - 1, -1, -1):
        now = sum(p[ids[i + k][k]] * np.exp(beta[i + k + 1] - beta[i + 1]) for k in range(min(longest, n - i)))
        beta[i] = beta[i + 1] + np.log(now)
    total = np.zeros(none + 1)
    for j in range(1, n + 1):
        for k, piece in enumerate(ids[j - 1]):
            if (some := np.flatnonzero(piece != none)).size:
                share = p[piece[some]] * np.exp(alpha[j - k - 1][some] + beta[j][some] - alpha[n][some]) * weights[some]
                total += np.bincount(piece[some], weights=share, minlength=len(total))
    return total


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def _whole_word_counts(word: bytes, logs: list[float], vocabulary: Vocabulary, block: int = COUNT_BLOCK) -> dict[int, float]:
    """Expected uses of each piece in one word of any length. Forward sums are kept where blocks begin, and made again
    block by block for the backward pass, so only a block's sums are held."""
    text, n, span = word.decode("latin-1"), len(word), vocabulary.longest
    minus = -math.inf

    def forward(start: int, stop: int, before: list[float]) -> list[float]:
        """Sums up to start + 1 .. stop, behind those up to the `span` places before."""
        sums = list(before)
        matches = ((end + 1, piece) for end, piece in vocabulary.machine.iter(text, max(0, start - span + 1), stop) if end >= start)
        for _, ending in groupby(matches, key=itemgetter(0)):
            sums.append(_log_sum([sums[-size] + logs[i] for _, (size, i) in ending]))
        return sums

    starts = list(range(0, n, block))
    marks = [[minus] * (span - 1) + [0.0]]
    for start in starts:
        marks.append(forward(start, min(n, start + block), marks[-1])[-span:])
    whole, after = marks[-1][-1], [0.0] + [minus] * (span - 1)  # sums from n on, and of the places behind
    found: dict[int, float] = {}
    for at, start in reversed(list(enumerate(starts))):
        stop = min(n, start + block)
        sums = forward(start, stop, marks[at])[span - 1 :]  # up to start, start + 1, ...
        begin: list[list[tuple[int, int]]] = [[] for _ in range(stop - start)]
        for end, (size, i) in vocabulary.machine.iter(text, start, min(n, stop + span)):
            if end + 1 - size < stop:
                begin[end + 1 - size - start].append((size, i))
        back = [minus] * (stop - start) + after
        for i in range(stop - start - 1, -1, -1):
            steps = [(piece, logs[piece] + back[i + size]) for size, piece in begin[i]]
            back[i] = _log_sum([x for _, x in steps])
            for piece, x in steps:
                found[piece] = found.get(piece, 0.0) + math.exp(sums[i] + x - whole)
        after = back[:span]
    return found


def expected_counts(words: list[bytes], weights: np.ndarray, p: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Expected uses of each piece over all segmentations of the weighted words; p: one label's probabilities."""
    total = np.zeros(len(vocabulary) + 1)
    by_length: dict[int, list[tuple[bytes, float]]] = {}
    logs: list[float] = []
    for w, weight in zip(words, weights.tolist(), strict=True):
        if len(w) <= LONG_WORD:
            by_length.setdefault(len(w), []).append((w, weight))
            continue
        logs = logs or [math.log(x) if x > 0 else -math.inf for x in p.tolist()]
        for piece, n in _whole_word_counts(w, logs, vocabulary).items():
            total[piece] += weight * n
    column = p.reshape(-1, 1)
    for n, every in by_length.items():
        for start in range(0, len(every), 4096 if n <= SHORT_WORD else 1024):
            some, share = zip(*every[start : start + (4096 if n <= SHORT_WORD else 1024)], strict=True)
            share = np.array(share)
            if n > SHORT_WORD:
                total += _long_counts(list(some), share, p, vocabulary)
                continue
            ids = _ids(list(some), vocabulary)
            alpha = _forward(ids, column)
            beta = [np.zeros((len(some), 1)) for _ in range(n)] + [np.ones((len(some), 1))]
            share = (share / alpha[n][:, 0]).reshape(-1, 1)
            for j in range(n, 0, -1):
                for k, piece in enumerate(ids[j - 1]):
                    step = column[piece] * beta[j]
                    beta[j - k - 1] = beta[j - k - 1] + step
                    total += np.bincount(piece, weights=(alpha[j - k - 1] * step * share)[:, 0], minlength=len(total))
    total[-1] = 0
    return total


def _words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _training_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in trimmed(batches, "language_id"):
        counts: Counter = Counter()
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts.update((label, w) for w in _words(text or ""))
        rows = [(a, b, n) for (a, b), n in counts.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], names=["label", "word", "n"])


def fit(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", documents_per_label: int = 800, rounds: int = 3, smoothing: float = 0.02) -> LanguageModel:
    """Fit on a bounded sample: about documents_per_label whole documents of each label, chosen by a hash of the id.

    docs should hold training rows only. The sample bounds the fitting alone; prediction reads everything.
    """
    labelled = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(label_col).cast("string").alias("label"))
    found = sorted((r["label"], r["n"]) for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect())
    labels = tuple(x for x, _ in found if x != UNKNOWN)
    sizes = dict(found)
    table = pieces(vocabulary)
    if not labels:
        return LanguageModel(vocabulary, (), np.zeros(0), np.zeros((len(table) + 1, 0)))
    keep = F.lit(False)
    for x in labels:
        keep = keep | ((F.col("label") == x) & (hash_share(F.col("i"), 11) < documents_per_label / sizes[x]))
    words = labelled.where(keep).select("label", "t").mapInArrow(_training_words, "label string, word string, n long")
    words = materialize(words.groupBy("label", "word").agg(F.sum("n").alias("n")))
    usable = len(table)
    p = np.full((usable + 1, len(labels)), 1.0 / usable)
    p[usable] = 0

    for _ in range(rounds):
        current = p

        def count(batches: Iterator[pd.DataFrame], current: np.ndarray = current) -> Iterator[pd.DataFrame]:
            local = pieces(vocabulary)
            total: dict[str, np.ndarray] = {}
            for batch in trimmed(batches, "language_id"):
                for label, some in batch.groupby("label"):
                    if label in labels:
                        add = expected_counts([(" " + w).encode() for w in some["word"]], some["n"].to_numpy(float), current[:, labels.index(label)], local)
                        total[label] = total.get(label, 0) + add
            for label, counts in total.items():
                at = np.flatnonzero(counts[:-1])
                yield pd.DataFrame({"label": label, "piece": at, "n": counts[at]})

        sums = words.mapInPandas(count, "label string, piece long, n double").groupBy("label", "piece").agg(F.sum("n").alias("n"))
        p = np.full((usable + 1, len(labels)), smoothing)
        got = sums.toPandas()
        for at, label in enumerate(labels):
            own = got[got["label"] == label]
            p[own["piece"].to_numpy(np.int64), at] += own["n"].to_numpy()
        p[usable] = 0
        p = p / p.sum(axis=0)
    shares = np.array([sizes[x] for x in labels], float)
    return LanguageModel(vocabulary, labels, np.log(shares / shares.sum()), p)


#: The last model that this Python worker used, and its words' places and scores: workers are used for many tasks.
_worker: tuple[str, dict[str, int], np.ndarray] | None = None


def _cache(name: str, labels: int) -> tuple[dict[str, int], np.ndarray]:
    global _worker
    if _worker is None or _worker[0] != name:
        _worker = (name, {}, np.zeros((min(CACHED_WORDS, CACHED_BYTES // (8 * max(1, labels))) + 1, labels)))
    return _worker[1], _worker[2]


def _free() -> None:
    global _worker
    _worker = None
    pieces.cache_clear()


keeps("language_id", _free)


def _predictor(model: LanguageModel):
    name = hashlib.sha256(model.probabilities.tobytes() + "\0".join((model.vocabulary, *model.labels)).encode()).hexdigest()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(model.vocabulary)
        known, scores = _cache(name, len(model.labels))
        most = len(scores) - 1  # the row behind the last is of words without a letter

        def learn(words: set[str]) -> None:
            new = [w for w in words if w not in known]
            if len(known) + len(new) > most:
                known.clear()
                new = list(words)
            if new:
                good, at = [w for w in new if any(c.isalpha() for c in w)], len(known)
                if good:
                    scores[at : at + len(good)] = word_scores([(" " + w).encode() for w in good], model.probabilities, vocabulary)
                known.update((w, most) for w in new)
                known.update((w, at + i) for i, w in enumerate(good))

        def judge(words: list[str]) -> tuple[str, float]:
            if not words or not model.labels:
                return UNKNOWN, 0.0
            total = model.priors.copy()
            letters = False
            for start in range(0, len(words), most // 2):
                some = words[start : start + most // 2]
                learn(set(some))
                at = np.fromiter(map(known.__getitem__, some), np.int64, len(some))
                letters = letters or bool((at < most).any())
                total = total + scores[at].sum(axis=0)
            if not letters:
                return UNKNOWN, 0.0
            best = int(total.argmax())
            return model.labels[best], 1.0 / sum(math.exp(min(0.0, x)) for x in total - total[best])

        for batch in trimmed(batches, "language_id"):
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                words = [_words(t or "") for t in part.column("__text").to_pylist()]
                if model.labels and len(together := set().union(*words)) < most // 2:
                    learn(together)  # the new words of many texts go through the batched pass together
                found = [judge(w) for w in words]
                rest = [part.column(i) for i, f in enumerate(part.schema) if f.name != "__text"]
                names = [f.name for f in part.schema if f.name != "__text"]
                yield pa.RecordBatch.from_arrays([*rest, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=[*names, "lang_pred", "score"])

    return predict


def predict(docs: DataFrame, model: LanguageModel, text: Column, keep: Mapping[str, Column]) -> DataFrame:
    """A row per input row: the columns named in keep, lang_pred and score (the winner's posterior). No shuffle."""
    rows = docs.select(*[c.alias(k) for k, c in keep.items()], text.alias("__text"))
    kept = [f for f in rows.schema.fields if f.name != "__text"]
    return rows.mapInArrow(_predictor(model), T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
