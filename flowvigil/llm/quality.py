"""Quality classifier: pooled random-indexing word vectors and a two-layer network.

A word's index vector is the sum of sparse ternary vectors drawn by a hash: one for its shape (case,
digits, signs) and one for each letter trigram, so words never seen before have one too. Its context
vector is the sum of the index vectors of its neighbours in the labelled sample, kept per hash bucket.
A document is pooled into the mean of both over all its words, the mean index vector of its different
words, and a few ratios of length and repetition. The network ends in one logit, which is divided by a
temperature fitted on sample rows that other folds have scored.

Executors do all work on texts; the driver gets context sums and pooled vectors of the bounded sample.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from flowvigil.llm.shared import map_batches, remembering, small_batches
from flowvigil.staging import Staging

#: Dimensions of index and context vectors, and non-zero places of a feature's index vector.
WIDTH = 64
PLACES = 4
#: Buckets of context vectors; their number doesn't depend on the corpus.
BUCKETS = 1 << 12
#: Neighbours on each side that make a context.
REACH = 2
#: Labelled rows that the classifier is fitted on at most, and the tasks that read them.
FIT_ROWS = 4000
FIT_TASKS = 8
HIDDEN = 32
EPOCHS = 40
DECAY = 1e-3
#: Folds of the sample that set the temperature.
FOLDS = 3
#: Words whose vectors a worker remembers before it starts afresh.
REMEMBERED = 150_000

CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
LETTERS = re.compile(r"[^\W\d_A]+")
DIGITS = re.compile(r"\d+")


def shape(word: str) -> str:
    """Runs of capitals as A, of other letters as a, of digits as 0; other signs as they are."""
    if word.isalpha():
        if word.islower():
            return "a"
        if word[1:].islower():
            return "Aa"
    return DIGITS.sub("0", LETTERS.sub("a", CAPITALS.sub("A", word)))[:8]


def features(word: str) -> list[str]:
    """Shape of a word, then its letter trigrams."""
    core = word if word.isalpha() else "".join(filter(str.isalpha, word))
    core = "<" + core.lower() + ">"
    return ["=" + shape(word), *[core[i : i + 3] for i in range(len(core) - 2)]]


def sparse_vector(name: str) -> np.ndarray:
    """Random-indexing vector of a feature: a few places, each 1 or -1."""
    h, out = xxh64_intdigest(name), np.zeros(WIDTH, dtype=np.float32)
    for i in range(PLACES):
        out[(h >> (8 * i)) % WIDTH] += 1.0 if h >> (48 + i) & 1 else -1.0
    return out


class WordVectors:
    """Index vectors and context buckets of words, remembered in rows of arrays."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.index = np.zeros((0, WIDTH), dtype=np.float32)
        self.bucket = np.zeros(0, dtype=np.int64)
        self.feature_rows: dict[str, int] = {}
        self.feature_index = np.zeros((0, WIDTH), dtype=np.float32)

    @staticmethod
    def _room(array: np.ndarray, rows: int) -> np.ndarray:
        if rows <= len(array):
            return array
        grown = np.zeros((max(rows, 2 * len(array)), *array.shape[1:]), dtype=array.dtype)
        grown[: len(array)] = array
        return grown

    def _add(self, words: list[str]) -> None:
        known, ids, starts, counts = self.feature_rows, [], [], []
        for word in words:
            names = features(word)
            starts.append(len(ids))
            counts.append(len(names) - 1)
            for name in names:
                at = known.get(name)
                if at is None:
                    at = known[name] = len(known)
                    self.feature_index = self._room(self.feature_index, at + 1)
                    self.feature_index[at] = sparse_vector(name)
                ids.append(at)
        weights = np.repeat(0.5 / np.sqrt(np.maximum(counts, 1)), np.array(counts) + 1).astype(np.float32)
        weights[starts] = 1.0
        made = np.add.reduceat(self.feature_index[ids] * weights[:, None], starts, axis=0)
        at = len(self.rows)
        self.index, self.bucket = self._room(self.index, at + len(words)), self._room(self.bucket, at + len(words))
        self.index[at : at + len(words)] = made
        self.bucket[at : at + len(words)] = [xxh64_intdigest(w.lower()) % BUCKETS for w in words]
        self.rows.update(zip(words, range(at, at + len(words))))

    def __call__(self, words: list[str]) -> np.ndarray:
        """Rows of different words; good until the next call."""
        missing = [w for w in words if w not in self.rows]
        if missing:
            if len(self.rows) + len(missing) > REMEMBERED:
                self.rows.clear()
                missing = words
            if len(self.feature_rows) > REMEMBERED // 4:
                self.feature_rows.clear()
            self._add(missing)
        return np.fromiter(map(self.rows.__getitem__, words), dtype=np.int64, count=len(words))


_VECTORS: list[WordVectors] = []


def word_vectors() -> WordVectors:
    remembering("quality", _VECTORS.clear)
    if not _VECTORS:
        _VECTORS.append(WordVectors())
    return _VECTORS[0]


def context_sums(text: str, sums: np.ndarray) -> None:
    """Add the index vectors of every word's neighbours to the sums of the word's bucket."""
    words, vectors = text.split(), word_vectors()
    distinct = list(dict.fromkeys(words))
    rows = dict(zip(distinct, vectors(distinct)))
    places = np.array([rows[w] for w in words], dtype=np.int64)
    for away in range(1, REACH + 1):
        left, right = places[:-away], places[away:]
        np.add.at(sums, vectors.bucket[left], vectors.index[right])
        np.add.at(sums, vectors.bucket[right], vectors.index[left])


def pooled(text: str, contexts: np.ndarray) -> np.ndarray:
    """Pooled vector of a whole text; of an empty one all zeros."""
    words, vectors = text.split(), word_vectors()
    counted = Counter(words)
    rows = vectors(list(counted))
    n, different = len(words), len(counted)
    if not n:
        return np.zeros(3 * WIDTH + 4, dtype=np.float32)
    share = np.fromiter(counted.values(), dtype=np.float32, count=different) / n
    index = vectors.index[rows]
    lines = text.splitlines()
    ratios = [
        math.log1p(n) / 5,
        different / n,
        sum(map(eq, words, words[1:])) / n,
        len(set(lines)) / max(1, len(lines)),
    ]
    parts = [share @ index, share @ contexts[vectors.bucket[rows]], index.mean(axis=0), np.array(ratios)]
    return np.concatenate(parts).astype(np.float32)


@dataclass
class Network:
    """Standardized inputs, one hidden layer, one logit and its temperature."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x).astype(np.float64) / self.temperature, -40, 40)))


def _fitted(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> Network:
    """Fit by Adam on the log loss."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    w = [
        rng.normal(0, 1 / math.sqrt(x.shape[1]), (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, 1 / math.sqrt(HIDDEN), HIDDEN),
        np.zeros(1),
    ]
    first, second, step = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    z, used = (x - mean) / scale, np.arange(len(x))
    for _ in range(EPOCHS):
        rng.shuffle(used)
        for at in range(0, len(used), 128):
            rows = used[at : at + 128]
            hidden = np.tanh(z[rows] @ w[0] + w[1])
            error = (1 / (1 + np.exp(-(hidden @ w[2] + w[3]))) - y[rows]) / len(rows)
            back = np.outer(error, w[2]) * (1 - hidden**2)
            gradients = [z[rows].T @ back, back.sum(0), hidden.T @ error, error.sum(keepdims=True)]
            step += 1
            for i, g in enumerate(gradients):
                g = g + DECAY * w[i]
                first[i] += 0.1 * (g - first[i])
                second[i] += 0.001 * (g * g - second[i])
                w[i] -= 0.003 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Network(mean, scale, w, 1.0)


def train(x: np.ndarray, y: np.ndarray, seed: int = 7) -> Network:
    """Network of all rows; its temperature is the best for rows that networks of the other folds score."""
    rng = np.random.default_rng(seed)
    part, logits = rng.permutation(len(x)) % FOLDS, np.zeros(len(x))
    for fold_number in range(FOLDS):
        held = part == fold_number
        if held.any() and not held.all():
            logits[held] = _fitted(x[~held], y[~held], rng).logits(x[held])
    network, signs = _fitted(x, y, rng), np.where(y == 1, 1, -1)
    network.temperature = min(np.geomspace(0.5, 16, 81), key=lambda t: np.logaddexp(0, -signs * logits / t).mean())
    return network


@dataclass
class QualityModel:
    contexts: np.ndarray
    #: None if the sample doesn't hold both labels; then ``share`` is every score.
    network: Network | None
    share: float

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.share)
        if not texts:
            return np.zeros(0)
        rows = np.stack([pooled(x, self.contexts) for x in texts])
        return self.network.probabilities(rows)


def fold(id_column: str = "doc_id") -> F.Column:
    """Remainder of crc32 of the id as text; rows with 0 are never learned from."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 5


def fit(
    docs: DataFrame,
    labels: DataFrame,
    staging: Staging,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    rows: int = FIT_ROWS,
) -> QualityModel:
    """Model from at most ``rows`` labelled documents, chosen by a hash of their id.

    Labels that are null are left out; of repeated ids the smallest label counts.
    """
    usable = (
        labels.where(F.col(label_column).isNotNull() & (fold(id_column) != 0))
        .groupBy(F.col(id_column).cast("bigint").alias("doc_id"))
        .agg(F.min(F.col(label_column).cast("int")).alias("label"))
    )
    chosen = staging.table(usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows), "fit-ids")
    texts = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )
    sample = staging.table(texts.join(chosen, "doc_id").repartition(FIT_TASKS, "doc_id"), "fit-sample")

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((BUCKETS, WIDTH), dtype=np.float32)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                context_sums(text, sums)
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["sums"])

    contexts = np.zeros((BUCKETS, WIDTH), dtype=np.float32)
    # At most FIT_TASKS rows of one table of sums each.
    for row in sample.select("text").coalesce(FIT_TASKS).mapInArrow(sum_up, "sums binary").collect():
        contexts += np.frombuffer(row.sums, dtype=np.float32).reshape(BUCKETS, WIDTH)
    contexts /= np.linalg.norm(contexts, axis=1, keepdims=True) + 1e-6

    def pool(batch: pa.RecordBatch) -> dict:
        vectors = [pooled(x, contexts).tobytes() for x in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "label": batch.column("label"), "vector": vectors}

    arrow = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("vector", pa.binary())])
    got = map_batches(sample.select("doc_id", "text", "label"), pool, "doc_id bigint, label int, vector binary", arrow)
    held = sorted((r.doc_id, r.label, bytes(r.vector)) for r in got.collect())
    y = np.array([x[1] for x in held], dtype=np.float64)
    if len(set(y)) < 2:
        return QualityModel(contexts, None, float(y.mean()) if len(y) else 0.5)
    x = np.stack([np.frombuffer(x[2], dtype=np.float32) for x in held])
    return QualityModel(contexts, train(x, y), float(y.mean()))


def score(
    docs: DataFrame, model: QualityModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, held_out and score (0 to 1), one row per input row.

    Null texts are scored as empty ones. A null doc_id is not held out.
    """
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.coalesce(fold(id_column) == 0, F.lit(False)).alias("held_out"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )

    def run(batch: pa.RecordBatch) -> dict:
        return {
            "doc_id": batch.column("doc_id"),
            "held_out": batch.column("held_out"),
            "score": model.scores(batch.column("text").to_pylist()),
        }

    arrow = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])
    return map_batches(rows, run, "doc_id bigint, held_out boolean, score double", arrow)


def keep_good(
    docs: DataFrame, model: QualityModel, bound: float, text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that score at least ``bound``, with all their columns."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores([x or "" for x in texts]))

    return small_batches(docs).where(scored(F.col(text_column).cast("string")) >= bound)
