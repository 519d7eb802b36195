"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

A word falls into one of ``BUCKETS`` hash buckets by its lower-case form and into another by its shape
(letters folded to a or A, digits to 9, runs shortened). Every bucket has a fixed sparse random index
vector. The context vector of a word bucket is the sum of the index vectors of the words within two
places of it, over ALL documents: whole numbers, so the sums do not depend on their order. What the
driver gathers is one row per bucket, bounded by BUCKETS whatever the corpus. A word's vector is its
normalised context vector beside the index vectors of its form and shape; a document has the mean and
the spread of its words' vectors and its length.

The network has two layers, is trained with numpy on at most ``MAX_TRAIN`` labelled rows (those with the
lowest hash of their id, a documented bound) and its probabilities are calibrated by one temperature on
rows it was not trained on. Scores use the text alone.

Defined cases: a null or empty text has the zero vector and the score that the network gives it; labels
with a null id or label are not used; of several labels for one id the lowest counts; documents with the
same id are all scored, each by its own text; with one class of labels only (or none) the score is the
smoothed share of good ones.
"""
from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import Shipped, map_rows, whole, without, words_of

BUCKETS = 8_192
DIM = 32
NONZERO = 2
REACH = 2
MAX_TRAIN = 20_000
CACHE_WORDS = 300_000
BLOCK_WORDS = 100_000

#: capitals, other letters (and all bytes beyond ASCII) and digits fold to A, a and 9
FOLD = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 57 if 48 <= c <= 57 else c for c in range(256))
RUN = re.compile(rb"(.)\1+", re.S)


def index_vectors(seed: int) -> np.ndarray:
    """Sparse random vectors of +1 and -1, one per bucket."""
    rng = np.random.default_rng(seed)
    out = np.zeros((BUCKETS, DIM), np.int64)
    for k in range(NONZERO):
        out[np.arange(BUCKETS), rng.integers(0, DIM, BUCKETS)] += rng.choice((-1, 1), BUCKETS)
    return out


def shape(word: bytes) -> bytes:
    """Folded letters, a run of one of them shortened to two."""
    return RUN.sub(rb"\1\1", word.translate(FOLD))[:16]


class Buckets:
    """Word to bucket of its form and bucket of its shape, with a bounded cache."""

    def __init__(self) -> None:
        self.cache: dict[str, int] = {}

    def of(self, word: str) -> int:
        """Both buckets, as one number, of a word that the cache lacks."""
        found = zlib.crc32(word.lower().encode("utf-8")) % BUCKETS * BUCKETS + zlib.crc32(b"shape " + shape(word.encode("utf-8"))) % BUCKETS
        if len(self.cache) >= CACHE_WORDS:
            self.cache.clear()
        self.cache[word] = found
        return found

    def blocks(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Form buckets, shape buckets and word counts of runs of whole texts."""
        flat, text = words_of(column)
        coded = flat.dictionary_encode()
        get, of = self.cache.get, self.of
        # 0 is a bucket, too, which is merely looked up again
        distinct = np.array([get(w) or of(w) for w in coded.dictionary.to_pylist()], np.int64)
        both = distinct[coded.indices.to_numpy()] if len(flat) else np.empty(0, np.int64)
        counts = np.bincount(text, minlength=len(column))
        ends = np.cumsum(counts)
        first = done = 0
        while first < len(counts):
            last = max(first + 1, int(np.searchsorted(ends, done + BLOCK_WORDS, "right")))
            part = both[done:ends[last - 1]]
            yield part // BUCKETS, part % BUCKETS, counts[first:last]
            first, done = last, int(ends[last - 1])


def add_contexts(sums: np.ndarray, forms: np.ndarray, shapes: np.ndarray, counts: np.ndarray, near: np.ndarray, far: np.ndarray) -> None:
    """Add to each word's bucket the index vectors of the words within REACH places in the same text.

    Arrays run by dimension: ``sums``, ``near`` and ``far`` have a row per dimension.
    """
    if not len(forms):
        return
    doc = np.repeat(np.arange(len(counts)), counts)
    apart = [doc[step:] != doc[:-step] for step in range(1, REACH + 1)]
    for d in range(DIM):
        own = near[d].take(forms) + far[d].take(shapes)
        around = np.zeros_like(own)
        for step, other in enumerate(apart, 1):
            ahead, back = own[step:].copy(), own[:-step].copy()
            ahead[other] = back[other] = 0
            around[:-step] += ahead
            around[step:] += back
        sums[d] += np.bincount(forms, around, minlength=BUCKETS).astype(np.int64)


def contexts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Context vectors of all buckets over all documents: BUCKETS rows of whole numbers."""
    near, far = (np.ascontiguousarray(index_vectors(s).T.astype(np.int8)) for s in (1, 2))
    shipped = Shipped(docs.sparkSession, (near, far))
    schema = T.StructType([T.StructField("bucket", T.IntegerType())] + [T.StructField(f"c{i}", T.LongType()) for i in range(DIM)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, buckets = np.zeros((DIM, BUCKETS), np.int64), shipped.state("buckets", Buckets)
        for batch in batches:
            for forms, shapes, counts in buckets.blocks(batch.column(0)):
                add_contexts(sums, forms, shapes, counts, *shipped.value)
        some = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *[pa.array(sums[i, some]) for i in range(DIM)]], names=schema.names)

    summed = docs.select(text).mapInArrow(run, schema).groupBy("bucket").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(DIM)])
    out = np.zeros((BUCKETS, DIM), np.float64)
    for row in summed.collect():                 # at most BUCKETS rows
        out[row[0]] = row[1:]
    return out


def word_vectors(context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vector per form bucket and per shape bucket; a word's vector is their sum."""
    unit = context / np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-9)
    form = np.hstack([unit, index_vectors(1)]).astype(np.float32)
    by_shape = np.hstack([index_vectors(2), np.zeros((BUCKETS, DIM))]).astype(np.float32)
    return form, by_shape


FEATURES = 4 * DIM + 1


def pool(column: pa.Array, form: np.ndarray, by_shape: np.ndarray, buckets: Buckets) -> np.ndarray:
    """Mean and spread of the word vectors, and the length, of each text."""
    out = []
    for forms, shapes, counts in buckets.blocks(column):
        pooled = np.zeros((len(counts), FEATURES))
        vectors = form[forms]
        vectors += by_shape[shapes]
        ones, start = np.ones(int(counts.max()), np.float32), 0
        for i in np.flatnonzero(counts).tolist():
            n = int(counts[i])
            own, start = vectors[start:start + n], start + n
            mean = (ones[:n] @ own) / n
            pooled[i, :2 * DIM] = mean
            own -= mean
            np.multiply(own, own, out=own)
            pooled[i, 2 * DIM:4 * DIM] = np.sqrt((ones[:n] @ own) / n)
            pooled[i, -1] = np.log1p(n) / 10
        out.append(pooled)
    return np.vstack(out)


class Network:
    """Two layers, trained by Adam on the log loss, with a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 300, rate: float = 0.01, decay: float = 1e-4, seed: int = 7):
        self.share = (y.sum() + 1) / (len(y) + 2)
        self.temperature, self.weights = 1.0, []
        if not len(y) or y.min() == y.max():
            return
        rng = np.random.default_rng(seed)
        holdout = np.arange(len(y)) % 5 == 4
        if len(set(y[~holdout])) < 2 or len(set(y[holdout])) < 2:
            holdout[:] = False
        self.centre, self.scale = x.mean(0), x.std(0) + 1e-6
        x = (x - self.centre) / self.scale
        w = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden ** -0.5, hidden), np.zeros(1)]
        first, second = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
        tx, ty, t = x[~holdout], y[~holdout], 0
        for _ in range(epochs):
            order = rng.permutation(len(ty))
            for part in np.array_split(order, max(1, len(order) // 2_000)):
                t += 1
                h = np.tanh(tx[part] @ w[0] + w[1])
                gap = (sigmoid(h @ w[2] + w[3]) - ty[part]) / len(part)
                back = np.outer(gap, w[2]) * (1 - h * h)
                grads = [tx[part].T @ back + decay * w[0], back.sum(0), h.T @ gap + decay * w[2], gap.sum(keepdims=True)]
                for p, g, a, b in zip(w, grads, first, second):
                    a *= 0.9
                    a += 0.1 * g
                    b *= 0.999
                    b += 0.001 * g * g
                    p -= rate * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.999 ** t)) + 1e-8)
        self.weights = w
        if holdout.any():
            raw, want = self.logits(x[holdout]), y[holdout]
            loss = lambda temp: np.mean(np.logaddexp(0, -(2 * want - 1) * raw / temp))
            self.temperature = float(min(np.geomspace(0.25, 20, 200), key=loss))

    def logits(self, scaled: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.tanh(scaled @ w[0] + w[1]) @ w[2] + w[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(x), self.share)
        return sigmoid(self.logits((x - self.centre) / self.scale) / self.temperature)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose label is never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def pooled(docs: DataFrame, vectors, text: str, keep: Sequence[str]) -> DataFrame:
    def work(column: pa.Array) -> dict[str, list]:
        return {"features": [x.tobytes() for x in pool(column, *vectors.value, vectors.state("buckets", Buckets))]}

    return map_rows(docs, keep, T.StructType([T.StructField("features", T.BinaryType())]), [text], work)


def train(docs: DataFrame, labels: DataFrame, vectors, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          max_train: int = MAX_TRAIN) -> Network:
    """The network from at most ``max_train`` labelled rows that are not held out."""
    marks = (labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(doc_id))
             .groupBy(F.col(doc_id).alias("__id")).agg((F.min(label) >= 1).cast("int").alias("__y"))
             .orderBy(F.xxhash64(F.col("__id")), "__id").limit(max_train))
    known = docs.select(F.col(doc_id).alias("__id"), whole(text).alias("__text")).join(F.broadcast(marks), "__id")
    # repeated ids must not lift the bound either; the order decides batches and holdout, so it is fixed by id and features
    rows = (pooled(known, vectors, "__text", ["__id", "__y"]).orderBy(F.xxhash64("__id"), "__id", "features")
            .limit(max_train).toPandas())
    x = np.frombuffer(b"".join(rows["features"]), np.float64).reshape(len(rows), FEATURES)
    return Network(x, rows["__y"].to_numpy(dtype=float))


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          cutoff: float = 0.7, keep: Sequence[str] | None = None, max_train: int = MAX_TRAIN) -> DataFrame:
    """The columns ``keep`` (default: the id), held_out, score and predicted of every document."""
    vectors = Shipped(docs.sparkSession, word_vectors(contexts(docs, text)))
    model = train(docs, labels, vectors, doc_id, text, label, max_train)

    def work(column: pa.Array) -> dict[str, np.ndarray]:
        return {"score": model.score(pool(column, *vectors.value, vectors.state("buckets", Buckets)))}

    names = ["held_out", "score", "predicted"]
    keep = [doc_id] if keep is None else [c for c in keep if c in without(docs, names)]
    scored = map_rows(docs, keep, T.StructType([T.StructField("score", T.DoubleType())]), [text], work)
    return scored.select(*keep, held_out(doc_id).alias("held_out"), "score", (F.col("score") >= cutoff).cast("int").alias("predicted"))
