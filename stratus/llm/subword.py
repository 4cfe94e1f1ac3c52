"""Averaged subword embeddings with a softmax output, trained by stochastic gradient descent in numpy.

A document's features are its white-space separated words and its character n-grams (blanks included), each hashed to one of 2**bits buckets of its own kind, and (if asked
for) for each word whether it repeats the word before it, a word pair with two buckets. The document vector is the
average of the learned vectors of all its features; a linear layer and a softmax give the classes.

Training reads a bounded sample, as bucket counts of whole texts, in one task; the driver gets the model only. Scoring runs in Spark
tasks: by linearity a bucket's vector times the output layer is a short row of logits, so a document
needs only the average of its features' rows, a few array passes over its bytes.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stratus.llm.textbytes import Chunk, chunks


CHUNK_BYTES = 1 << 18  # bytes of texts at a time: some twenty arrays of eight times that lie in memory


@dataclass(frozen=True)
class Features:
    """Words, and character n-grams of each length in ``grams``; ``lower`` folds A-Z first; ``repeats`` adds the
    repeated words."""

    bits: int = 15
    grams: tuple[int, ...] = (3, 4)
    lower: bool = False
    repeats: bool = False

    @property
    def buckets(self) -> int:
        return ((1 + len(self.grams)) << self.bits) + 2

    def of(self, chunk: Chunk) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each kind of feature: the bucket of every feature in text order, and the index of each
        document's first one (one more than documents). The last bucket + 1 stands for no feature."""
        shift = np.uint64(64 - self.bits)
        starts, ends, first = chunk.words()
        word = chunk.spans(starts, ends)
        yield (word >> shift).astype(np.int32), first
        if self.repeats:
            same = np.zeros(len(word), dtype=np.int32)
            same[1:] = word[1:] == word[:-1]
            same[first[:-1][first[:-1] < len(word)]] = 0
            yield same + (self.buckets - 2), first
        at = chunk.characters()
        first = np.searchsorted(at, chunk.offsets)  # of each document, its first character
        ascii_only = len(at) == len(chunk.prefix)  # no copies where characters are bytes
        prefix, down = (chunk.prefix, chunk.down) if ascii_only else (chunk.prefix[at], chunk.down[at])
        for kind, n in enumerate(self.grams, 1):
            m = max(len(at) - n, 0)  # ``at`` ends with the end of the chunk
            span = prefix[n: n + m] - prefix[:m]
            span *= down[:m]
            span >>= shift
            bucket = span.astype(np.int32)
            bucket += kind << self.bits
            for back in range(1, n):  # spans that cross the end of a document
                over = first[1:] - back
                bucket[over[(over >= 0) & (over < m)]] = self.buckets
            yield bucket, np.minimum(first, m)

    def counts(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``row, buckets, counts`` of each document."""
        for chunk in chunks(column, self.lower, CHUNK_BYTES):
            kinds = list(self.of(chunk))
            for d in range(chunk.docs):
                found = np.concatenate([b[f[d]: f[d + 1]] for b, f in kinds])
                bucket, count = np.unique(found[found < self.buckets], return_counts=True)
                yield chunk.first + d, bucket.astype(np.int32), count.astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Logits of each bucket (buckets, classes), the classes' bias, a temperature, and the class names. With more
    classes than a vector has numbers ``logits`` holds the vectors, and ``output`` makes logits of their average."""

    features: Features
    logits: np.ndarray
    bias: np.ndarray
    classes: tuple
    temperature: float = 1.0
    output: np.ndarray | None = None

    def scores(self, column: pa.Array) -> np.ndarray:
        """Class probabilities of every text of the column; a text without features has the bias alone."""
        width = self.logits.shape[1]
        tables = [np.append(self.logits[:, c], 0.0) for c in range(width)]
        if self.output is None:
            tables = [t - tables[0] for t in tables]
        out = np.zeros((len(column), width))
        for chunk in chunks(column, self.features.lower, CHUNK_BYTES):
            rows = slice(chunk.first, chunk.first + chunk.docs)
            n = np.zeros(chunk.docs)
            for bucket, first in self.features.of(chunk):
                here = np.diff(first)
                live = np.flatnonzero(here)
                if not len(live):
                    continue
                blank = np.add.reduceat((bucket == self.features.buckets).astype(np.int64), first[live])
                n[live] += here[live] - blank
                for c in range(self.output is None, width):
                    out[rows, c][live] += np.add.reduceat(tables[c][bucket], first[live])
            out[rows] /= np.maximum(n, 1)[:, None]
        if self.output is not None:
            out = out @ self.output
        return softmax((out + self.bias - self.bias[0]) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


SAMPLE = "label string, buckets binary, counts binary"


def learned(rows: DataFrame, features: Features, learn: Callable[[list], object]) -> object:
    """``learn(sample)`` for ``rows(label, text)``, a bounded sample, as label and bucket counts in a fixed order.
    Learning runs in one task (repeated alike if its executor is lost); only what it returns comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(features.counts(batch.column(1)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([b.tobytes() for _, b, _ in found], pa.binary()),
                pa.array([c.tobytes() for _, _, c in found], pa.binary())], ["label", "buckets", "counts"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # views of the batches, not copies; the order is fixed by what a row holds
        sample = [(label, np.frombuffer(b.as_buffer(), np.int32), np.frombuffer(c.as_buffer(), np.float32))
                  for batch in batches for label, b, c in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True)]
        sample.sort(key=lambda x: (x[0], len(x[1]), zlib.crc32(x[1]), zlib.crc32(x[2])))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(learn(sample))], pa.binary())], ["model"])

    counted = rows.selectExpr("cast(label AS string) AS label", "text").mapInArrow(count, SAMPLE)
    got = counted.repartition(1).mapInArrow(fit, "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else learn([])


def train(sample: list, classes: tuple, features: Features, dim: int = 12, epochs: int = 8, rate: float = 0.5,
          seed: int = 7) -> Model:
    """Stochastic gradient descent, one document a step, the rate falling to zero. Each step is scaled by the
    document's number of features, as its gradient on one vector is that many times smaller."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (features.buckets, dim)).astype(np.float32)
    output = np.zeros((dim, len(classes)), dtype=np.float32)
    bias = np.zeros(len(classes), dtype=np.float32)
    place = {c: i for i, c in enumerate(classes)}
    docs = [(place[label], b, c / c.sum()) for label, b, c in sample if len(b)]
    steps, step = max(1, epochs * len(docs)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            label, bucket, weight = docs[i]
            r = rate * (1 - step / steps)
            step += 1
            rows = vectors[bucket]
            hidden = weight @ rows
            slope = softmax(hidden @ output + bias)
            slope[label] -= 1
            back = output @ slope
            output -= r * np.outer(hidden, slope)
            bias -= 0.1 * r * slope
            vectors[bucket] = rows - (r / (weight @ weight)) * weight[:, None] * back
    if len(classes) > dim:
        return Model(features, vectors, bias.astype(np.float64), classes, output=output)
    logits = (vectors @ output).astype(np.float64)
    return Model(features, logits, bias.astype(np.float64), classes)


def probabilities(model: Model, sample: list, temperature: float) -> np.ndarray:
    z = np.array([(c @ model.logits[b]) / max(c.sum(), 1) for _, b, c in sample]).reshape(-1, model.logits.shape[1])
    if model.output is not None:
        z = z @ model.output
    return softmax((z + model.bias) / temperature)


def calibrated(model: Model, sample: list) -> Model:
    """The temperature that makes ``sample``, not used in training, likeliest."""
    if not sample:
        return model
    right = np.array([model.classes.index(label) for label, _, _ in sample])
    loss = {t: -np.log(np.maximum(probabilities(model, sample, t)[np.arange(len(right)), right], 1e-12)).mean()
            for t in np.geomspace(0.25, 8, 21)}
    return replace(model, temperature=float(min(loss, key=loss.get)))
