"""Document quality by gated attention over passages (multiple-instance learning).

A text is a bag of passages. Every passage is encoded by counts of word shapes, word
hashes and repetitions; a hidden layer turns that into a vector. Gated attention weights
the passages of a document, and a logistic output scores the weighted vector. Labels are
known for documents only; the weights of passages follow from those.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftledger.llm.common import strings, table, worker_memory

PASSAGE_WORDS = 64
SHAPES, WORDS = 96, 96
EXTRA = 8
FEATURES = SHAPES + WORDS + EXTRA
HIDDEN, ATTENTION = 32, 16
# Training: at most this many labelled documents, by hash of their id, and this many
# evenly spread passages of each. Scores use every passage of every document.
TRAIN_DOCUMENTS = 4_000
TRAIN_PASSAGES = 48
EPOCHS, BATCH, RATE, DECAY = 25, 64, 0.004, 1e-4
# Words a worker remembers at once; a forgotten word is read again.
REMEMBERED = 250_000

def shape(word: str) -> str:
    """The word's form: capitals, letters and digits as one sign per run, other signs as they are."""
    signs = "".join(
        "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word
    )
    return re.sub(r"(.)\1+", r"\1\1", re.sub(r"([Aa0])\1+", r"\1", signs))


class _Known(dict):
    def __init__(self, add):
        self.add = add

    def __missing__(self, word: str) -> int:
        return self.add(word)


class Encoder:
    """Texts to passage features."""

    def __init__(self):
        self.known = _Known(self._add)
        self._clear(REMEMBERED)

    def _clear(self, most: int) -> None:
        self.known.clear()
        self.shape = np.zeros(most, np.int64)
        self.bucket = np.zeros(most, np.int64)
        self.chars = np.zeros(most, np.float64)
        self.other = np.zeros(most, np.float64)

    def _add(self, word: str) -> int:
        self.known[word] = at = len(self.known)
        self.shape[at] = xxhash.xxh32_intdigest(shape(word)[:12]) % SHAPES
        core = word.strip(".,;:!?").lower()
        self.bucket[at] = xxhash.xxh32_intdigest(core, 7) % WORDS
        self.chars[at] = len(word)
        self.other[at] = sum(not c.isalnum() for c in word) / len(word)
        return at

    def __call__(self, text: str) -> np.ndarray:
        """One row per passage; a text without words is one row of zeros."""
        words = text.split()
        n = len(words)
        if not n:
            return np.zeros((1, FEATURES), np.float32)
        if len(self.known) + n > len(self.shape):
            self._clear(max(REMEMBERED, n))
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, n)
        passages = -(-n // PASSAGE_WORDS)
        of = np.arange(n) // PASSAGE_WORDS
        sizes = np.bincount(of, minlength=passages).astype(np.float64)

        def share(column: np.ndarray, width: int) -> np.ndarray:
            counts = np.bincount(of * width + column[at], minlength=passages * width)
            return np.sqrt(counts.reshape(passages, width) / sizes[:, None])

        def mean(values: np.ndarray) -> np.ndarray:
            return np.bincount(of, weights=values, minlength=passages) / sizes

        repeats = []
        for lag in (1, 2, 3, 4):
            same = np.zeros(n)
            same[lag:] = at[lag:] == at[:-lag]
            repeats.append(mean(same))
        first = np.ones(n)
        order = np.argsort(at, kind="stable")
        again = (at[order][1:] == at[order][:-1]) & (of[order][1:] == of[order][:-1])
        first[order[1:][again]] = 0
        chars = mean(self.chars[at])
        extra = [*repeats, mean(first), chars / 10, mean(self.other[at]), np.log1p(sizes) / 4]
        parts = [share(self.shape, SHAPES), share(self.bucket, WORDS), np.array(extra).T]
        return np.hstack(parts).astype(np.float32)


def worker_encoder() -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return worker_memory("passages", Encoder)


@dataclass
class Model:
    """Weights: hidden layer, attention (tanh and gate), attention output, logistic output."""

    weights: list[np.ndarray]

    def scores(self, features: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each bag; bags begin at ``starts``."""
        return _forward(self.weights, features, starts)[-1]


def _start(seed: int) -> list[np.ndarray]:
    draw = np.random.default_rng(seed)
    shapes = [(FEATURES, HIDDEN), (HIDDEN, ATTENTION), (HIDDEN, ATTENTION), (ATTENTION,), (HIDDEN,)]
    weights = [draw.normal(0, 1 / np.sqrt(s[0]), s) for s in shapes]
    return [weights[0], np.zeros(HIDDEN), *weights[1:], np.zeros(1)]


def _forward(weights: list[np.ndarray], x: np.ndarray, starts: np.ndarray) -> tuple:
    w, b, v, u, a, o, c = weights
    h = np.tanh(x @ w + b)
    t, g = np.tanh(h @ v), 1 / (1 + np.exp(-(h @ u)))
    energy = (t * g) @ a
    sizes = np.diff(np.append(starts, len(x)))
    of = np.repeat(np.arange(len(starts)), sizes)
    top = np.exp(energy - np.maximum.reduceat(energy, starts)[of])
    weight = top / np.add.reduceat(top, starts)[of]
    z = np.add.reduceat(weight[:, None] * h, starts)
    return h, t, g, weight, of, z, 1 / (1 + np.exp(-(z @ o + c[0])))


def _gradients(weights, x, starts, y):
    w, b, v, u, a, o, c = weights
    h, t, g, weight, of, z, p = _forward(weights, x, starts)
    d = (p - y) / len(y)
    dz = np.outer(d, o)
    dh = weight[:, None] * dz[of]
    dweight = (dz[of] * h).sum(1)
    mean = np.add.reduceat(weight * dweight, starts)
    energy = weight * (dweight - mean[of])
    dt, dg = np.outer(energy, a) * g * (1 - t**2), np.outer(energy, a) * t * g * (1 - g)
    dh += dt @ v.T + dg @ u.T
    dx = dh * (1 - h**2)
    return [x.T @ dx, dx.sum(0), h.T @ dt, h.T @ dg, (t * g).T @ energy, z.T @ d, np.array([d.sum()])]


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 1) -> Model:
    """Adam on the mean log loss of documents."""
    weights = _start(seed)
    if not bags:
        return Model(weights)
    rate = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    weights[-1][0] = np.log(rate / (1 - rate))
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    draw, step = np.random.default_rng(seed), 0
    for epoch in range(EPOCHS):
        order = draw.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            x = np.vstack([bags[i] for i in chosen])
            starts = np.concatenate([[0], np.cumsum([len(bags[i]) for i in chosen])[:-1]])
            step += 1
            speed = RATE * (1 - 0.9 * epoch / EPOCHS)
            for k, slope in enumerate(_gradients(weights, x, starts, labels[chosen])):
                slope = slope + DECAY * weights[k]
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope**2
                up = first[k] / (1 - 0.9**step)
                weights[k] = weights[k] - speed * up / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(weights)


def _encoded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of up to TRAIN_PASSAGES evenly spread passages of each text."""
    encode = worker_encoder()
    for part in parts:
        rows = []
        for text in strings(part.column(1)):
            x = encode(text)
            if len(x) > TRAIN_PASSAGES:
                x = x[np.linspace(0, len(x) - 1, TRAIN_PASSAGES).astype(int)]
            rows.append(x.astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [part.column(0), part.column(2), pa.array(rows, pa.binary())], names=["doc_id", "y", "x"]
        )


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCUMENTS) -> Model:
    """Fit on a bounded sample of labelled documents: the ``most`` smallest hashes of ids.

    ``labels``: doc_id and quality (0 or 1; other values and NULL ids are left out). Several
    labels of a document are averaged; rows of one doc_id are rows of that document.
    """
    spark = docs.sparkSession
    known = (
        labels.where("quality in (0, 1) and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.avg("quality").alias("y"))
    )
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = spark.createDataFrame(sample.collect(), sample.schema)  # ``most`` rows
    chosen = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")
    # Rows that share an id count against the same bound.
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) if _repeated(chosen) else chosen
    found = (
        chosen.select("doc_id", "text", "y")
        .mapInArrow(_encoded, "doc_id long, y double, x binary")
        .collect()
    )
    found.sort(key=lambda r: (r["doc_id"], r["x"]))
    bags = [np.frombuffer(r["x"], "<f4").reshape(-1, FEATURES) for r in found]
    return fit(bags, np.array([r["y"] for r in found]))


def _repeated(chosen: DataFrame) -> bool:
    n = chosen.agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("ids")).first()
    return n["n"] > n["ids"]


def with_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Add the probability of quality 1, read from the whole text alone.

    NULL and empty texts, and texts without words, get the score of one empty passage.
    Documents stay where they are; the model has a fixed size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns
    schema = docs.withColumn(name, F.lit(0.0)).schema

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_encoder()
        for part in parts:
            scores, bags, held = [], [], 0

            def flush():
                if bags:
                    sizes = [len(x) for x in bags]
                    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(int)
                    scores.extend(shared.value.scores(np.vstack(bags), starts).tolist())
                    bags.clear()

            for text in strings(part.column(columns.index("text"))):
                bags.append(encode(text))
                held += len(bags[-1])
                if held > 4_000:
                    flush()
                    held = 0
            flush()
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(scores, pa.float64())], names=[*part.schema.names, name]
            )

    return docs.mapInArrow(score, schema)


def learned_from(column: str = "doc_id"):
    """Rows whose labels may be learned; the others are held out."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 3 != 1


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document, learned from two thirds of labels."""
    model = train(docs, labels.where(learned_from()))
    return with_score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(~learned_from(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return scored(table(spark, folder, "documents"), table(spark, folder, "labels"))
