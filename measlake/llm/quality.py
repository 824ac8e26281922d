"""Quality classifier: random-indexing word vectors, pooled, and a small network.

Words are runs of letters, of digits, or of other signs, as written; a hash puts
each into one of ``BUCKETS``, so that the table of word vectors has a fixed size
however many words the corpus has. Each bucket has a sparse index vector of a few
signs at hashed places. A word's vector is the sum of the index vectors of its
neighbours, over all words of all documents: tasks add up their own documents,
the sums are streamed together, and one table of fixed size comes back.

A document is the mean, the mean with frequent words weighed down, and the
spread of its words' vectors, with its length. A network of two layers, trained
on at most ``LABELLED`` labelled documents, gives a logit, and a temperature
fitted on a part held back from that training turns it into a probability.

Null and empty texts have no words; they are scored like any other, from zeros.
Without labels of both kinds every score is the share of good ones, or 0.5
without any. A document labelled more than once counts by its lowest label, a
null label not at all. Repeated rows are scored alike. Null ids are passed on
and never learnt from. Other columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from measlake.llm.common import gathered
from measlake.llm.words import Words, kinds_of

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
DIMENSIONS = 32
SIGNS = 4
WINDOW = 2
PARTS = 16
SLICE = 1 << 20
RARE = 1e-3
LABELLED = 20_000
HIDDEN = 32
EPOCHS = 60
FOLDS = 5
CUT = 0.3
SEED = 3

# Letters (with all characters beyond ASCII), digits, other signs.
KINDS = kinds_of(
    string.ascii_letters, string.digits, "".join(set(string.punctuation + "\x7f"))
)


class Buckets:
    """Buckets of the words of many texts."""

    def __init__(self) -> None:
        self.words = Words(KINDS)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of all words in order, and the first word of each text (and the end)."""
        hashes, firsts = self.words(texts)
        return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int32), firsts


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of every bucket's index vector."""
    random = np.random.default_rng(SEED)
    return (
        random.integers(0, DIMENSIONS, (BUCKETS, SIGNS)),
        random.choice([-1.0, 1.0], (BUCKETS, SIGNS)),
    )


def word_vectors(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one (or zero) of all buckets, and how often each one's words occur."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Buckets()
        places, signs = index_vectors()
        total = np.zeros(BUCKETS * DIMENSIONS)
        often = np.zeros(BUCKETS)
        for _, texts in gathered(batches):
            buckets, firsts = words(texts)
            text = np.repeat(np.arange(len(texts)), np.diff(firsts))
            often += np.bincount(buckets, minlength=BUCKETS)
            for step in range(1, WINDOW + 1):
                same = text[:-step] == text[step:]
                left, right = buckets[:-step][same], buckets[step:][same]
                for at, near in ((left, right), (right, left)):
                    for s in range(SIGNS):
                        total += np.bincount(
                            at.astype(np.int64) * DIMENSIONS + places[near, s],
                            weights=signs[near, s],
                            minlength=len(total),
                        )
        table = np.column_stack([total.reshape(BUCKETS, DIMENSIONS), often])
        yield from (
            pa.RecordBatch.from_arrays([pa.array([i]), pa.array([p.tobytes()])], ["part", "sums"])
            for i, p in enumerate(np.split(table, PARTS))
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Adds as rows come; a part's sums are all this task holds.
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                values = np.frombuffer(row["sums"])
                sums[row["part"]] = sums.get(row["part"], 0) + values
        for part, values in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([values.tobytes()])], ["part", "sums"]
            )

    schema = "part long, sums binary"
    # Few partial sums meet first, then all: no task reads one from every task of the input.
    partial = docs.select("text").mapInArrow(count, schema)
    spread = F.pmod(F.spark_partition_id(), F.lit(8))
    halfway = partial.withColumn("of", spread).repartition("part", "of").select("part", "sums")
    summed = halfway.mapInArrow(add, schema).repartition("part").mapInArrow(add, schema)
    table = np.zeros((PARTS, BUCKETS // PARTS, DIMENSIONS + 1))
    for row in summed.collect():  # PARTS rows of fixed size
        table[row.part] = np.frombuffer(row.sums).reshape(table.shape[1:])
    table = table.reshape(BUCKETS, -1)
    vectors, often = table[:, :-1], table[:, -1]
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.where(lengths > 0, lengths, 1)).astype(np.float32), often


@dataclass
class Pooling:
    """Turns texts into features."""

    vectors: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, vectors: np.ndarray, often: np.ndarray) -> Pooling:
        share = often / max(1.0, often.sum())
        return cls(vectors, (RARE / (RARE + share)).astype(np.float32))

    def __call__(self, words: Buckets, texts: list[bytes]) -> np.ndarray:
        buckets, firsts = words(texts)
        counts = np.diff(firsts)
        some = counts > 0
        begins = firsts[:-1][some]
        out = np.zeros((len(texts), 3 * DIMENSIONS + 4))
        if not some.any():
            return out

        def mean(values: np.ndarray) -> np.ndarray:
            return np.add.reduceat(values, begins, axis=0, dtype=np.float32)

        each = self.vectors[buckets]
        weight = self.weights[buckets]
        n = counts[some][:, None].astype(np.float64)
        plain = mean(each) / n
        total = np.maximum(mean(weight[:, None]), 1e-9)
        rare = mean(each * weight[:, None]) / total
        spread = np.sqrt(np.maximum(mean(each * each) / n - plain**2, 0))
        again = np.append(False, buckets[1:] == buckets[:-1])[:, None].astype(np.float32)
        out[some] = np.hstack(
            [
                plain,
                rare,
                spread,
                np.log1p(n),
                np.linalg.norm(plain, axis=1, keepdims=True),
                total / n,
                mean(again) / n,
            ]
        )
        return out


@dataclass
class Network:
    """Two layers over standardised features, and a temperature."""

    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float

    def logits(self, features: np.ndarray) -> np.ndarray:
        hidden = np.tanh((features - self.centre) / self.scale @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def __call__(self, features: np.ndarray) -> np.ndarray:
        scaled = np.clip(self.logits(features) / self.temperature, -500, 500)
        return 1 / (1 + np.exp(-scaled))


def constant(share: float, width: int) -> Network:
    """A network that gives the same score to all."""
    share = min(max(share, 1e-6), 1 - 1e-6)
    zeros = np.zeros((width, 1))
    bias = float(np.log(share / (1 - share)))
    return Network(np.zeros(width), np.ones(width), zeros, np.zeros(1), np.zeros(1), bias, 1.0)


def trained(features: np.ndarray, good: np.ndarray) -> Network:
    """Adam on the cross-entropy of four fifths; the temperature is fitted on the last fifth."""
    width = 3 * DIMENSIONS + 4
    if len(good) < 10 or good.min() == good.max():
        return constant(float(good.mean()) if len(good) else 0.5, width)
    random = np.random.default_rng(SEED)
    order = random.permutation(len(good))
    held, used = order[: len(good) // 5], order[len(good) // 5 :]
    centre = features[used].mean(axis=0)
    scale = np.maximum(features[used].std(axis=0), 1e-6)
    net = Network(
        centre,
        scale,
        random.standard_normal((width, HIDDEN)) / np.sqrt(width),
        np.zeros(HIDDEN),
        random.standard_normal(HIDDEN) / np.sqrt(HIDDEN),
        0.0,
        1.0,
    )
    x, y = (features - centre) / scale, good.astype(float)
    weights = [net.first, net.first_bias, net.second, np.zeros(1)]
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    step = 0
    for epoch in range(EPOCHS):
        rate = 0.01 * (1 - epoch / EPOCHS)
        shuffled = random.permutation(used)
        for i in range(0, len(shuffled), 256):
            rows = shuffled[i : i + 256]
            hidden = np.tanh(x[rows] @ weights[0] + weights[1])
            score = 1 / (1 + np.exp(-np.clip(hidden @ weights[2] + weights[3], -500, 500)))
            error = (score - y[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (1 - hidden**2)
            slopes = [
                x[rows].T @ back + 1e-4 * weights[0],
                back.sum(axis=0),
                hidden.T @ error + 1e-4 * weights[2],
                error.sum(keepdims=True),
            ]
            step += 1
            for w, m, g in zip(weights, moments, slopes):
                m[0] = 0.9 * m[0] + 0.1 * g
                m[1] = 0.999 * m[1] + 0.001 * g * g
                w -= rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
    net.first, net.first_bias, net.second = weights[:3]
    net.second_bias = float(weights[3][0])
    if len(held):
        logits = net.logits(features[held])

        def loss(temperature: float) -> float:
            z = logits / temperature
            return float(np.mean(np.logaddexp(0, z) - good[held] * z))

        net.temperature = float(min(np.geomspace(0.2, 10, 200), key=loss))
    return net


def in_fold(folds: int = FOLDS) -> Column:
    """Whether an id's label is held out: its checksum is divisible by the number of folds."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(checksum % folds == 0, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame) -> tuple[Pooling, Network]:
    """Word vectors of all documents, and a network learnt from labels that are not held out."""
    pooling = Pooling.of(*word_vectors(docs))
    known = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .where(~in_fold())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(LABELLED)
    )
    good = {row.doc_id: row.quality for row in known.collect()}

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Buckets()
        for rows, texts in gathered(batches, target=SLICE):
            ids = rows.column("doc_id").to_pylist()
            own = [i for i, doc_id in enumerate(ids) if doc_id in good]
            if own:
                found = pooling(words, [texts[i] for i in own]).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id").combine_chunks().take(pa.array(own)),
                        pa.array([f.tobytes() for f in found], pa.binary()),
                    ],
                    ["doc_id", "features"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    # Bounded by LABELLED, but for repeated rows of a document, of which one is enough.
    learnt = (
        docs.select("doc_id", "text")
        .mapInArrow(features, f"doc_id {id_type}, features binary")
        .groupBy("doc_id")
        .agg(F.min("features").alias("features"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .collect()
    )
    x = np.array([np.frombuffer(r.features, dtype=np.float32) for r in learnt], dtype=float)
    y = np.array([good[r.doc_id] for r in learnt], dtype=int)
    return pooling, trained(x, y)


def with_scores(
    docs: DataFrame, labels: DataFrame, column: str = "score", others: tuple[str, ...] = ()
) -> DataFrame:
    """Ids, the columns named in ``others``, and each document's score (0 to 1)."""
    pooling, network = fitted(docs, labels)
    kept_columns = list(dict.fromkeys(["doc_id", *others]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Buckets()
        for rows, texts in gathered(batches, target=SLICE):
            scores = network(pooling(words, texts))
            found = rows.select(kept_columns).append_column(column, pa.array(scores))
            yield from found.combine_chunks().to_batches()

    narrow = docs.select(*dict.fromkeys([*kept_columns, "text"]))
    out = docs.select(*kept_columns).schema.simpleString()[7:-1]
    return narrow.mapInArrow(score, f"{out},{column}:double")


def digest(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    return with_scores(docs, labels).select(
        "doc_id",
        in_fold().alias("held_out"),
        "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The documents that the classifier does not reject."""
    others = tuple(docs.columns)
    scored = with_scores(docs, labels, "__score", others)
    return scored.where(F.col("__score") >= cut).select(*docs.columns)
