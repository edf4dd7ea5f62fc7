"""Quality scores from supervised subword embeddings."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate, islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, released, table

BUCKETS = 1 << 16  # 16 bits each
SHORTEST, LONGEST = 3, 5  # characters of an n-gram
WIDTH = 8
EPOCHS, BATCH, RATE = 6, 32, 0.5
SAMPLE = 4000  # labelled documents that the classifier is fitted on, in the order of a hash
SAMPLE_BYTES = 96 << 20  # of their texts
CUT = 0.3
KNOWN = 150_000  # words whose sums a task remembers
LEARNED = 4096  # words whose features are listed at once
CHARS = 1 << 18  # characters of the texts that are scored at once
AGAIN = "\n"  # the token of a word that stands again right after itself


def tokens(text: str | None) -> list[str]:
    """Lower-cased words without white space, and for each that repeats the one before it a token that says so."""
    words = (text or "").lower().split()
    return words + [AGAIN] * sum(map(eq, words, islice(words, 1, None)))


def features(word: str) -> list[int]:
    """Buckets of a word and of its character n-grams, with its ends marked."""
    word = f"<{word}>"
    raw, n = word.encode("utf-8", "surrogatepass"), len(word)
    out = [zlib.crc32(raw) % BUCKETS]
    if len(raw) == n:  # a character is a byte
        for size in range(SHORTEST, LONGEST + 1):
            out += [zlib.crc32(raw[i : i + size]) % BUCKETS for i in range(n - size + 1)]
        return out
    at = [0, *accumulate(len(c.encode("utf-8", "surrogatepass")) for c in word)]
    for size in range(SHORTEST, LONGEST + 1):
        out += [zlib.crc32(raw[at[i] : at[i + size]]) % BUCKETS for i in range(n - size + 1)]
    return out


@dataclass
class Model:
    """What one feature adds to the logit of label 1 over label 0, before averaging, and the bias.

    The two-way softmax over linear sums of an average of vectors hangs on this difference alone.
    """

    gain: np.ndarray
    bias: float

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    def __init__(self, model: Model):
        self.gain, self.bias = model.gain, model.bias
        self.known: dict[str, complex] = {}  # the sum of gains, and as imaginary part the number of features

    def learn(self, words: set[str]) -> None:
        if len(self.known) > KNOWN:  # what came first is the most frequent and stays
            for w in list(islice(reversed(self.known), len(self.known) - KNOWN // 2)):
                del self.known[w]
        new = list(words.difference(self.known))
        for k in range(0, len(new), LEARNED):
            some = new[k : k + LEARNED]
            found = [features(w) for w in some]
            sizes = np.array([len(f) for f in found], np.int64)
            flat = np.fromiter((i for f in found for i in f), np.int64, int(sizes.sum()))
            sums = np.add.reduceat(self.gain[flat], np.cumsum(sizes) - sizes)
            self.known.update(zip(some, map(complex, sums.tolist(), sizes.tolist()), strict=True))

    def _few(self, texts: list[str | None]) -> Iterator[float]:
        some = [tokens(t) for t in texts]
        self.learn({w for words in some for w in words})
        for words in some:
            total = sum(map(self.known.__getitem__, words), 0j)
            logit = self.bias + (total.real / total.imag if words else 0.0)
            yield 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))

    def score(self, texts: Iterable[str | None]) -> Iterator[float]:
        """Texts are taken until they hold CHARS characters, so that long ones don't come many at a time."""
        some: list[str | None] = []
        size = 0
        for t in texts:
            some.append(t)
            size += len(t or "")
            if size >= CHARS:
                yield from self._few(some)
                some, size = [], 0
        yield from self._few(some)


def sample_of(docs: DataFrame, labels: DataFrame, label: str, learnable: F.Column, n: int, most: int = SAMPLE_BYTES) -> DataFrame:
    """(doc_id, y, text): at most n labelled documents and `most` bytes, whole, in the order of a hash of the id.

    Rows without an id or a label are left out. An id that has several labels takes the greatest, and one that stands
    in several documents the greatest text, so that repeated ids don't pass the bounds.
    """
    own = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).where(learnable)
    own = own.groupBy("doc_id").agg(F.max(label).alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    rows = docs.select("doc_id", "text").join(F.broadcast(own), "doc_id").groupBy("doc_id", "y").agg(F.max("text").alias("text"))  # n rows at most
    held = F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).over(W.orderBy(F.xxhash64("doc_id"), "doc_id"))
    return rows.withColumn("held", held).where(F.col("held") <= most).drop("held")


def fit(docs: DataFrame, labels: DataFrame, label: str, learnable: F.Column, n: int = SAMPLE, seed: int = 7) -> Model:
    """Hashed vectors and a softmax layer, by minibatch gradient descent in numpy over a bounded sample.

    Features are counted on the executors. Without rows of both labels every text gets the share of label 1 (half, if
    there are no rows).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = [], []
            for t in (x.as_py() for x in batch.column(2)):
                cache: dict[str, list[int]] = {}
                flat = [i for w in tokens(t) for i in (cache.get(w) or cache.setdefault(w, features(w)))]
                u, c = np.unique(np.array(flat, np.int32), return_counts=True)
                ids.append(u.astype("<u2").tobytes())
                counts.append((c / max(1, len(flat))).astype("<f4").tobytes())
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())], names=["doc_id", "y", "ids", "parts"])
        released()

    own = sample_of(docs, labels, label, learnable, n)
    scratch = Scratch(docs.sparkSession, "features")
    kept = scratch.keep(own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, y {own.schema['y'].dataType.simpleString()}, ids binary, parts binary"))
    rows = [(zlib.crc32(str(r["doc_id"]).encode()), r["ids"], r["parts"], int(r["y"] > 0)) for r in kept.toLocalIterator()]  # a part at a time
    scratch.drop(kept)
    rows.sort(key=lambda r: r[:2])
    y = np.array([r[3] for r in rows], np.int64)
    share = (y.sum() + 0.5) / (len(y) + 1)
    if not 0 < y.sum() < len(y):
        return Model(np.zeros(BUCKETS), math.log(share / (1 - share)))
    ids = [np.frombuffer(r[1], "<u2") for r in rows]
    parts = [np.frombuffer(r[2], "<f4") for r in rows]
    del rows
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1 / WIDTH, 1 / WIDTH, (WIDTH, BUCKETS)).astype(np.float64)
    out, bias = np.zeros((2, WIDTH)), np.array([math.log(1 - share), math.log(share)])
    out[1] = draw.uniform(-1, 1, WIDTH)
    steps, step = EPOCHS * math.ceil(len(y) / BATCH), 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(y))
        for k in range(0, len(y), BATCH):
            own_ = order[k : k + BATCH]
            flat, part = np.concatenate([ids[i] for i in own_]), np.concatenate([parts[i] for i in own_])
            row = np.repeat(np.arange(len(own_)), [len(ids[i]) for i in own_])
            hidden = np.array([np.bincount(row, v[flat] * part, len(own_)) for v in vectors])
            z = out @ hidden + bias[:, None]
            p = np.exp(z - z.max(axis=0))
            p /= p.sum(axis=0)
            p[y[own_], np.arange(len(own_))] -= 1
            rate = RATE * (1 - step / steps)
            back = out.T @ p
            out -= rate * (p @ hidden.T)
            bias -= rate / BATCH * p.sum(axis=1)
            for v, b in zip(vectors, back, strict=True):
                v -= rate * 20 * np.bincount(flat, b[row] * part, BUCKETS)
            step += 1
    del ids, parts
    released()
    return Model((out[1] - out[0]) @ vectors, float(bias[1] - bias[0]))


def scored(docs: DataFrame, model: Model, held_out: F.Column, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; null and empty texts have the score of the bias."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer()
        for batch in batches:
            scores = np.array(list(scorer.score(t.as_py() for t in batch.column(2))), np.float64)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= cut).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])
        del scorer
        released()

    return docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def fold(buckets: int, held: int) -> F.Column:
    """Whether a row is held out: by the crc32 of its id as text; rows without an id aren't."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % buckets == held, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, fit(docs, labels, "quality", ~fold(5, 0)), fold(5, 0))


def op8_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects (score under 0.3); the others stay as they are. No shuffle."""
    model = spark.sparkContext.broadcast(fit(docs, table(spark, sf_dir, "labels"), "quality", ~fold(5, 0)))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.value.scorer()
        for batch in batches:
            yield batch.filter(pa.array([s >= CUT for s in scorer.score(t.as_py() for t in batch.column(at))], pa.bool_()))
        del scorer
        released()

    return docs.mapInArrow(run, docs.schema)
