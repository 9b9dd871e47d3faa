"""Toxicity by multiple-instance learning.

A document is a bag of n sentences. A sentence s has the score p(s) = sigmoid(bias - log n + sum of the
weights of its words), a document the noisy-or 1 - prod(1 - p(s)): it is toxic if any of its sentences
is. The log n makes a sentence of a long document the less likely an offender, so that what n harmless
sentences add up to doesn't grow with n. A word's weight is the sum of those of its features: the word
itself and its first three to six letters, as many as it has (inflected forms share them). Weights are
learned from document labels alone, through this noisy-or, by gradient steps with an L1 penalty; the
sentence scores then tell which sentences offend.

Learning uses a bounded sample of labelled documents (``sample_docs`` at most, in hash order of their
identifier, texts of at most ``sample_bytes`` each and ``total_bytes`` together) on the driver. Scoring is
one pass over the rows without a shuffle; the model (at most ``max_features`` weights) goes along.

Cases: null and empty texts have no sentence; they score the ``empty`` rate, the share of toxic
ones among sampled texts without words (0 if there is none). Rows without identifier are never
held out. Labels that are null are ignored, of repeated labels the highest holds. Without any
label every score is 0. A text of any length is scored whole, one sentence's words at a time. Repeated
rows each get their row; an empty table gives none; other columns are ignored, or kept by
``remove_toxic``, whatever their names.
"""

from __future__ import annotations

import math
import re
import uuid
from array import array
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import ALNUM_TABLE, materialize, worker_state

SAMPLE_DOCS = 8_000
SAMPLE_BYTES = 1 << 18
TOTAL_BYTES = 32 << 20
MAX_FEATURES = 100_000
MIN_DOCS = 4
BIAS = -4.0
FOLDS = 5
ENDS = re.compile(rb"[.!?\n]+")


def features(word: bytes) -> list[bytes]:
    """The word, and marked prefixes of 3 to 6 code points that are shorter than it."""
    letters = word.decode(errors="replace")
    return [word, *(b"^" + letters[:n].encode() for n in range(3, 7) if n < len(letters))]


class WordWeights(dict):
    """Sums of weights by word, filled as words come; bounded."""

    def __init__(self, weights: dict[bytes, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: bytes) -> float:
        if len(self) >= 200_000:
            self.clear()
        self[word] = total = sum(self.weights.get(f, 0.0) for f in features(word))
        return total


@dataclass
class Model:
    bias: float
    weights: dict[bytes, float]
    empty: float
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def words(self) -> WordWeights:
        return worker_state(("toxicity", self.name), lambda: WordWeights(self.weights))

    def sentence_rates(self, text: str | None) -> list[tuple[int, float]]:
        """(number in the text, -log(1 - p)) of each sentence that has words."""
        bags = [(k, words) for k, s in enumerate(sentences(text)) if (words := s.split())]
        weight, base = self.words().__getitem__, self.bias - math.log(max(1, len(bags)))
        return [(k, softplus(base + sum(map(weight, words)))) for k, words in bags]

    def score(self, text: str | None) -> float:
        rates = self.sentence_rates(text)
        return float(-np.expm1(-sum(r for _, r in rates))) if rates else self.empty


def softplus(z: float) -> float:
    """log(1 + e**z)."""
    return z + math.log1p(math.exp(-z)) if z > 0 else math.log1p(math.exp(z)) if z > -40 else 0.0


def sentences(text: str | None) -> list[bytes]:
    return [s.translate(ALNUM_TABLE) for s in ENDS.split((text or "").encode())]


def held_out(id_col):
    """crc32 of the identifier as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES, total_bytes: int = TOTAL_BYTES) -> list[tuple[str, int]]:
    """(text, label) of the labelled documents to learn from; never of one that is held out."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.octet_length("text") <= sample_bytes)
    rows = texts.join(F.broadcast(known), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(sample_docs)  # at most sample_docs rows are broadcast
    rows = materialize(rows.withColumn("at", F.monotonically_increasing_id()), "toxicity-sample")
    room = 0
    for sizes in rows.select("at", F.octet_length("text").alias("n")).orderBy("at").collect():  # sample_docs numbers
        total_bytes -= sizes.n
        if total_bytes < 0:
            break
        room = sizes.at + 1
    found = rows.where(F.col("at") < room).orderBy("at").select("text", "toxic").toArrow()
    return list(zip(found.column(0).to_pylist(), found.column(1).to_pylist()))


def train(rows: list[tuple[str, int]], max_features: int = MAX_FEATURES, min_docs: int = MIN_DOCS, steps: int = 120, rate: float = 0.5, penalty: float = 0.5) -> Model:
    """Fit on (text, label) rows; the order of rows doesn't matter but for rounding."""
    # One text at a time becomes numbers: of each word its number and sentence, of each sentence its bag.
    words: dict[bytes, int] = {}
    word, sentence, of_bag, n = array("i"), array("i"), array("i"), 0
    bag_labels, blank = [], []
    prior = array("d")
    seen = array("i")  # documents that hold a word, as one entry for each document and word
    for text, label in rows:
        bag = [w for s in sentences(text) if (w := s.split())]
        if not bag:
            blank.append(label)
            continue
        start = len(word)
        for s in bag:
            word.extend([words.setdefault(w, len(words)) for w in s])
            sentence.extend([n] * len(s))
            of_bag.append(len(bag_labels))
            n += 1
        seen.extend(set(word[start:]))
        bag_labels.append(label)
        prior.extend([-math.log(len(bag))] * len(bag))
    empty = float(np.mean(blank)) if blank else 0.0
    if not bag_labels:
        return Model(-50.0, {}, empty)
    # A feature counts the documents of its words, added up; rare ones and those beyond the limit go.
    counts = np.bincount(np.frombuffer(seen, dtype=np.int32), minlength=len(words))
    df: dict[bytes, int] = {}
    for w, i in words.items():
        for f in features(w):
            df[f] = df.get(f, 0) + int(counts[i])
    kept = sorted((f for f, c in df.items() if c >= min_docs), key=lambda f: (-df[f], f))[:max_features]
    del df
    number = {f: i for i, f in enumerate(kept)}
    of_word, feature = array("i"), array("i")
    for w, i in words.items():
        own = [number[f] for f in features(w) if f in number]
        feature.extend(own)
        of_word.extend([i] * len(own))
    word, sentence, of_bag, of_word, feature = (np.frombuffer(x, dtype=np.int32) for x in (word, sentence, of_bag, of_word, feature))
    prior = np.frombuffer(prior, dtype=np.float64)
    y, bags = np.array(bag_labels, dtype=np.float64), len(bag_labels)
    weights, bias = np.zeros(len(kept)), BIAS
    squares, bias_squares = np.full(len(kept), 1e-6), 1e-6
    for _ in range(steps):
        by_word = np.bincount(of_word, weights=weights[feature], minlength=len(words))
        z = np.clip(bias + prior + np.bincount(sentence, weights=by_word[word], minlength=n), -40, 40)
        p = 1 / (1 + np.exp(-z))
        total = np.bincount(of_bag, weights=np.logaddexp(0, z), minlength=bags)
        ratio = np.where(y > 0, np.exp(-total) / np.maximum(-np.expm1(-total), 1e-12), -1.0)
        pull = p * ratio[of_bag]
        by_word = np.bincount(word, weights=pull[sentence], minlength=len(words))
        gradient = np.bincount(feature, weights=by_word[of_word], minlength=len(kept))
        squares += gradient**2
        step = rate / np.sqrt(squares)
        weights += step * gradient
        weights = np.sign(weights) * np.maximum(np.abs(weights) - step * penalty, 0)
        g = pull.sum()
        bias_squares += g * g
        bias += rate * g / np.sqrt(bias_squares)
    return Model(float(bias), {w: float(v) for w, v in zip(kept, weights) if v}, empty)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # max_features entries at most

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            scores = np.array([shared.value.score(t) for t in batch.column(1).to_pylist()], dtype=np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def locate(docs: DataFrame, model: Model, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The offending sentences: doc_id, sentence (number in the text), text, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = [(k, -math.expm1(-rate)) for k, rate in shared.value.sentence_rates(text)]
                whole = ENDS.split((text or "").encode()) if any(p >= threshold for _, p in found) else []
                rows += [(doc_id, k, whole[k].decode().strip(), p) for k, p in found if p >= threshold]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.string(), pa.float64()))], ["doc_id", "sentence", "text", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, sentence int, text string, score double")


def remove_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score under 0.5."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            yield batch.filter(pa.array([shared.value.score(t) < 0.5 for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
