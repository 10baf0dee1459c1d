"""Quality scores: random-indexing word vectors pooled per document, a two-layer network, calibrated probabilities.

A word's index vector is sparse and comes from a hash of the word; its context vector is the sum of the index vectors
of the words around it, over all documents.  A document is the mean of both vectors over its words.  A network of one
hidden layer, trained here with numpy on labelled documents, gives a logit; a temperature fitted on documents that the
training did not see turns it into a probability.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclewise.llm.common import bound_batches, crc_fold, cut_lineage, passes

#: Labelled documents that vocabulary and network are fitted on, at most, in the order of a hash of their ids.
SAMPLE_DOCS = 10_000
#: Share of the sampled documents that a word of the vocabulary is in.
MIN_SHARE = 0.01
#: Length of index and context vectors, and how many entries of an index vector are not 0.
DIM, NONZERO = 64, 4
#: Words to either side that are a word's context.
WINDOW = 2
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 128, 3e-3, 1e-4
#: Share of the sample that the temperature is fitted on.
CALIBRATION = 0.2

_TOKENS = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
#: Classes of tokens outside the vocabulary, by their form, and the token that equals the one before.
CLASSES = ["<rare>", "<upper>", "<number>", "<sign>", "<same>"]


def _kind(token: str) -> str:
    if token[0].isalpha():
        return "<upper>" if len(token) > 2 and token.isupper() else token.lower()
    return "<number>" if token.isdecimal() else token


def _class_of(word: str) -> str:
    return "<rare>" if word[0].isalpha() else "<sign>"


def index_vectors(words: list[str], dim: int = DIM, nonzero: int = NONZERO) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of each word's index vector, from hashes of the word."""
    h = np.array([[xxhash.xxh64_intdigest(w, seed=k) for k in range(nonzero)] for w in words], np.uint64).reshape(-1, nonzero)
    return (h >> np.uint64(1)).astype(np.int64) % dim, np.where(h & np.uint64(1), 1, -1)


class Reader:
    """Cuts texts into vocabulary numbers; the classes come first, documents are kept apart by -1."""

    def __init__(self, words: list[str]):
        self.words = words
        self.number = {w: k for k, w in enumerate(words)}

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all texts' tokens, ``WINDOW`` times -1 behind each text, and the owner of each place."""
        lists = [_TOKENS.findall(t) for t in texts]
        sizes = np.array([len(x) for x in lists], np.int64)
        codes, unique = pd.factorize(np.array([t for x in lists for t in x] + [None], object)[:-1])
        kinds = [_kind(t) for t in unique]
        names, tokens = pd.factorize(np.array([*kinds, None], object)[:-1])
        numbers = np.array([self.number[k if k in self.number else _class_of(k)] for k in tokens], np.int64)
        word = np.array([k[0].isalpha() or k[0] == "<" for k in kinds], bool)
        at = np.arange(len(codes)) + np.repeat(WINDOW * np.arange(len(texts)), sizes)
        out = np.full(len(codes) + WINDOW * len(texts), -1, np.int64)
        if len(codes):
            out[at] = numbers[names[codes]]
            # the same word again, whatever stands between the two but for words
            spoken = np.flatnonzero(word[codes])
            again = spoken[1:][(codes[spoken][1:] == codes[spoken][:-1])]
            owner = np.repeat(np.arange(len(texts)), sizes)
            before = spoken[:-1][(codes[spoken][1:] == codes[spoken][:-1])]
            out[at[again[owner[again] == owner[before]]]] = self.number["<same>"]
        return out, np.repeat(np.arange(len(texts)), sizes + WINDOW)


def _document_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents each word is in, summed over the task."""
    held: dict[str, int] = {}
    for pdf in batches:
        for text in pdf["text"]:
            for w in {_kind(t) for t in set(_TOKENS.findall(text))}:
                held[w] = held.get(w, 0) + 1
        if len(held) > 300_000:
            yield pd.DataFrame({"word": list(held), "n": list(held.values())})
            held = {}
    if held:
        yield pd.DataFrame({"word": list(held), "n": list(held.values())})


def vocabulary(sample: DataFrame, size: int, share: float = MIN_SHARE) -> list[str]:
    """The classes and the words in at least ``share`` of the sample's texts, so at most their mean number of words / share."""
    words = sample.select("text").mapInPandas(_document_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    kept = words.filter(F.col("n") >= max(2, share * size)).orderBy("word").collect()
    return [*CLASSES, *[r["word"] for r in kept if r["word"] not in CLASSES]]


def context_sums(docs: DataFrame, words: list[str]) -> np.ndarray:
    """Sum of the index vectors around each word of the vocabulary over all documents: whole numbers, so that
    no order of adding changes them.  One row per word and task is shuffled."""
    held = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(held.value)
        place, sign = index_vectors(held.value)
        total = np.zeros(len(held.value) * DIM)
        for pdf in passes(batches, "text"):
            numbers, _ = reader.read(pdf["text"].tolist())
            for k in range(1, WINDOW + 1):
                both = (numbers[:-k] >= 0) & (numbers[k:] >= 0)
                # the places between are the same document's: WINDOW separators part two documents
                left, right = numbers[:-k][both], numbers[k:][both]
                for of, around in ((left, right), (right, left)):
                    total += np.bincount((of[:, None] * DIM + place[around]).ravel(), sign[around].ravel(), len(total))
        sums = total.reshape(-1, DIM)
        seen = np.flatnonzero(np.abs(sums).any(axis=1))
        yield pd.DataFrame({"word": seen, "sums": pd.Series(list(sums[seen]), dtype=object)})

    rows = docs.select("text").mapInPandas(run, "word int, sums array<double>")
    rows = rows.groupBy("word").agg(*[F.sum(F.col("sums")[k]).alias(f"d{k}") for k in range(DIM)]).collect()
    out = np.zeros((len(words), DIM))
    for r in rows:
        out[r["word"]] = r[1:]
    return out


def word_vectors(words: list[str], sums: np.ndarray) -> np.ndarray:
    """Index vector and context vector of each word, both of length 1 (0 for a word that stands alone everywhere)."""
    place, sign = index_vectors(words)
    index = np.zeros((len(words), DIM))
    for k in range(NONZERO):
        np.add.at(index, (np.arange(len(words)), place[:, k]), sign[:, k])
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    return np.hstack([unit(index), unit(sums)])


#: Places of the table (documents x vocabulary) that is counted at once.
COUNTED = 1 << 21


def pooled(texts: list[str], reader: Reader, vectors: np.ndarray) -> np.ndarray:
    """For each text the mean of its words' vectors, and the logarithm of their number."""
    numbers, owner = reader.read(texts)
    real = numbers >= 0
    numbers, owner = numbers[real], owner[real]
    size, block = len(reader.words), max(1, COUNTED // len(reader.words))
    out = np.zeros((len(texts), vectors.shape[1] + 1), np.float32)
    for lo in range(0, len(texts), block):
        hi = min(lo + block, len(texts))
        a, b = np.searchsorted(owner, (lo, hi))
        counts = np.bincount((owner[a:b] - lo) * size + numbers[a:b], minlength=(hi - lo) * size).reshape(hi - lo, size)
        total = counts.sum(axis=1)
        out[lo:hi, :-1] = counts @ vectors / np.maximum(total, 1)[:, None]
        out[lo:hi, -1] = np.log1p(total)
    return out


def on_pooled(docs: DataFrame, words: list[str], vectors: np.ndarray, make, schema: str) -> DataFrame:
    """``doc_id`` and the columns that ``make`` gives for the pooled vectors of a batch of texts."""
    sent = docs.sparkSession.sparkContext.broadcast((words, vectors))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, table = sent.value
        reader = Reader(names)
        for pdf in passes(batches, "text"):
            yield pd.DataFrame({"doc_id": pdf["doc_id"], **make(pooled(pdf["text"].tolist(), reader, table))})

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id string, {schema}")


@dataclass
class Network:
    """Standardised input, tanh layer, logit; the score is the logistic function of logit / temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def loss_and_gradient(net: Network, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy and its gradients by w1, b1, w2, b2."""
    z = (x - net.mean) / net.scale
    hidden = np.tanh(z @ net.w1 + net.b1)
    logit = hidden @ net.w2 + net.b2
    loss = float(np.mean(np.logaddexp(0, logit) - y * logit))
    out = (1 / (1 + np.exp(-np.clip(logit, -500, 500))) - y) / len(y)
    inner = np.outer(out, net.w2) * (1 - hidden**2)
    return loss, [z.T @ inner, inner.sum(axis=0), hidden.T @ out, np.array(out.sum())]


def train(x: np.ndarray, y: np.ndarray, seed: int = 0) -> Network:
    """Adam on the first part of the rows, the temperature by least cross entropy on the rest.

    With no row, or one label alone, the score is the share of that label (0.5 with no row).
    """
    rng = np.random.default_rng(seed)
    dim = x.shape[1]
    cut = len(x) - int(CALIBRATION * len(x))
    net = Network(np.zeros(dim), np.ones(dim), rng.normal(0, dim**-0.5, (dim, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), 0.0)
    if len(np.unique(y)) < 2:
        net.w2 = np.zeros(HIDDEN)
        net.b2 = 0.0 if not len(y) else 6.0 if y[0] else -6.0
        return net
    net.mean, net.scale = x[:cut].mean(axis=0), np.maximum(x[:cut].std(axis=0), 1e-3)
    moment = [[np.zeros_like(p), np.zeros_like(p)] for p in (net.w1, net.b1, net.w2, np.array(0.0))]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(cut)
        for at in range(0, cut, BATCH):
            pick = order[at : at + BATCH]
            step += 1
            params = [net.w1, net.b1, net.w2, np.array(net.b2)]
            made = []
            for p, g, m in zip(params, loss_and_gradient(net, x[pick], y[pick])[1], moment, strict=True):
                g = g + DECAY * p
                m[0] = 0.9 * m[0] + 0.1 * g
                m[1] = 0.999 * m[1] + 0.001 * g * g
                made.append(p - RATE * m[0] / (1 - 0.9**step) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8))
            net.w1, net.b1, net.w2, net.b2 = made[0], made[1], made[2], float(made[3])
    if cut < len(x):
        net.temperature = temperature(net.logits(x[cut:]), y[cut:])
    return net


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least cross entropy, by golden section on its logarithm between 1/20 and 20."""
    loss = lambda t: float(np.mean(np.logaddexp(0, logits / np.exp(t)) - y * logits / np.exp(t)))
    lo, hi, ratio = -np.log(20), np.log(20), (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def learn_and_score(docs: DataFrame, labels: DataFrame, held_out_fold: int = 2, folds: int = 4, threshold: float = 0.7) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``.

    Learns from labels outside one crc32 fold of the ids, from ``SAMPLE_DOCS`` documents at most; word vectors are of
    all documents.  Null texts count as empty; texts without tokens have the score of an empty one.  Repeated rows are
    scored each; labels that are null, or of no document, are left out; a null id is in the fold of the empty text.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    known = labels.filter((crc_fold(F.col("doc_id"), folds) != held_out_fold) & F.col("quality").isNotNull())
    known = known.select(F.col("doc_id").cast("string").alias("_id"), F.col("quality").cast("int").alias("label"))
    ids = known.filter(F.col("_id").isNotNull()).groupBy("_id").agg(F.max("label").alias("label"))
    ids = cut_lineage(ids.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE_DOCS), "quality-ids")
    # one text of an id: that with the smallest hash, where ids are taken twice
    sample = rows.join(ids, F.col("doc_id") == F.col("_id")).groupBy("doc_id").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.first("label").alias("label"))
    sample = cut_lineage(sample.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id"), "quality-sample")
    words = vocabulary(sample, sample.count())
    vectors = word_vectors(words, context_sums(rows, words))
    fitted = on_pooled(sample, words, vectors, lambda x: {"x": pd.Series(list(x), dtype=object)}, "x array<float>")
    fitted = fitted.join(ids, F.col("doc_id") == F.col("_id")).select("doc_id", "x", "label").toPandas()
    # in the order of a hash, so that the last part is as good as drawn
    fitted = fitted.sort_values("doc_id", key=lambda c: [(xxhash.xxh64_intdigest(d), d) for d in c]) if len(fitted) else fitted
    net = train(np.array(fitted["x"].tolist(), float).reshape(-1, 2 * DIM + 1), fitted["label"].to_numpy(float))
    sent = spark.sparkContext.broadcast(net)
    scored = on_pooled(rows, words, vectors, lambda x: {"score": sent.value.score(x.astype(float))}, "score double")
    return scored.select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), (crc_fold(F.col("doc_id"), folds) == held_out_fold).alias("held_out"),
        "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
