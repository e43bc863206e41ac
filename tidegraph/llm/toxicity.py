"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (3 to 5, with word bounds) and
itself, hashed into rows of an embedding table; a text is the average over its
words. Table and softmax are trained together in numpy on a bounded sample of
labelled rows, so a misspelling that was never seen shares most of its vectors
with the word it comes from. The model is linear once trained: each word adds
one number, which a worker computes once and remembers.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm.common import bounded_sample, kept, release, table, unused

#: Rows of the embedding table, and their width.
ROWS, WIDTH = 1 << 17, 8
#: The bound of the training sample: labelled rows of each class, and bytes of one text and of all.
PER_CLASS, MOST_BYTES, TOTAL_BYTES = 2000, 1 << 18, 64 << 20
#: The part of rows that no training sees: crc32 of the id as text, modulo 4, is this.
HELD_OUT = 2
THRESHOLD = 0.3
#: Words that one window averages.
WINDOW = 16
#: Words whose score a worker remembers.
REMEMBERED = 200_000

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def subwords(word: str) -> list[int]:
    """Rows of the table: all n-grams of the word, and the word itself."""
    marked = f"<{word}>".encode("utf-32-le")
    rows = [zlib.crc32(marked[i : i + 4 * n]) % ROWS for n in (3, 4, 5) for i in range(0, len(marked) - 4 * n + 1, 4)]
    rows.append(zlib.crc32(b"=" + word.encode()) % ROWS)
    return rows


@dataclass
class Model:
    #: What a row of the table adds to log p(toxic) - log p(not).
    weights: np.ndarray
    bias: float

    def word(self, word: str) -> float:
        return float(self.weights[subwords(word)].mean())


def strongest(scores: np.ndarray, width: int = WINDOW) -> tuple[int, float]:
    """Start and value of the run of width words with the largest average.

    A word counts once in each window that it is in, so a text that repeats
    one word isn't taken for a strong one; places beyond a short text's end are
    zero. Words are told apart by their scores.
    """
    if not len(scores):
        return 0, 0.0
    order = scores.argsort(kind="stable")
    before = np.full(len(scores), -1)
    again = scores[order[1:]] == scores[order[:-1]]
    before[order[1:][again]] = order[:-1][again]
    # a place counts in the windows that begin after the word's place before
    places, last = np.arange(len(scores)), max(0, len(scores) - width)
    first, end = np.maximum(np.maximum(before, places - width) + 1, 0), np.minimum(places, last) + 1
    counted = first < end
    changes = np.bincount(first[counted], weights=scores[counted], minlength=last + 2) - np.bincount(end[counted], weights=scores[counted], minlength=last + 2)
    averages = np.cumsum(changes)[: last + 1] / width
    at = int(averages.argmax())
    return at, float(averages[at])


class _Sample:
    """Texts as arrays of word numbers, and each word's rows of the table."""

    def __init__(self, texts: list[str]):
        numbers: dict[str, int] = {}
        self.docs = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in words_of(t)), np.int32) for t in texts]
        rows, sizes = array("i"), array("q")
        for word in numbers:
            own = subwords(word)
            rows.extend(own)
            sizes.append(len(own))
        self.sizes, self.rows = np.array(sizes), np.array(rows)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def bag(self, words: np.ndarray, places: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Rows and their shares in the average over the distinct words, or over so many places."""
        unique = np.unique(words)
        sizes = self.sizes[unique]
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        rows = self.rows[np.repeat(self.starts[unique], sizes) + within]
        return rows, np.repeat(1 / sizes / (places or len(unique)), sizes).astype(np.float32)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.add.reduceat(weights[self.rows], self.starts) / self.sizes


def train(texts: list[str], labels: list[int], *, toxic_share: float | None = None, whole_epochs: int = 3, epochs: int = 10, rate: float = 0.5, batch: int = 32, seed: int = 7) -> Model:
    """Fits table and softmax together by Adagrad, first on whole texts, then on each text's strongest window.

    A label holds for a text, and a few words among thousands decide it; so
    the later epochs take, of each text, the window that the model as it
    stands finds most toxic, and teach it the text's label. toxic_share is the
    share among all labelled rows, to which the bias is corrected where the
    sample is balanced.
    """
    dice = np.random.default_rng(seed)
    sample = _Sample(texts)
    kept = [i for i, words in enumerate(sample.docs) if len(words)]
    y = np.array(labels, np.int64)
    if len(set(y[kept].tolist())) < 2:
        return Model(np.zeros(ROWS, np.float32), 0.0 if not kept else (4.0 if y[kept[0]] else -4.0))
    table_ = dice.uniform(-0.1, 0.1, (ROWS, WIDTH)).astype(np.float32)
    out, bias = dice.normal(0, 1.0, (WIDTH, 2)).astype(np.float32), np.zeros(2, np.float32)
    past, past_out, past_bias = np.full(ROWS, 1e-6, np.float32), np.full_like(out, 1e-6), np.full_like(bias, 1e-6)
    windows: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    # a small sample is gone over more often
    whole_epochs = max(whole_epochs, min(40, 340 * batch // len(kept)))
    epochs = max(epochs, min(40, 600 * batch // len(kept)))
    for epoch in range(whole_epochs + epochs):
        if epoch >= whole_epochs:
            scores = sample.scores(table_ @ (out[:, 1] - out[:, 0]))
            for i in kept:
                at, _ = strongest(scores[sample.docs[i]])
                windows[i] = sample.bag(sample.docs[i][at : at + WINDOW], WINDOW)
        order = dice.permutation(kept)
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            bags = [windows[i] if windows else sample.bag(sample.docs[i]) for i in chosen]
            sizes = np.array([len(b[0]) for b in bags])
            rows, shares = np.concatenate([b[0] for b in bags]), np.concatenate([b[1] for b in bags])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            hidden = np.add.reduceat(table_[rows] * shares[:, None], starts, axis=0)
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(chosen)), y[chosen]] -= 1
            back = p @ out.T
            g_out, g_bias = hidden.T @ p, p.sum(axis=0)
            past_out += g_out**2
            past_bias += g_bias**2
            out -= rate * 0.2 * g_out / np.sqrt(past_out)
            bias -= rate * 2 * g_bias / np.sqrt(past_bias)
            unique, where = np.unique(rows, return_inverse=True)
            step = np.repeat(back, sizes, axis=0) * shares[:, None]
            summed = np.stack([np.bincount(where, weights=step[:, k], minlength=len(unique)) for k in range(WIDTH)], axis=1).astype(np.float32)
            past[unique] += (summed**2).mean(axis=1)
            table_[unique] -= rate * summed / np.sqrt(past[unique])[:, None]
    log_odds = float(bias[1] - bias[0])
    if toxic_share is not None and 0 < toxic_share < 1:
        here = float(y[kept].mean())
        log_odds += float(np.log(toxic_share / (1 - toxic_share)) - np.log(here / (1 - here)))
    return Model(table_ @ (out[:, 1] - out[:, 0]), log_odds)


class Scorer:
    """Scores texts and remembers each word's part."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def _learn(self, words: list[str]) -> None:
        own = [subwords(w) for w in words]
        sizes = np.array([len(x) for x in own])
        sums = np.add.reduceat(self.model.weights[np.concatenate([np.array(x) for x in own])], np.cumsum(sizes) - sizes)
        self.known.update(zip(words, (sums / sizes).tolist(), strict=True))

    def __call__(self, text: str) -> float:
        words = words_of(text)
        new = set(words).difference(self.known)
        if new:
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
                new = set(words)
            self._learn(sorted(new))
        value = self.model.bias + strongest(np.fromiter(map(self.known.__getitem__, words), np.float64, len(words)))[1]
        return float(1 / (1 + np.exp(-min(max(value, -500), 500))))


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == HELD_OUT


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS, most_bytes: int = MOST_BYTES, total_bytes: int = TOTAL_BYTES, **options) -> Model:
    """Trains on at most per_class labelled rows of each class, none of them held out.

    The sample is the first rows by a hash of the id. A document with several
    labels has the largest; null labels and texts of over most_bytes are left
    out, and the sample ends where its texts have total_bytes. Without labels
    of both classes all scores are alike.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).where("_id IS NOT NULL AND _y IS NOT NULL")
    known = known.where(~held_out("_id")).groupBy("_id").agg(F.max("_y").alias("_y"))
    share = known.agg(F.avg((F.col("_y") > 0).cast("double"))).first()[0]
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(F.octet_length("_text") <= most_bytes)
    first = lambda d: d.orderBy(F.xxhash64("_id"), "_id").limit(per_class)
    # at most 2 x per_class ids, so the small side is bounded
    wanted = F.broadcast(first(known.where("_y > 0")).unionByName(first(known.where("_y <= 0"))))
    taken = texts.join(wanted, "_id").groupBy(F.xxhash64("_id").alias("_key")).agg(F.max("_y").alias("_y"), F.max(F.octet_length("_text")).alias("_bytes"))
    rows = bounded_sample(texts.select(F.xxhash64("_id").alias("_key"), "_text"), taken, "_key", "_text", total_bytes)
    return train(rows["_text"].tolist(), [int(y > 0) for y in rows["_y"]], toxic_share=share, **options)


def scorer_of(model: Model) -> Scorer:
    """This worker's scorer of a model, whose memory lasts over its tasks; one of another model takes its place."""
    name = hashlib.sha256(model.weights.tobytes() + struct.pack("<d", model.bias)).hexdigest()
    return kept(("toxicity", name), lambda: Scorer(model))


def score(docs: DataFrame, model: Model, *, into: str, text_col: str = "text") -> DataFrame:
    """docs with a column into added, by an Arrow function over whole texts; null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(model)
        for batch in batches:
            texts = batch.column(text_col).cast(pa.binary())
            scores = [scorer((x.as_py() or b"").decode("utf-8", "replace")) for x in texts]
            yield batch.append_column(into, pa.array(scores, pa.float64()))
        release()

    return docs.mapInArrow(run, docs.withColumn(into, F.lit(0.0)).schema)


def toxicity(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """For every row: id, held_out, score in 0..1, predicted (1 if score >= threshold).

    Only the text enters a score. A null or empty text has the score of no
    words. A null id is not held out unless the empty string's crc32 says so.
    Repeated rows are scored each; an empty table gives no rows. Whole texts
    count, however long; other columns, whatever their names, are not read.
    """
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    scored = score(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), model, into="_score", text_col="_text")
    return scored.select(F.col("_id").alias(id_col), held_out("_id").alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, text_col: str = "text", **options) -> DataFrame:
    """The rows that score below threshold, with all their columns, whatever their names.

    A null or empty text has the score of no words; repeated rows stay or go
    together, since only the text enters a score; an empty table stays empty.
    Whole texts count, however long.
    """
    model, name = fit(docs, labels, text_col=text_col, **options), unused(docs, "_score")
    return score(docs, model, into=name, text_col=text_col).where(F.col(name) < threshold).drop(name)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
