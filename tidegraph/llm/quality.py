"""Quality classifier from a weak-label model.

Heuristic labellers vote good, bad or nothing on each document, each by one
kind of evidence of its own, so they overlap and contradict one another.
Expectation-maximisation estimates how often each one casts each vote on good
and on bad documents, and the share of good ones, from votes alone. Equal vote
patterns have equal posteriors, so EM runs on counts of patterns, of which
there are at most 3 to the number of labellers, whatever the corpus. The
posteriors of a sample train a linear scorer over hashed words, word shapes and
pairs of neighbours, and the scorer decides which documents are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm.common import bounded_sample, content, materialise, release, table

BAD, NONE, GOOD = -1, 0, 1
#: Rows of the scorer's weight table.
ROWS = 1 << 17
#: The bound of the scorer's training sample, in documents and in bytes of one text and of all.
SAMPLE, MOST_BYTES, TOTAL_BYTES = 4000, 1 << 18, 32 << 20
THRESHOLD = 0.5

#: What is counted of each text; words, and characters without white space.
COUNTS = ("words", "characters", "signs", "capitals", "digits", "separators", "stops", "repeats", "distinct")


def labellers() -> dict[str, Column]:
    """Votes over the columns of COUNTS: 1 good, -1 bad, 0 none.

    For each kind of junk there is one that only votes bad, and one that votes
    on the same evidence by another bound, and good without it. On most junk
    these two stand against the good votes of all others.
    """
    words, characters = F.greatest(F.col("words"), F.lit(1)), F.greatest(F.col("characters"), F.lit(1))
    share = lambda name, of: F.col(name) / of
    some, many = F.col("words") > 4, F.col("words") >= 20
    letters, per_stop = characters / words, words / F.greatest(F.col("stops"), F.lit(1))
    bad = lambda when: F.when(when, BAD).otherwise(NONE)
    vote = lambda wrong, right: F.when(wrong, BAD).when(right, GOOD).otherwise(NONE)
    return {
        "signs": bad(share("signs", characters) > 0.03),
        "capitals": bad(some & (share("capitals", characters) > 0.3)),
        "separators": bad(some & (share("separators", words) > 0.1)),
        "repetition": bad(some & (share("repeats", words) > 0.1)),
        "word_length": bad((F.col("words") < 1) | some & ((letters > 20) | (letters < 2))),
        "sentences": vote(many & ((F.col("stops") == 0) | (per_stop > 100)), per_stop.between(2, 40)),
        "plain": vote(share("signs", characters) > 0.06, share("signs", characters) < 0.005),
        "small_letters": vote(some & (share("capitals", characters) > 0.25), share("capitals", characters).between(0.001, 0.12)),
        "worded": vote(some & (share("separators", words) > 0.06), some & (share("separators", words) < 0.01)),
        "variety": vote(many & (share("distinct", words) < 0.2), many & share("distinct", words).between(0.3, 0.98)),
    }


_PLAIN_SIGNS, _ENDS, _AFTER_END = frozenset(".,;:!?'\"()-"), frozenset(".!?"), frozenset("\"')")
_WHITE, _ALNUM, _UPPER, _DIGIT, _SIGN, _END, _QUOTE = (1 << i for i in range(7))
#: Code points that are looked up; those beyond count as signs.
_KNOWN = 1 << 16
_MIX, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _kind_of(c: str) -> int:
    if c in " \t\n\r\x0b\x0c":
        return _WHITE
    kind = _ALNUM * c.isalnum() | _UPPER * (c.isalnum() and c.isupper()) | _DIGIT * c.isdigit()
    return kind | _SIGN * (not c.isalnum() and c not in _PLAIN_SIGNS) | _END * (c in _ENDS) | _QUOTE * (c in _AFTER_END)


def _shape_of(code: int) -> int:
    return 97 if 97 <= code <= 122 or code >= 128 else 65 if 65 <= code <= 90 else 48 if 48 <= code <= 57 else code


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each code point: what it is, its small letter, its part in a shape; and weights by place."""
    kinds = np.array([*(_kind_of(chr(c)) for c in range(_KNOWN)), _SIGN], np.uint8)
    lower = np.array([*(ord(x) if len(x := chr(c).lower()) == 1 else c for c in range(_KNOWN)), _KNOWN], np.uint64)
    shapes = np.array([*map(_shape_of, range(_KNOWN)), 97], np.uint64)
    places = np.random.default_rng(5).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return kinds, lower, shapes, places


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(1)) * _MIX
    return (x ^ x >> np.uint64(32)) * _MIX2


def _row(hashed: np.ndarray) -> np.ndarray:
    return ((hashed ^ hashed >> np.uint64(29)) * _MIX >> np.uint64(64 - (ROWS - 1).bit_length())).astype(np.int64)


_NO_WORDS = np.empty(0, np.uint64)


def analysed(text: bytes) -> tuple[list[int], np.ndarray, np.ndarray]:
    """COUNTS of a text, and of each word in order hashes of it in small letters and of its shape.

    All characters are looked at at once, so a text costs the same whether its
    words were met before or not. In a shape, runs of one kind of character
    are one. Words come again whatever their case.
    """
    kinds, lower, shapes, places = _tables()
    codes = np.minimum(np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32), _KNOWN)
    kind = kinds[codes]
    inside = kind != _WHITE
    codes, kind = codes[inside], kind[inside]
    if not len(codes):
        return [0] * len(COUNTS), _NO_WORDS, _NO_WORDS
    edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
    lengths = np.flatnonzero(edges < 0) - np.flatnonzero(edges > 0)
    starts = np.cumsum(lengths) - lengths
    known = np.add.reduceat((kind & _ALNUM) > 0, starts, dtype=np.int64) > 0
    last = starts + lengths - 1
    while (quoted := ((kind[last] & _QUOTE) > 0) & (last > starts)).any():
        last = last - quoted
    stops = ((kind[last] & _END) > 0) & known
    place = np.arange(len(codes)) - np.repeat(starts, lengths)
    words = np.add.reduceat(_mixed(lower[codes]) * places[place & 63], starts) + lengths.astype(np.uint64)
    shape = shapes[codes]
    begins = np.append(True, shape[1:] != shape[:-1])
    begins[starts] = True
    runs = np.flatnonzero(begins)
    first = np.searchsorted(runs, starts)
    several = (np.diff(np.append(runs, len(codes))) > 1).astype(np.uint64)
    number = np.arange(len(runs)) - np.repeat(first, np.diff(np.append(first, len(runs))))
    shaped = np.add.reduceat(_mixed(shape[runs] * np.uint64(2) + several) * places[number & 63], first)
    count = lambda bit: int(np.count_nonzero(kind & bit))
    totals = [len(lengths), len(codes), count(_SIGN), count(_UPPER), count(_DIGIT), int((~known).sum()), int(stops.sum()), int((words[1:] == words[:-1]).sum()), len(np.unique(words))]
    return totals, words, shaped


def rows_of(words: np.ndarray, shapes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the weight table: of each word and its shape; of each pair of words, and of their shapes with whether words come again."""
    again = (words[1:] == words[:-1]).astype(np.uint64)
    again[1:] += np.uint64(2) * (words[2:] == words[:-2]).astype(np.uint64)
    pairs = np.concatenate([_row(words[:-1] * np.uint64(3) + words[1:]), _row(shapes[:-1] * np.uint64(5) + shapes[1:] * np.uint64(7) + again)])
    return np.concatenate([_row(words), _row(shapes)]), pairs


@dataclass
class LabelModel:
    """P(vote | class) of each labeller, and the share of good documents."""

    names: list[str]
    #: labeller, class (bad, good), vote (-1, 0, 1)
    table: np.ndarray
    good: float

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        logs = np.log(np.array([1 - self.good, self.good]))[None, :] + sum(np.log(self.table[i][:, votes[:, i] + 1]).T for i in range(len(self.names)))
        logs -= logs.max(axis=1, keepdims=True)
        p = np.exp(logs)
        return p[:, 1] / p.sum(axis=1)

    def accuracies(self) -> dict[str, float]:
        """How often a labeller that votes is right."""
        share = np.array([1 - self.good, self.good])
        right = self.table[:, 0, 0] * share[0] + self.table[:, 1, 2] * share[1]
        voting = ((self.table[:, :, 0] + self.table[:, :, 2]) * share).sum(axis=1)
        return dict(zip(self.names, (right / np.maximum(voting, 1e-12)).round(6).tolist(), strict=True))


#: Where EM starts, for every labeller: a bad vote is rare on good documents, a good one common on both.
START = ((0.3, 0.2, 0.5), (0.005, 0.195, 0.8))


def expectation_maximisation(names: list[str], votes: np.ndarray, counts: np.ndarray, *, rounds: int = 200, good: float = 0.8, smoothing: float = 0.5, tolerance: float = 1e-9) -> LabelModel:
    """From distinct vote patterns and their counts.

    A labeller that casts votes of both kinds is as likely to be silent on
    good documents as on bad ones, so its silence says nothing. That of one
    which only ever votes bad is its way to vote good.
    """
    both = [bool(counts[votes[:, i] == GOOD].sum() and counts[votes[:, i] == BAD].sum()) or not counts[votes[:, i] == BAD].sum() for i in range(len(names))]
    model = LabelModel(names, np.repeat(np.array(START)[None], len(names), axis=0), good)
    if not counts.sum():
        return model
    for _ in range(rounds):
        p = model.posterior(votes)
        weights = np.stack([(1 - p) * counts, p * counts])
        tables = np.stack([[[weights[c][votes[:, i] == v].sum() for v in (-1, 0, 1)] for c in (0, 1)] for i in range(len(names))]) + smoothing
        # a class must not swap sides: the prior votes lean to it by one row each
        tables[:, 0, 0] += smoothing
        tables[:, 1, 2] += smoothing
        tables /= tables.sum(axis=2, keepdims=True)
        silent = np.array([counts[votes[:, i] == NONE].sum() + smoothing for i in range(len(names))]) / (counts.sum() + 2 * smoothing)
        for i in np.flatnonzero(both):
            tables[i, :, 1] = silent[i]
            tables[i][:, [0, 2]] *= (1 - silent[i]) / tables[i][:, [0, 2]].sum(axis=1, keepdims=True)
        share = float(np.clip((p * counts).sum() / counts.sum(), 1e-4, 1 - 1e-4))
        moved = max(np.abs(tables - model.table).max(), abs(share - model.good))
        model = LabelModel(names, tables, share)
        if moved < tolerance:
            break
    return model


@dataclass
class Scorer:
    """A linear scorer: the mean weight of a text's words and shapes, and that of its pairs."""

    weights: np.ndarray
    bias: float

    def __call__(self, words: np.ndarray, shapes: np.ndarray) -> float:
        """In 0..1, of hashes by analysed(); a text without words has 0."""
        if not len(words):
            return 0.0
        single, pairs = rows_of(words, shapes)
        z = self.bias + self.weights[single].sum(dtype=np.float64) / len(words) + (self.weights[pairs].sum(dtype=np.float64) / (len(words) - 1) if len(pairs) else 0.0)
        return float(1 / (1 + np.exp(-min(max(z, -500), 500))))


def train(texts: list[bytes], targets: np.ndarray, *, epochs: int = 8, rate: float = 0.5, decay: float = 1e-5, seed: int = 3) -> Scorer:
    """Logistic regression on soft targets by Adagrad; texts without words are left out."""
    rows, kept = [], []
    for text, target in zip(texts, targets, strict=True):
        _, words, shapes = analysed(text)
        if not len(words):
            continue
        single, pairs = rows_of(words, shapes)
        index, where = np.unique(np.concatenate([single, pairs]), return_inverse=True)
        shares = np.concatenate([np.full(len(single), 1 / len(words)), np.full(len(pairs), 1 / max(1, len(words) - 1))])
        rows.append((index, np.bincount(where, weights=shares)))
        kept.append(target)
    weights, past, bias = np.zeros(ROWS), np.full(ROWS, 1e-6), 0.0
    dice, past_bias = np.random.default_rng(seed), 1e-6
    for _ in range(epochs):
        for i in dice.permutation(len(rows)):
            index, values = rows[i]
            p = 1 / (1 + np.exp(-np.clip(bias + weights[index] @ values, -500, 500)))
            error = p - kept[i]
            step = error * values + decay * weights[index]
            past[index] += step**2
            weights[index] -= rate * step / np.sqrt(past[index])
            past_bias += error**2
            bias -= rate * error / np.sqrt(past_bias)
    return Scorer(weights.astype(np.float32), bias)


def _counted(scorer: Scorer | None):
    """_id, the counts, and the score if there is a scorer: one look at each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, scores = [], []
            for text in batch.column("_content"):
                counts, words, shapes = analysed(text.as_py())
                found.append(counts)
                if scorer:
                    scores.append(scorer(words, shapes))
            columns = np.array(found, np.int64).reshape(-1, len(COUNTS))
            out = [*(c for c in batch.columns[:-1]), *(pa.array(columns[:, i]) for i in range(len(COUNTS)))]
            if scorer:
                out.append(pa.array(scores, pa.float64()))
            yield pa.RecordBatch.from_arrays(out, [*batch.schema.names[:-1], *COUNTS, *(["_score"] if scorer else [])])
        release()

    return run


def _voted(docs: DataFrame, scorer: Scorer | None, own: dict[str, Column] | None, keep: list[str], id_col: str, text_col: str) -> DataFrame:
    """keep of _id, _hash (of the text) and _bytes, a column of votes for each labeller, and _score if there is a scorer; one narrow pass."""
    text = content(text_col)
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_hash"), F.octet_length(text).alias("_bytes"), text.alias("_content")).select(*keep, "_content")
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    counted = rows.mapInArrow(_counted(scorer), f"{kinds}, " + ", ".join(f"{c} long" for c in COUNTS) + (", _score double" if scorer else ""))
    return counted.select(*keep, *(v.cast("int").alias(n) for n, v in (own or labellers()).items()), *(["_score"] if scorer else []))


def votes(docs: DataFrame, own: dict[str, Column] | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_id and a column of votes for each labeller; a null text is empty."""
    return _voted(docs, None, own, ["_id"], id_col, text_col)


def label_model(voted: DataFrame) -> LabelModel:
    """EM over the counts of vote patterns, which Spark counts over all documents."""
    names = [c for c in voted.columns if not c.startswith("_")]
    if len(names) > 12:
        raise ValueError("at most 12 labellers, so that patterns stay few")
    patterns = voted.groupBy(*names).count().orderBy(*names).collect()
    found = np.array([[r[n] for n in names] for r in patterns], np.int64).reshape(-1, len(names))
    return expectation_maximisation(names, found, np.array([r["count"] for r in patterns], np.float64))


def _posterior(model: LabelModel) -> Column:
    """The log odds as a sum of one term per labeller, then the posterior; plain column arithmetic."""
    odds = F.lit(float(np.log(model.good / (1 - model.good))))
    for i, name in enumerate(model.names):
        terms = np.log(model.table[i][1] / model.table[i][0])
        odds = odds + F.element_at(F.lit(terms.tolist()), F.col(name) + 2)
    return 1 / (1 + F.exp(-odds))


def fit_scorer(docs: DataFrame, voted: DataFrame, model: LabelModel, *, sample: int = SAMPLE, most_bytes: int = MOST_BYTES, total_bytes: int = TOTAL_BYTES, text_col: str = "text") -> Scorer:
    """Trains on the first texts by a hash, half of them likely bad as far as there are such.

    voted has _hash, _bytes and the votes of every row. Texts of over
    most_bytes leave the sample, and it ends where its texts have total_bytes.
    """
    chances = voted.where(F.col("_bytes").between(1, most_bytes)).select("_hash", "_bytes", _posterior(model).alias("_p"))
    first = lambda d: d.groupBy("_hash").agg(F.min("_p").alias("_p"), F.max("_bytes").alias("_bytes")).orderBy("_hash").limit(sample // 2)
    taken = first(chances.where("_p < 0.5")).unionByName(first(chances.where("_p >= 0.5")))
    text = content(text_col)
    got = bounded_sample(docs.select(F.xxhash64(text).alias("_hash"), text.alias("_content")), taken, "_hash", "_content", total_bytes)
    return train([bytes(x) for x in got["_content"]], got["_p"].to_numpy())


def quality(docs: DataFrame, own: dict[str, Column] | None = None, *, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """For every row: id, n_votes, posterior (of the label model), score (of the scorer), keep (score >= threshold).

    A null or empty text has no words, the votes that follow from that, and
    the score 0. Repeated rows come back each, a null id stays null. An empty
    table gives no rows: the models are then their starting values. Whole
    texts count, however long, one at a time; other columns, whatever their
    names, are not read. The counts for EM and the result each take one pass
    over the texts, without a shuffle.
    """
    voted = materialise(_voted(docs, None, own, ["_hash", "_bytes"], id_col, text_col), "votes")
    model = label_model(voted)
    scorer = fit_scorer(docs, voted, model, text_col=text_col, **options)
    found = _voted(docs, scorer, own, ["_id"], id_col, text_col)
    cast = sum((F.abs(F.col(n)) for n in model.names), F.lit(0)).cast("long")
    return found.select(F.col("_id").alias(id_col), cast.alias("n_votes"), _posterior(model).alias("posterior"), F.col("_score").alias("score"), (F.col("_score") >= threshold).alias("keep"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))
