"""Token groups and links between two tokenizers' readings of the same texts.

Each tokenizer's tokens become end events: where a token ends in the text's
bytes, and its id. Both tokenizers' events are put together, dealt out by
document and put in order of their offsets, and then run through a machine that
closes a group wherever tokens of both end at one offset. Events travel in
runs, a row for each side and SPAN bytes of a text; a run holds ids, since an
id's length tells the next offset. The machine holds the tokens of the group
that is open, running sums, a running digest, and the id pairs that the
document has linked so far.

Pairs' counts over all documents are one aggregation. They come back to the
documents in two ways: the most frequent pairs, at most HOT by a histogram of
counts, are broadcast, and only pairs beyond these are shuffled, so no pair that
nearly every document has is a hot key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm.common import content, kept, materialise, release, settled, table
from tidegraph.llm.encoders import ByteLevel, Pieces, is_plain, words_of
from tidegraph.llm.tokens import public_vocabulary

#: Bytes of a text whose events make up one row.
SPAN = 1 << 15
#: Frequent pairs that are broadcast, at most.
HOT = 150_000
#: Links of a group beyond which pairs are told from distinct ids, not from tokens.
MANY = 4096
#: Letters of texts that are looked at together, and new words that are encoded as one text.
GROUP, TOGETHER = 1 << 20, 5_000
#: Words that a worker remembers, and the longest of them; beyond, it starts anew.
REMEMBERED, LONGEST = 300_000, 64
#: Pairs that a document collects before they are counted.
AT_ONCE = 1 << 20


class Sides:
    """Both tokenizers, how many bytes each id stands for, and the ids of words that were met before.

    Between a visible character and a space both tokenizers end a token, so
    texts are taken word by word, each with the space before it. New words are
    put together into one text for each tokenizer.
    """

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path, True), Pieces(b_path)
        self.bytes = [self.a.bytes, dict(enumerate(self.b.bytes))]
        self.lengths = [self._lengths(x) for x in self.bytes]
        self.longest = int(max(x.max() for x in self.lengths))
        self.kinds = ["<u2" if len(x) <= 1 << 16 else "<u4" for x in self.lengths]
        #: word -> both tokenizers' ids, or None where their bytes are not the word's
        self.known: dict[str, tuple[bytes, bytes] | None] = {}

    @staticmethod
    def _lengths(of: dict[int, bytes]) -> np.ndarray:
        found = np.zeros(max(of) + 1, np.int64)
        found[list(of)] = [len(x) for x in of.values()]
        return found

    def _alone(self, word: str) -> tuple[bytes, bytes] | None:
        found, data = (self.a.ids(word), self.b.ids(word[1:])), word.encode()
        if any(b"".join(map(own.__getitem__, ids.tolist())) != data for own, ids in zip(self.bytes, found, strict=True)):
            return None
        return tuple(ids.astype(kind).tobytes() for ids, kind in zip(found, self.kinds, strict=True))

    def _together(self, words: list[str]) -> list[tuple[bytes, bytes] | None]:
        """The same for words that all end in a visible Latin character."""
        text, sides = "".join(words), []
        data = text.encode()
        bounds = np.cumsum([len(w.encode()) for w in words])
        for which, ids in enumerate((self.a.ids(text), self.b.ids(text[1:]))):
            ends = np.cumsum(self.lengths[which][ids])
            at = np.searchsorted(ends, bounds)
            if b"".join(map(self.bytes[which].__getitem__, ids.tolist())) != data or (ends[at] != bounds).any():
                return [self._alone(w) for w in words]
            width = int(self.kinds[which][-1])
            whole, cuts = ids.astype(self.kinds[which]).tobytes(), [0, *((at + 1) * width).tolist()]
            sides.append([whole[x:y] for x, y in pairwise(cuts)])
        return list(zip(*sides, strict=True))

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if is_plain(w)]
        for at in range(0, len(plain), TOGETHER):
            some = plain[at : at + TOGETHER]
            self.known.update(zip(some, self._together(some), strict=True))
        self.known.update((w, self._alone(w)) for w in set(words).difference(plain))

    def read(self, texts: Iterable[str]) -> Iterator[tuple[bytes, bytes] | None]:
        """For each text both tokenizers' ids; None if it is empty, or either's bytes are not those of a space and the text."""
        group, size = [], 0
        for text in texts:
            # without safe places a text is one word
            group.append((words_of(f" {text}") if self.a.safe and self.b.safe else [f" {text}"]) if text else [])
            size += len(text)
            if size > GROUP:
                yield from self._read(group)
                group, size = [], 0
        yield from self._read(group)

    def _read(self, group: list[list[str]]) -> Iterator[tuple[bytes, bytes] | None]:
        every = set().union(*group)
        new = every.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = every
        self._learn(list(new))
        for words in group:
            found = [self.known[w] for w in words]
            yield tuple(map(b"".join, zip(*found, strict=True))) if found and None not in found else None
        for word in new:
            if len(word) > LONGEST:
                del self.known[word]


def sides(a_path: str, b_path: str) -> Sides:
    return kept(("sides", a_path, b_path), lambda: Sides(a_path, b_path))


def _events(a_path: str, b_path: str, span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = sides(a_path, b_path)
        for batch in batches:
            rows, at, side, ids = [], [], [], []
            texts = (x.as_py().decode("utf-8", "replace") for x in batch.column("_content"))
            for row, found in enumerate(both.read(texts)):
                # without tokens one row, so that the document is told of
                for which, whole in enumerate(found or [b""]):
                    own, parts = np.frombuffer(whole, both.kinds[which]), [(0, whole)]
                    # only texts that may be longer than a span
                    if len(own) * both.longest > span:
                        spans = (np.cumsum(both.lengths[which][own]) - 1) // span
                        bounds = np.flatnonzero(np.diff(spans)) + 1
                        parts = [(int(spans[low]), x.tobytes()) for low, x in zip([0, *bounds.tolist()], np.split(own, bounds), strict=True)]
                    for number, part in parts:
                        rows.append(row)
                        at.append(number)
                        side.append(which)
                        ids.append(part)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row").take(take), batch.column("_id").take(take), pa.array(at, pa.int64()), pa.array(side, pa.int8()), pa.array(ids, pa.binary())],
                ["_row", "_id", "_at", "_side", "_ids"],
            )
        release()

    return run


class Decimals:
    """Ids as decimal text, many at once: a row of digits and a mark for each, of which zero bytes are left out."""

    def __init__(self, most: int):
        self.width = len(str(most))
        self.digits = np.zeros((most + 1, self.width + 1), np.uint8)
        texts = np.char.mod("%d", np.arange(most + 1)).astype(f"S{self.width}")
        self.digits[:, : self.width] = np.frombuffer(texts.tobytes(), np.uint8).reshape(most + 1, self.width)

    def join(self, ids: np.ndarray, marks: np.ndarray) -> bytes:
        found = self.digits[ids]
        found[:, self.width] = marks
        found = found.ravel()
        return found[found != 0].tobytes()


class Machine:
    """Reads a document's runs in order and says what its groups and links are."""

    def __init__(self, lengths: list[np.ndarray], span: int):
        self.lengths, self.span = lengths, span
        self.decimals = Decimals(max(map(len, lengths)) - 1)

    def start(self) -> None:
        self.end, self.open = [0, 0], [[], []]
        self.tokens, self.groups, self.links, self.digest = [0, 0], 0, 0, None
        self.keys, self.times, self.held = [], [], 0

    def window(self, at: int, ids: list[np.ndarray]) -> None:
        """The tokens of both sides that end in the span with this number."""
        low = at * self.span
        ends, marks = [], []
        for s in (0, 1):
            self.tokens[s] += len(ids[s])
            found = self.end[s] + np.cumsum(self.lengths[s][ids[s]])
            if len(found):
                self.end[s] = int(found[-1])
            ends.append(found - low)
        for s in (0, 1):
            there = np.zeros(self.span + 1, bool)
            there[ends[s]] = True
            marks.append(there)
        closed = [np.flatnonzero(marks[1 - s][ends[s]]) + 1 for s in (0, 1)]
        if len(closed[0]):
            whole = [np.concatenate([*self.open[s], ids[s][: closed[s][-1]]]) for s in (0, 1)]
            shift = [sum(map(len, self.open[s])) for s in (0, 1)]
            self.close(whole, [np.append(0, closed[s] + shift[s]) for s in (0, 1)])
            self.open = [[ids[s][closed[s][-1] :]] for s in (0, 1)]
        else:
            for s in (0, 1):
                self.open[s].append(ids[s])

    def close(self, ids: list[np.ndarray], bounds: list[np.ndarray]) -> None:
        """Groups whose tokens are ids[s][bounds[s][g] : bounds[s][g + 1]]."""
        a, b = ids
        start, each = [x[:-1] for x in bounds], [np.diff(x) for x in bounds]
        # a's tokens of a group, then b's
        groups = np.arange(len(each[0]))
        place = [np.arange(len(a)) + np.repeat(start[1], each[0]), np.arange(len(b)) + np.repeat(bounds[0][1:], each[1])]
        text, mark = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        text[place[0]], text[place[1]] = a, b
        mark[place[0][bounds[0][1:] - 1]], mark[place[1][bounds[1][1:] - 1]] = ord("|"), ord(";")
        told = self.decimals.join(text, mark)[:-1]
        if self.digest is None:
            self.digest = hashlib.sha256(told)
        else:
            self.digest.update(b";" + told)
        self.groups += len(groups)
        links = each[0] * each[1]
        self.links += int(links.sum())
        a, b = a.astype(np.int64) << 32, b.astype(np.int64)
        one = links == 1
        self.add(a[start[0][one]] | b[start[1][one]])
        some = np.flatnonzero(~one & (links <= MANY))
        for at in np.split(some, np.flatnonzero(np.diff(np.cumsum(links[some]) // AT_ONCE)) + 1):
            n, of = links[at], np.repeat(at, links[at])
            step = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            self.add(a[start[0][of] + step // each[1][of]] | b[start[1][of] + step % each[1][of]])
        for g in np.flatnonzero(links > MANY).tolist():
            (x, nx), (y, ny) = (np.unique(v[start[s][g] : start[s][g] + each[s][g]], return_counts=True) for s, v in enumerate((a, b)))
            step = max(1, AT_ONCE // len(y))
            for at in range(0, len(x), step):
                self.add((x[at : at + step, None] | y[None]).ravel(), (nx[at : at + step, None] * ny[None]).ravel())

    def add(self, keys: np.ndarray, times: np.ndarray | None = None) -> None:
        """Pairs, each once if times are not given."""
        if not len(keys):
            return
        self.keys.append(keys)
        self.times.append(times)
        self.held += len(keys)
        if self.held > max(AT_ONCE, len(self.keys[0])):
            self.merge()

    def merge(self) -> None:
        every = np.concatenate(self.keys)
        if all(x is None for x in self.times):
            keys, times = np.unique(every, return_counts=True)
        else:
            times = np.concatenate([np.ones(len(k), np.int64) if x is None else x for k, x in zip(self.keys, self.times, strict=True)])
            keys, where = np.unique(every, return_inverse=True)
            times = np.bincount(where, times, len(keys)).astype(np.int64)
        # what is there already does not count towards the next merge
        self.keys, self.times, self.held = [keys], [times], 0

    def result(self) -> tuple:
        if self.keys:
            self.merge()
        keys, times = (self.keys[0], self.times[0]) if self.keys else (np.zeros(0, np.int64),) * 2
        return (*self.tokens, self.groups, self.links, self.digest.hexdigest() if self.digest else "", keys, times)


def _swept(lengths: list[np.ndarray], span: int):
    kinds = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(), "_keys": pa.list_(pa.int64()), "_times": pa.list_(pa.int64())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(lengths, span)
        row = at = own = None
        pending = [np.zeros(0, np.uint32)] * 2
        done: list[tuple] = []
        size = 0

        def flushed() -> pa.RecordBatch:
            nonlocal done, size
            columns = list(zip(*done, strict=True))
            made = [pa.array(columns[0], pa.int64()), pa.concat_arrays(columns[1]), *(pa.array(x, kind) for x, kind in zip(columns[2:], kinds.values(), strict=True))]
            done, size = [], 0
            return pa.RecordBatch.from_arrays(made, ["_row", "_id", *kinds])

        def told() -> None:
            nonlocal size
            if any(map(len, pending)):
                machine.window(at, pending)
            found = machine.result()
            done.append((row, own, *found))
            size += len(found[-1])

        for batch in batches:
            rows, spans, which = (batch.column(c).to_numpy() for c in ("_row", "_at", "_side"))
            for i, ids in enumerate(batch.column("_ids")):
                if rows[i] != row:
                    if row is not None:
                        told()
                        if size > AT_ONCE or len(done) > 5000:
                            yield flushed()
                    row, at, own, pending = int(rows[i]), int(spans[i]), batch.column("_id").slice(i, 1), [np.zeros(0, np.uint32)] * 2
                    machine.start()
                elif spans[i] != at:
                    machine.window(at, pending)
                    at, pending = int(spans[i]), [np.zeros(0, np.uint32)] * 2
                pending[which[i]] = np.frombuffer(ids.as_py(), "<u2" if len(lengths[which[i]]) <= 1 << 16 else "<u4")
        if row is not None:
            told()
            yield flushed()
        release()

    return run


def _counts(documents: DataFrame) -> DataFrame:
    """(_key, _n, _best): how many documents have a pair, and whether no pair of its A id is in more."""
    pairs = materialise(documents.select(F.explode("_keys").alias("_key")).groupBy("_key").agg(F.count("*").alias("_n")), "pairs")
    first = F.shiftright("_key", 32)
    most = pairs.groupBy(first.alias("_a")).agg(F.max("_n").alias("_most"))
    return pairs.withColumn("_a", first).join(most, "_a").select("_key", "_n", (F.col("_n") == F.col("_most")).alias("_best"))


def _frequent(counts: DataFrame, most: int) -> int:
    """The least power of two which at most so many pairs' counts reach."""
    steps = {r["_s"]: r["_m"] for r in counts.groupBy((F.length(F.bin("_n")) - 1).alias("_s")).agg(F.count("*").alias("_m")).collect()}
    reach, total = max(steps, default=0) + 1, 0
    while reach and total + steps.get(reach - 1, 0) <= most:
        reach -= 1
        total += steps.get(reach, 0)
    return 1 << reach


def alignments(docs: DataFrame, *, a_vocabulary: str | None = None, b_vocabulary: str | None = None, span: int = SPAN, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and the linked id pairs with how often (pairs, times).

    A reads a space and the text, B the text, before which it puts the space
    itself; strings of special tokens are plain text. A pair is A's id << 32 |
    B's. Null and empty texts, and texts whose bytes do not come back from
    both, have zeros, an empty digest and no pairs. Null ids stay null,
    repeated rows count each as a document, an empty table gives no rows;
    other columns, whatever their names, are not read. A long text is a long
    list of runs: memory grows with its open group and its distinct pairs.
    """
    a_path, b_path = a_vocabulary or public_vocabulary("byte_bpe_50k.json"), b_vocabulary or public_vocabulary("piece_bpe_32k.model")
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), content(text_col).alias("_content"))
    kind = rows.schema["_id"].dataType.simpleString()
    events = rows.mapInArrow(_events(a_path, b_path, span), f"_row long, _id {kind}, _at long, _side byte, _ids binary")
    swept = events.repartition("_row").sortWithinPartitions("_row", "_at", "_side")
    lengths = sides(a_path, b_path).lengths
    documents = swept.mapInArrow(_swept(lengths, span), f"_row long, _id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, _keys array<long>, _times array<long>")
    documents = materialise(documents, "aligned", compression="zstd")
    counts = materialise(_counts(documents), "pair-counts")
    reach = _frequent(counts, hot)
    links = documents.select("_row", F.explode(F.arrays_zip("_keys", "_times")).alias("_x")).select("_row", F.col("_x._keys").alias("_key"), F.col("_x._times").alias("_t"))
    # at most hot rows
    often = F.broadcast(counts.where(F.col("_n") >= reach))
    told = links.join(often, "_key")
    if reach > 1:
        told = told.unionByName(links.join(often, "_key", "left_anti").join(counts.where(F.col("_n") < reach), "_key"))
    sums = told.groupBy("_row").agg(F.sum(F.when(F.col("_best"), F.col("_t")).otherwise(0)).alias("n_best"), F.sum(F.col("_t") * F.col("_n")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return documents.join(sums, "_row", "left").select(F.col("_id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256", F.col("_keys").alias("pairs"), F.col("_times").alias("times"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(spark, "alignment", lambda: alignments(table(spark, sf_dir, "documents")).drop("pairs", "times"))
