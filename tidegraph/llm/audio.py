"""Chroma fingerprints of audio columns, and their alignment.

A recording is brought to one rate, and its frames, which all last the same
time, are folded to twelve pitch classes. Over the picture of pitch classes and
time, sixteen difference filters of four shapes and four widths are read off an
integral image, each quantised to two bits in Gray code, so every frame becomes
one 32-bit integer. Two recordings are aligned by a histogram of the offsets at
which their integers agree; a query's integer also counts with some of its three
least certain bits the other way, so that noisy copies are met. At an offset
with enough votes, the share of differing bits tells how alike they are.
Queries and recordings meet in cells, a block of queries and a slice of
recordings each, whose votes are counted in one task, so chance votes are no
rows.
"""

from __future__ import annotations

import io
import struct
import wave
from collections.abc import Iterator
from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm.common import materialise, release, table

#: Samples a second, of a frame, and from one frame to the next: frames overlap so much that it hardly matters where a cut begins.
RATE, FRAME, HOP = 4000, 1024, 256
LOWEST, HIGHEST = 110.0, 1760.0
WIDTHS = (4, 8, 16, 24)
SPAN = max(WIDTHS)
#: Where a filter's log ratio changes its two bits.
STEPS = (-0.25, 0.0, 0.25)
VOTES = 4
MOST_ERRORS = 0.2
#: Bits of a query's integer that may be the other way.
UNSURE = 3
QUERY_STEP = 50
#: Queries and recordings of one cell, and votes that it counts at once.
QUERIES, SLICE, AT_ONCE = 20_000, 5_000, 2_000_000
#: Samples of a note that render() plays.
NOTE = 512
#: Samples that are read at once.
BLOCK = 1 << 18
#: Zero crossings of the resampling kernel to each side.
CROSSINGS = 16


def pcm(sound: bytes) -> tuple[str, int, int, memoryview] | None:
    """Kind of number, channels, rate and the samples' bytes of a WAV file; nothing if it is none, or of another kind."""
    view = memoryview(sound)
    if len(view) < 12 or bytes(view[:4]) != b"RIFF" or bytes(view[8:12]) != b"WAVE":
        return None
    at, form = 12, None
    while at + 8 <= len(view):
        name, size = bytes(view[at : at + 4]), struct.unpack_from("<I", view, at + 4)[0]
        body = view[at + 8 : at + 8 + size]
        if name == b"fmt " and len(body) >= 16:
            tag, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", body)
            if tag == 0xFFFE and len(body) >= 26:  # the format proper follows
                tag = struct.unpack_from("<H", body, 24)[0]
            form = {(1, 8): "u1", (1, 16): "<i2", (1, 24): "i3", (1, 32): "<i4", (3, 32): "<f4", (3, 64): "<f8"}.get((tag, bits)), channels, rate
        elif name == b"data":
            return (*form, body) if form and form[0] and form[1] and form[2] else None
        at += 8 + size + size % 2
    return None


def _mono(data: memoryview, kind: str, channels: int) -> np.ndarray:
    """Samples in -1..1, the mean over the channels."""
    if kind == "i3":
        octets = np.frombuffer(data, np.uint8).reshape(-1, 3).astype(np.int32)
        values = ((octets[:, 0] << 8 | octets[:, 1] << 16 | octets[:, 2] << 24) >> 8) / float(1 << 23)
    else:
        values = np.frombuffer(data, kind).astype(np.float64)
        scale = {"u1": 128, "<i2": 1 << 15, "<i4": 1 << 31}.get(kind)
        values = np.nan_to_num(values) if scale is None else (values - (128 if kind == "u1" else 0)) / scale
    return values.reshape(-1, channels).mean(axis=1)


def blocks_of(sound: bytes | None) -> tuple[Iterator[np.ndarray], int]:
    """Blocks of mono samples, and their rate; none of null or of what is no WAV file of integers or floats."""
    found = pcm(sound) if sound else None
    if not found:
        return iter(()), RATE
    kind, channels, rate, data = found
    frame = channels * int(kind[-1])
    size = len(data) // frame * frame
    return (_mono(data[at : min(size, at + BLOCK * frame)], kind, channels) for at in range(0, size, BLOCK * frame)), rate


def resampled(blocks: Iterator[np.ndarray], rate: int, to: int = RATE) -> Iterator[np.ndarray]:
    """The blocks at another rate, by a windowed sinc that lets through what both rates can hold.

    A block needs some samples after it, so these are held back until the next
    one comes; before the start and after the end there is silence.
    """
    if rate == to:
        yield from blocks
        return
    share = gcd(rate, to)
    step, phases = rate // share, to // share
    # in input samples; the kernel is as wide as the lower rate asks for
    low = min(1.0, to / rate)
    reach = int(np.ceil(CROSSINGS / low))
    distance = np.arange(-reach, reach + 1)[None, :] - (np.arange(phases) / phases)[:, None]
    kernel = low * np.sinc(low * distance) * np.cos(np.pi / 2 * np.clip(distance / (reach + 1), -1, 1)) ** 2
    held, first, done = np.zeros(reach), -reach, 0  # held[0] is input sample number first

    def out(last: int) -> np.ndarray:
        """Output samples whose kernel ends by input sample last."""
        nonlocal done
        upto = max(done, ((last - reach) * phases) // step + 1)
        number = np.arange(done, upto)
        done = upto
        found = np.empty(len(number))
        for at in range(0, len(number), 4096):
            place = number[at : at + 4096] * step
            start = place // phases - reach - first
            found[at : at + 4096] = np.einsum("ij,ij->i", held[start[:, None] + np.arange(2 * reach + 1)], kernel[place % phases])
        return found

    total = 0
    for block in blocks:
        held, total = np.concatenate([held, block]), total + len(block)
        yield out(total - 1)
        keep = done * step // phases - reach - first
        held, first = held[keep:], first + keep
    held = np.concatenate([held, np.zeros(2 * reach + 1)])
    rest = out(total - 1 + reach)
    yield rest


def _pitch_classes() -> np.ndarray:
    frequencies = np.fft.rfftfreq(FRAME, 1 / RATE)
    fold = np.zeros((len(frequencies), 12))
    for i, f in enumerate(frequencies):
        if LOWEST <= f <= HIGHEST:
            fold[i, int(round(12 * np.log2(f / 440.0))) % 12] = 1
    return fold


_FOLD, _WINDOW = _pitch_classes(), np.hanning(FRAME)


def chroma(blocks: Iterator[np.ndarray], rate: int) -> np.ndarray:
    """frames x 12, each frame scaled to length 1 unless it is silent; of a long recording only this is held whole."""
    found, held = [np.zeros((0, 12))], np.empty(0)
    for block in resampled(blocks, rate):
        held = np.concatenate([held, block])
        if len(held) < FRAME:
            continue
        frames = np.lib.stride_tricks.sliding_window_view(held, FRAME)[::HOP]
        for at in range(0, len(frames), 512):
            folded = np.abs(np.fft.rfft(frames[at : at + 512] * _WINDOW, axis=1)) ** 2 @ _FOLD
            norms = np.linalg.norm(folded, axis=1, keepdims=True)
            found.append(np.where(norms > 1e-6, folded / np.maximum(norms, 1e-12), 0))
        held = held[len(frames) * HOP :]
    return np.concatenate(found)


def codes(image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place where the widest filter fits, an unsigned 32-bit integer, and its UNSURE least certain bits as a mask."""
    places = len(image) - SPAN + 1
    if places <= 0:
        return np.empty(0, np.uint32), np.empty(0, np.uint32)
    integral = np.zeros((len(image) + 1, 13))
    integral[1:, 1:] = image.cumsum(axis=0).cumsum(axis=1)
    at = np.arange(places)

    def area(t0: int, t1: int, p0: int, p1: int) -> np.ndarray:
        return integral[at + t1, p1] - integral[at + t0, p1] - integral[at + t1, p0] + integral[at + t0, p0]

    out = np.zeros(places, np.uint32)
    gaps, bits = np.empty((places, 4 * len(WIDTHS))), np.empty((places, 4 * len(WIDTHS)), np.uint32)
    number = 0
    for w in WIDTHS:
        h = w // 2
        whole = area(0, w, 0, 12)
        for part in (
            area(0, h, 0, 12),  # first half against second
            area(0, w, 0, 6),  # lower pitch classes against higher
            area(0, h, 0, 6) + area(h, w, 6, 12),  # one diagonal against the other
            area(0, w, 3, 9),  # middle against both sides
        ):
            value = np.log((1e-3 + part) / (1e-3 + whole - part))
            level = np.digitize(value, STEPS)
            out = out << np.uint32(2) | (level ^ level >> 1).astype(np.uint32)
            # beyond the nearest step, one bit of the Gray code is the other way
            distance = np.abs(value[:, None] - np.array(STEPS)[None, :])
            nearest = distance.argmin(axis=1)
            gaps[:, number] = distance[at, nearest]
            shift = np.uint32(2 * (4 * len(WIDTHS) - 1 - number))
            bits[:, number] = np.where(nearest == 1, np.uint32(2), np.uint32(1)) << shift
            number += 1
    least = np.argsort(gaps, axis=1, kind="stable")[:, :UNSURE]
    return out, np.bitwise_or.reduce(np.take_along_axis(bits, least, axis=1), axis=1)


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.int64())
    for batch in batches:
        found = [codes(chroma(*blocks_of(x.as_py()))) for x in batch.column("_sound")]
        columns = [pa.array([x[i].astype(np.int64) for x in found], kind) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), *columns], ["_id", "_codes", "_unsure"])
    release()


def fingerprints(recordings: DataFrame, *, id_col: str, sound_col: str) -> DataFrame:
    """(_id, _codes, _unsure) of each row.

    WAV files of integers with 8 to 32 bits or floats, of any rate and number
    of channels. Null, short or unreadable sound, or of another kind, has no
    codes. Long recordings are read in blocks; repeated rows come back each,
    an empty table gives no rows, other columns are not read.
    """
    rows = recordings.select(F.col(id_col).cast("long").alias("_id"), F.col(sound_col).alias("_sound"))
    return rows.mapInArrow(_fingerprinted, "_id long, _codes array<long>, _unsure array<long>")


def variants(values: np.ndarray, unsure: np.ndarray) -> np.ndarray:
    """values x 2^UNSURE: each value with each choice of its unsure bits the other way, and -1, which no value is, where it has fewer."""
    out, left = values[:, None], unsure.copy()
    for _ in range(UNSURE):
        bit = left & -left
        out = np.concatenate([out, np.where(bit[:, None] == 0, -1, out ^ bit[:, None])], axis=1)
        left ^= bit
    return out


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The integers of all lists, and where each list starts, the end last."""
    lists = column.combine_chunks()
    values = lists.flatten().to_numpy(zero_copy_only=False)
    return values, np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)


def offset_votes(one: np.ndarray, starts: np.ndarray, two: np.ndarray, starts2: np.ndarray, votes: int, at_once: int = AT_ONCE, unsure: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """(list of one, list of two, offset, votes) of at least votes equal integers, each list of two in one part, in order.

    Integers are also equal if they differ in unsure bits of one only.
    """
    owner, owner2 = np.repeat(np.arange(len(starts) - 1), np.diff(starts)), np.repeat(np.arange(len(starts2) - 1), np.diff(starts2))
    place, place2 = np.arange(len(one)) - starts[owner], np.arange(len(two)) - starts2[owner2]
    each = one[:, None] if unsure is None else variants(one, unsure)
    order = each.ravel().argsort(kind="stable")
    ranked = each.ravel()[order]
    order //= each.shape[1]
    low, high = np.searchsorted(ranked, two), np.searchsorted(ranked, two, "right")
    ends = np.cumsum(high - low)
    reach = int(np.diff(starts).max(initial=0))
    wide = reach + int(np.diff(starts2).max(initial=0)) + 1
    held, held_n, at = np.empty(0, np.int64), np.empty(0, np.int64), 0
    while at < len(two):
        done = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + at_once, "right")))
        counts = (high - low)[at:stop]
        of = np.repeat(np.arange(at, stop), counts)
        hit = order[low[of] + np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)]
        keys, n = np.unique((owner2[of] * (len(starts) - 1) + owner[hit]) * wide + place2[of] - place[hit] + reach, return_counts=True)
        if len(held):
            keys, where = np.unique(np.concatenate([held, keys]), return_inverse=True)
            n = np.bincount(where, weights=np.concatenate([held_n, n])).astype(np.int64)
        # a list that goes on in the next part isn't counted to its end
        goes_on = keys // (wide * (len(starts) - 1)) == owner2[stop] if stop < len(two) else np.zeros(len(keys), bool)
        held, held_n = keys[goes_on], n[goes_on]
        told = ~goes_on & (n >= votes)
        pair = keys[told] // wide
        yield pair % (len(starts) - 1), pair // (len(starts) - 1), keys[told] % wide - reach, n[told]
        at = stop


def _cell(votes: int, most_errors: float):
    """Of a block of queries and a slice of recordings: each pair's alignment."""

    def run(asked: pa.Table, others: pa.Table) -> pa.Table:
        found: list[tuple[str, int, int, int, float]] = []
        if asked.num_rows and others.num_rows:
            (one, starts), (two, starts2) = _lists(asked["_codes"]), _lists(others["_codes"])
            names, names2, classes = asked["_digest"].to_pylist(), others["_digest"].to_pylist(), others["_class"].to_pylist()
            for queries, matches, offsets, n in offset_votes(one, starts, two, starts2, votes, unsure=_lists(asked["_unsure"])[0]):
                best: dict[tuple[int, int], tuple[tuple[int, int, int], float]] = {}
                for q, m, offset, count in zip(queries.tolist(), matches.tolist(), offsets.tolist(), n.tolist(), strict=True):
                    if names[q] == names2[m]:
                        continue
                    rank = (count, -abs(offset), offset)
                    if (q, m) in best and best[q, m][0] > rank:
                        continue
                    x, y = one[starts[q] + max(0, -offset) : starts[q + 1]], two[starts2[m] + max(0, offset) : starts2[m + 1]]
                    size = min(len(x), len(y))
                    errors = int(np.bitwise_count(x[:size] ^ y[:size]).sum()) / (32 * size)
                    if errors <= most_errors:
                        best[q, m] = rank, errors
                found.extend((names[q], classes[m], count, offset, errors) for (q, m), ((count, _, offset), errors) in best.items())
        columns = list(zip(*found, strict=True)) or [()] * 5
        kinds = {"_query": pa.string(), "_match": pa.int64(), "_votes": pa.int64(), "_offset": pa.int64(), "_errors": pa.float64()}
        return pa.table({name: pa.array(x, kind) for (name, kind), x in zip(kinds.items(), columns, strict=True)})

    return run


def aligned(prints: DataFrame, *, query_step: int = QUERY_STEP, votes: int = VOTES, most_errors: float = MOST_ERRORS) -> DataFrame:
    """Per recording: _id, _class, n_codes, n_links, and its class's best alignment.

    Recordings with equal codes are a class, named by its least id. The
    classes with a member whose id query_step divides are queries, against
    all classes: n_links counts the others that align with at least votes
    agreeing integers at one offset (the query's unsure bits may be the other
    way) and at most most_errors of bits differing there; of several such offsets the one with the most votes is taken, then
    the nearest to zero. The best has the fewest errors, then the most votes, then the least
    class and offset; other classes have nulls. Recordings without codes are
    a class without links. A null id is a query never, and a class name only
    if the class has no other. Of equal codes with other unsure bits, the least
    list of these counts. Repeated rows come back each; an empty table gives
    no rows; other columns are not read.
    """
    prints = prints.select("_id", "_codes", "_unsure")
    prints = materialise(prints.withColumn("_digest", F.sha2(F.concat_ws(",", F.col("_codes").cast("array<string>")), 256)), "prints")
    groups = materialise(
        prints.groupBy("_digest").agg(F.min("_id").alias("_class"), F.max(F.coalesce(F.col("_id") % query_step == 0, F.lit(False))).alias("_asked"), F.first("_codes").alias("_codes"), F.min("_unsure").alias("_unsure")),
        "classes",
    )
    n_queries, n_groups = groups.agg(F.count_if("_asked"), F.count("*")).first()
    n_blocks, n_slices = max(1, -(-n_queries // QUERIES)), max(1, -(-n_groups // SLICE))
    part = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "_digest"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.lit(list(range(n))).cast("array<int>"))
    asked = groups.where("_asked").select("_digest", "_codes", "_unsure", part(n_blocks, 1).alias("_block"), every(n_slices).alias("_slice"))
    others = groups.select("_digest", "_class", "_codes", part(n_slices, 2).alias("_slice"), every(n_blocks).alias("_block"))
    cells = asked.groupBy("_block", "_slice").cogroup(others.groupBy("_block", "_slice"))
    pairs = cells.applyInArrow(_cell(votes, most_errors), "_query string, _match long, _votes long, _offset long, _errors double")
    order = F.struct("_errors", (-F.col("_votes")).alias("v"), "_match", "_offset")
    found = pairs.groupBy(F.col("_query").alias("_digest")).agg(F.count("*").alias("_links"), F.min(order).alias("_best"))
    classes = groups.select("_digest", "_class").join(found, "_digest", "left")
    return prints.join(classes, "_digest").select(
        "_id",
        "_class",
        F.size("_codes").cast("long").alias("n_codes"),
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        F.col("_best._match").alias("best_class"),
        (-F.col("_best.v")).alias("best_votes"),
        F.col("_best._offset").cast("long").alias("best_offset"),
        F.round("_best._errors", 6).alias("best_errors"),
    )


def render(vector: list[float] | None) -> bytes:
    """A WAV file with one note for each number: the tables have no sound, so a vector is played.

    A number's place among 24 steps of -1.5 to 1.5 times the vector's mean
    size gives the pitch, upwards from 220 Hz in semitones.
    """
    values = np.nan_to_num(np.array([x for x in vector or [] if x is not None], np.float64))
    size = np.abs(values).mean() if len(values) else 1.0
    steps = np.clip(np.floor((values / (size or 1.0) + 1.5) * 8), 0, 23)
    phase = 2 * np.pi * np.cumsum(np.repeat(220 * 2 ** (steps / 12) / RATE, NOTE))
    out = io.BytesIO()
    with wave.open(out, "wb") as file:
        file.setnchannels(1)
        file.setsampwidth(1)
        file.setframerate(RATE)
        file.writeframes(np.round(127 + 100 * np.sin(phase)).astype(np.uint8).tobytes())
    return out.getvalue()


def _played(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array([render(x) for x in part.column("_vector").to_pylist()], pa.binary())], ["_id", "_sound"])


def op7_chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding, played and fingerprinted; recordings whose id 50 divides are aligned with all."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("_id"), F.col("embedding").cast("array<double>").alias("_vector"))
    sounds = vectors.mapInArrow(_played, "_id long, _sound binary")
    found = aligned(fingerprints(sounds, id_col="_id", sound_col="_sound"))
    return found.withColumnsRenamed({"_id": "vec_id", "_class": "class_id"})
