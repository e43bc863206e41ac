"""Chat formatting by columnar byte assembly.

A batch of turns is formatted without a loop over turns: each turn is three
segments, header, escaped text and footer; segment lengths give cumulative
offsets, and scatter indices copy all headers, texts and footers into one
preallocated Arrow buffer. Turns of a conversation are neighbours in a
partition, ordered by turn, so a conversation's text is a slice of the buffer:
buffer and offsets are the result's string column as they are, and the loss
spans come from offsets in code points. What is taken at once is bounded in
bytes, and so are the scatter indices; a long segment is copied as one slice.

A user's turn is "[INST] text [/INST]", an assistant's "<s> text </s>", any
other "[ROLE] role [/ROLE] [TEXT] text [/TEXT]". Where a text holds one of these marks, a
backslash is put after the mark's first character, and one more where there
are backslashes already; taking one away gives the text back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm.common import release, table

#: A conversation beyond this is written in several parts, so memory stays bounded; and bytes of turns formatted at once.
PART_BYTES = 16 << 20
#: Bytes that are scattered at once, and the length from which a segment is copied as a slice.
SCATTERED, LONG = 1 << 20, 1 << 14

_REST = r"(s>|/s>|/?INST\]|/?ROLE\]|/?TEXT\])"
_ESCAPE = r"([<\[])(\\*)" + _REST
_UNESCAPE = re.compile(r"([<\[])(\\*)\\" + _REST)
_TURN = re.compile(r"\[INST\] (.*?) \[/INST\]|<s> (.*?) </s>|\[ROLE\] (.*?) \[/ROLE\] \[TEXT\] (.*?) \[/TEXT\]", re.DOTALL)

#: The fixed texts before and after each kind of turn: user, assistant, other.
_HEADS = (b"[INST] ", b"<s> ", b"[ROLE] ")
_MIDDLES = (b"", b"", b" [/ROLE] [TEXT] ")
_FEET = (b" [/INST]", b" </s>", b" [/TEXT]")


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, _ESCAPE, r"\1\2\\\3")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def _segments(values: list[bytes], which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the values side by side, and each row's start and length in them."""
    lengths = np.array([len(v) for v in values], np.int64)
    starts = np.cumsum(lengths) - lengths
    return np.frombuffer(b"".join(values) or b"\0", np.uint8), starts[which], lengths[which]


def _column(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of a string column without nulls, from its buffers."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return np.frombuffer(data if data is not None and data.size else b"\0", np.uint8), offsets[:-1], np.diff(offsets)


def _scatter(out: np.ndarray, starts: np.ndarray, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
    """Copies byte k of each segment to its start + k."""
    for i in np.flatnonzero(size >= LONG).tolist():
        out[starts[i] : starts[i] + size[i]] = data[begin[i] : begin[i] + size[i]]
    short = np.flatnonzero(size < LONG)
    ends = np.cumsum(size[short])
    low = 0
    while low < len(short):
        high = int(np.searchsorted(ends, (ends[low - 1] if low else 0) + SCATTERED, "right"))
        rows = short[low : max(high, low + 1)]
        within = np.arange(size[rows].sum()) - np.repeat(np.cumsum(size[rows]) - size[rows], size[rows])
        out[np.repeat(starts[rows], size[rows]) + within] = data[np.repeat(begin[rows], size[rows]) + within]
        low += len(rows)


@dataclass
class Formatted:
    """Turns in one buffer: where each starts, in bytes and in code points (the end last), and where its text lies in code points."""

    buffer: pa.Buffer
    bounds: np.ndarray
    chars: np.ndarray
    text_start: np.ndarray
    text_end: np.ndarray


def format_turns(roles: pa.Array, texts: pa.Array) -> Formatted:
    """All turns formatted into one buffer. Nulls count as empty."""
    roles, texts = (pc.fill_null(x.cast(pa.large_string()), "") for x in (roles, texts))
    kind = np.full(len(texts), 2)
    kind[pc.equal(roles, "user").to_numpy(zero_copy_only=False)] = 0
    kind[pc.equal(roles, "assistant").to_numpy(zero_copy_only=False)] = 1
    named = escape(pc.if_else(pa.array(kind == 2), roles, pa.scalar("", pa.large_string())))
    escaped = escape(texts)
    parts = [_segments(list(_HEADS), kind), _column(named), _segments(list(_MIDDLES), kind), _column(escaped), _segments(list(_FEET), kind)]
    lengths = np.stack([p[2] for p in parts], axis=1)
    ends = np.cumsum(lengths.ravel()).reshape(lengths.shape)
    starts = ends - lengths
    buffer = pa.allocate_buffer(int(ends[-1, -1]) if len(ends) else 0)
    out = np.frombuffer(buffer, np.uint8)
    for i, (data, begin, size) in enumerate(parts):
        _scatter(out, starts[:, i], data, begin, size)
    # headers and footers are ASCII, so only names and texts have other lengths in code points
    points = lengths.copy()
    points[:, 1], points[:, 3] = (pc.utf8_length(x).to_numpy(zero_copy_only=False) for x in (named, escaped))
    point_ends = np.cumsum(points.ravel()).reshape(points.shape)
    with_zero = lambda x: np.concatenate([[0], x]).astype(np.int64)
    return Formatted(buffer, with_zero(ends[:, -1]), with_zero(point_ends[:, -1]), point_ends[:, 3] - points[:, 3], point_ends[:, 3])


def units(changes: np.ndarray, sizes: np.ndarray, part: int, most: int) -> list[tuple[int, int, int, bool]]:
    """(first row, end row, part, whether the conversation ends) of what is written as one row each.

    changes says which rows begin a conversation other than the row before
    has; the first row goes on with part. A part ends after the turn by which
    it has most bytes. The last unit is open: what follows is not known.
    """
    found = []
    starts = [0, *np.flatnonzero(changes[1:]) + 1]
    total = np.concatenate([[0], np.cumsum(sizes)])
    for start, end in zip(starts, [*starts[1:], len(changes)], strict=True):
        while total[end] - total[start] >= most:
            cut = int(np.searchsorted(total, total[start] + most))
            if cut >= end:
                break
            found.append((int(start), cut, part, False))
            start, part = cut, part + 1
        found.append((int(start), int(end), part, True))
        part = 0
    return found


def _written(rows: pa.Table, parts: list[tuple[int, int, int, bool]]) -> pa.RecordBatch:
    """Neighbouring units as rows of the result; their text is the buffer and its offsets."""
    first, end = parts[0][0], parts[-1][1]
    rows = rows.slice(first, end - first).combine_chunks()
    roles, texts = (rows.column(c).combine_chunks() if rows.column(c).num_chunks != 1 else rows.column(c).chunk(0) for c in ("_role", "_text"))
    done = format_turns(roles, texts)
    starts = np.array([u[0] - first for u in parts])
    offsets = done.bounds[np.append(starts, end - first)]
    text = pa.StringArray.from_buffers(len(parts), pa.py_buffer(offsets.astype(np.int32)), done.buffer)
    loss = np.flatnonzero(pc.fill_null(pc.equal(roles, "assistant"), False).to_numpy(zero_copy_only=False))
    unit = np.searchsorted(starts, loss, "right") - 1
    spans = pa.array(np.searchsorted(unit, np.arange(len(parts) + 1)), pa.int32())
    own = done.chars[starts[unit]]
    losses = [pa.ListArray.from_arrays(spans, pa.array(x[loss] - own)) for x in (done.text_start, done.text_end)]
    columns = [rows.column("_conv").combine_chunks().take(pa.array(starts)), pa.array([u[2] for u in parts], pa.int32()), pa.array([u[3] for u in parts]), text, *losses]
    columns[0] = columns[0].combine_chunks() if isinstance(columns[0], pa.ChunkedArray) else columns[0]
    return pa.RecordBatch.from_arrays(columns, ["_conv", "part", "is_last", "text", "loss_starts", "loss_ends"])


def _formatted(part_bytes: int):
    def batches_of(rows: pa.Table, found: list[tuple[int, int, int, bool]], total: np.ndarray) -> Iterator[pa.RecordBatch]:
        low = 0
        for i in range(len(found)):
            if total[found[i][1]] - total[found[low][0]] > PART_BYTES and i > low:
                yield _written(rows, found[low:i])
                low = i
        if found:
            yield _written(rows, found[low:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            conversation = rows.column("_conv").combine_chunks()
            same = pc.equal(conversation[1:], conversation[:-1])
            both = pc.and_(pc.is_null(conversation[1:]), pc.is_null(conversation[:-1]))
            changes = np.append(True, ~pc.or_(pc.fill_null(same, False), both).to_numpy(zero_copy_only=False))
            sizes = pc.fill_null(pc.binary_length(rows.column("_text")), 0).to_numpy() + 32
            found = units(changes, sizes, part, part_bytes)
            total = np.concatenate([[0], np.cumsum(sizes)])
            yield from batches_of(rows, found[:-1], total)
            # the last unit may go on in the next batch
            held, part = rows.slice(found[-1][0]), found[-1][2]
        if held is not None:
            yield _written(held, [(0, held.num_rows, part, True)])
        release()

    return run


def format_chats(turns: DataFrame, *, part_bytes: int = PART_BYTES, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """_conv, part, is_last, text, loss_starts, loss_ends: formatted conversations with their loss mask.

    Turns follow in the order of turn, role and text, nulls first; a null text
    or role is empty, rows with a null conversation are one conversation, and
    repeated rows are formatted each. A conversation of over part_bytes comes
    in several rows, cut between turns; all others in one, and a turn is never
    cut, however long. Spans are in code points of the row's text and cover
    the assistants' texts. An empty table gives no rows; other columns,
    whatever their names, are not read. A task holds one Arrow batch, whose
    bytes Spark bounds, and one part.
    """
    rows = turns.select(F.col(conv_col).alias("_conv"), F.col(turn_col).alias("_turn"), F.col(role_col).alias("_role"), F.col(text_col).alias("_text"))
    rows = rows.repartition("_conv").sortWithinPartitions("_conv", "_turn", "_role", "_text").select("_conv", "_role", "_text")
    kind = rows.schema["_conv"].dataType.simpleString()
    return rows.mapInArrow(_formatted(part_bytes), f"_conv {kind}, part int, is_last boolean, text string, loss_starts array<long>, loss_ends array<long>")


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    turns = []
    for match in _TURN.finditer(text):
        if match[1] is not None:
            turns.append(("user", unescape(match[1])))
        elif match[2] is not None:
            turns.append(("assistant", unescape(match[2])))
        else:
            turns.append((unescape(match[3]), unescape(match[4])))
    return turns


def _digests(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Parts of a conversation follow one another in a partition."""
        whole = loss = None
        turns = loss_chars = formatted = 0
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if row["part"] == 0:
                    whole, loss = hashlib.sha256(), hashlib.sha256()
                    turns = loss_chars = formatted = 0
                for role, text in parse(row["text"]):
                    whole.update(f"{role}\n{text}\n".encode())
                    turns += 1
                for start, end in zip(row["loss_starts"], row["loss_ends"], strict=True):
                    own = unescape(row["text"][start:end])
                    loss.update(own.encode())
                    loss_chars += len(own)
                formatted += len(row["text"])
                if row["is_last"]:
                    rows.append({"_conv": row["_conv"], "n_turns": turns, "turns_sha256": whole.hexdigest(), "loss_chars": loss_chars, "loss_sha256": loss.hexdigest(), "formatted_chars": formatted})
            yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read_back(chats: DataFrame, *, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, from the formatted text alone: turns and loss text as digests and lengths.

    chats comes from format_chats() as it is, or written and read with its
    parts repartitioned by _conv and sorted by part.
    """
    kind = chats.schema["_conv"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = pa.schema([("_conv", to_arrow_type(kind)), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    schema = f"_conv {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return chats.mapInArrow(_digests(arrow), schema).withColumnRenamed("_conv", conv_col)


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", marks), (-7, 1, "assistant", marks)], turns.schema)
    return read_back(format_chats(turns.unionByName(own)))


OP2_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sizes AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(s>|/s>|/?INST\]|/?ROLE\]|/?TEXT\])', '\1\2\\\3', 'g')) AS n,
         length(regexp_replace(role, '([<\[])(\\*)(s>|/s>|/?INST\]|/?ROLE\]|/?TEXT\])', '\1\2\\\3', 'g')) AS r
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(CASE role WHEN 'user' THEN n + 15 WHEN 'assistant' THEN n + 9 ELSE n + r + 31 END)::BIGINT AS formatted_chars
FROM sizes GROUP BY conv_id
"""
