"""Token counts by a public tokenizer's own library.

An Arrow function receives batches of UTF-8 texts. For vocabularies that drop
white space, ASCII white space is a safe boundary: no token reaches across it.
There, texts are cut into words, the words not met before are encoded in
batches balanced by bytes, and a text's length is the sum over its words. For
byte-level and sentencepiece vocabularies a space between two ASCII letters or
digits is one, if the rules of the file say so; long texts are cut there and
encoded in batches balanced by bytes. Whether a boundary is safe, and whether
letters are lower-cased, is read from the file and not assumed.
Only lengths (or ids, for packing) are kept, never the library's encodings.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm.common import content, kept, release, table

#: Bytes of text that are encoded in one call.
BATCH_BYTES = 256 << 10
#: Longer texts are cut at safe boundaries into pieces of about this size.
PIECE_BYTES = 1 << 20
#: Words that a worker remembers; beyond, it starts anew.
REMEMBERED = 700_000


def public_vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _by_bytes(items: Iterable[str], most: int = BATCH_BYTES) -> Iterator[list[str]]:
    batch, size = [], 0
    for item in items:
        batch.append(item)
        size += len(item) if item.isascii() else len(item.encode())
        if size >= most:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


#: A space between two ASCII letters or digits, where a long text can be cut.
_BETWEEN = re.compile(rb"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


def safe_pieces(text: bytes, keep_space: bool, most: int = PIECE_BYTES) -> Iterator[bytes]:
    """The text cut at spaces between ASCII letters or digits into pieces of about most bytes; the space begins the next piece or goes."""
    start = 0
    while len(text) - start > most:
        match = _BETWEEN.search(text, start + most)
        if not match:
            break
        yield text[start : match.start()]
        start = match.start() if keep_space else match.end()
    yield text[start:]


def pieces(text: bytes, most: int = PIECE_BYTES) -> Iterator[bytes]:
    """The text cut at ASCII white space into pieces of about most bytes.

    A run without white space is never cut, however long it is.
    """
    start = 0
    while len(text) - start > most:
        end = start + most
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield text[start:end]
        start = end
    yield text[start:]


class Encoder:
    """Encodes batches with the library that the vocabulary file belongs to.

    value is what is kept of a list of ids: len, or another function by which
    concatenated lists have added values.
    """

    #: Lower-case letters that no normaliser changes, then marks that never join a letter's token.
    PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+([.,;:!?]*)")
    #: Plain words encoded as one text.
    TOGETHER = 500

    def __init__(self, path: str, value: Callable[[list[int]], object] = len, remembered: int | None = None):
        self.remembered = remembered or REMEMBERED
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.value, self.known, self.ends, self.lower, self.specials = value, {}, None, False, []
        #: Whether a long text can be cut at spaces: None if not, else whether the space stays.
        self.cut: bool | None = None
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.words, self._ids = False, lambda batch: model.encode(batch, num_threads=1)
            # no piece reaches from a word over its end, and each text begins like a word after a space
            inside = any("\u2581" in model.id_to_piece(i).lstrip("\u2581") for i in range(model.vocab_size()))
            self.cut = False if not inside and model.encode("x", out_type=str)[0].startswith("\u2581") else None
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            with open(path, encoding="utf-8") as file:
                rules = json.load(file)
            self.words, self.lower = drops_white_space(rules), lower_cases(rules)
            self.specials = [x["content"].lower().encode() for x in rules["added_tokens"]]
            # a byte-level splitter begins a word with the space before it
            self.cut = True if cuts_before_spaces(rules) else None
            self._ids = lambda batch: [x.ids for x in model.encode_batch_fast(batch, add_special_tokens=False)]
            suffix = getattr(model.model, "end_of_word_suffix", None)
            if self.words and suffix:
                vocabulary = model.get_vocab()
                self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
                self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def encode(self, texts: Iterable[str]) -> Iterator[object]:
        for batch in _by_bytes(texts):
            yield from map(self.value, self._ids(batch))

    def whole(self, texts: Iterable[bytes]) -> Iterator[list]:
        """For each text the values of its pieces in order, for vocabularies that are not encoded by words."""

        def cut(text: bytes) -> list[str]:
            found = safe_pieces(text, self.cut) if self.cut is not None and len(text) > PIECE_BYTES else [text]
            return [x.decode("utf-8", "replace") for x in found]

        group, size = [], 0
        for text in texts:
            group.append(cut(text))
            size += len(text)
            if size > PIECE_BYTES:
                yield from self._of(group)
                group, size = [], 0
        yield from self._of(group)

    def _of(self, group: list[list[str]]) -> Iterator[list]:
        values = self.encode(chain.from_iterable(group))
        for own in group:
            yield [next(values) for _ in own]

    def _learn(self, words: Iterable[bytes]) -> None:
        """Plain words are encoded many to a text, without their marks, and told apart by the tokens that end a word."""
        known, other, plain, marked = self.known, {}, {}, []
        for word in words:
            text = word.decode("utf-8", "replace")
            match = self.PLAIN.fullmatch(text) if self.ends is not None else None
            if not match:
                other[word] = text
            elif marks := match[1]:
                base, end = word[: -len(marks)], marks.encode()
                marked.append((word, base, end))
                if base not in known:
                    plain[base] = text[: -len(marks)]
                if end not in known:
                    other[end] = marks
            else:
                plain[word] = text
        known.update(zip(other, self.encode(other.values()), strict=True))
        keys, texts = list(plain), list(plain.values())
        starts = range(0, len(keys), self.TOGETHER)
        encoded = (ids for batch in _by_bytes(" ".join(texts[i : i + self.TOGETHER]) for i in starts) for ids in self._ids(batch))
        for first, ids in zip(starts, encoded, strict=True):
            start, group = 0, keys[first : first + self.TOGETHER]
            for key, stop in zip(group, (np.flatnonzero(self.ends[ids]) + 1).tolist(), strict=True):
                known[key] = self.value(ids[start:stop])
                start = stop
        for word, base, end in marked:
            known[word] = known[base] + known[end]

    def _split(self, piece: bytes) -> list[bytes]:
        if not self.lower:
            return piece.split()
        # lower-casing first makes one word of several, but must not make a special token
        low = piece.lower()
        return (piece if any(s in low for s in self.specials) else low).split()

    def _values(self, texts: list[bytes]) -> Iterator[map]:
        split = [self._split(t) for t in texts]
        new = set().union(*split).difference(self.known)
        if new:
            if len(self.known) + len(new) > self.remembered:
                self.known.clear()
                new = set().union(*split)
            self._learn(new)
        for words in split:
            yield map(self.known.__getitem__, words)

    def by_words(self, texts: Iterable[bytes]) -> Iterator[Iterable]:
        """For each text the values of its words in order, to be used up before the next.

        Texts are taken in groups of about PIECE_BYTES; longer ones in pieces.
        """
        group, size = [], 0
        for text in texts:
            if group and size + len(text) > PIECE_BYTES:
                yield from self._values(group)
                group, size = [], 0
            if len(text) > PIECE_BYTES:
                yield chain.from_iterable(values for piece in pieces(text) for values in self._values([piece]))
            else:
                group.append(text)
                size += len(text)
        yield from self._values(group)


def _normalisers(rules: dict) -> set[str]:
    normal = rules.get("normalizer") or {}
    return {x["type"] for x in normal.get("normalizers", [normal]) if x}


def lower_cases(rules: dict) -> bool:
    return "Lowercase" in _normalisers(rules)


def drops_white_space(rules: dict) -> bool:
    """Whether a file's rules make ASCII white space a safe boundary.

    They do if the first splitter keeps only matches of a pattern of which no
    alternative matches white space, and the normaliser works within words.
    """
    splitters = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or []
    if not splitters or splitters[0].get("type") != "Split":
        return False
    split = splitters[0]
    pattern = split["pattern"].get("Regex", " ")
    plain = not any(x["content"].split() != [x["content"]] or x["lstrip"] or x["rstrip"] for x in rules["added_tokens"])
    keeps_words = split["behavior"] == "Removed" and split["invert"] and " " not in pattern and r"\s" not in pattern.replace(r"[^\s", "[^")
    return bool(plain and keeps_words and _normalisers(rules) <= {"NFC", "NFD", "NFKC", "NFKD", "Lowercase", "Replace"})


def cuts_before_spaces(rules: dict) -> bool:
    """Whether a word always begins at a space between two letters or digits: the usual byte-level splitter, and special tokens without spaces."""
    splitter = rules.get("pre_tokenizer") or {}
    usual = splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space", False)
    plain = not any(" " in x["content"] or x["lstrip"] or x["rstrip"] for x in rules["added_tokens"])
    return bool(usual and plain and _normalisers(rules) <= {"NFC", "NFD", "NFKC", "NFKD"})


def encoder(path: str, value: Callable[[list[int]], object] = len, remembered: int | None = None) -> Encoder:
    """One encoder for each worker process, kept between tasks."""
    return kept(("tokens", path, value.__name__, remembered), lambda: Encoder(path, value, remembered))


def _counts(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(path)
        for batch in batches:
            texts = batch.column("_content")
            lengths = list(map(sum, (of.by_words if of.words else of.whole)(x.as_py() for x in texts)))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_bytes"), pa.array(lengths, pa.int64())], ["_id", "_bytes", "_tokens"])
        release()

    return count


def token_counts(docs: DataFrame, *, vocabulary: str | None = None, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Whole texts, without begin, end or added special tokens, truncation or
    padding; special strings inside texts as the library treats them by
    default. A null text is empty: 0 bytes, 0 tokens. A null id stays null,
    repeated rows are counted each, an empty table gives no rows, other
    columns, whatever their names, are not read. One narrow stage, no shuffle.
    """
    rows = docs.select(F.col(id_col).alias("_id"), content(text_col).alias("_content"))
    rows = rows.withColumn("_bytes", F.octet_length("_content").cast("long"))
    kind = rows.schema["_id"].dataType.simpleString()
    counted = rows.mapInArrow(_counts(vocabulary or public_vocabulary()), f"_id {kind}, _bytes long, _tokens long")
    return counted.select(
        F.col("_id").alias(id_col),
        F.col("_bytes").alias("n_bytes"),
        F.col("_tokens").alias("n_tokens"),
        (F.col("_tokens") > limit).alias("over_limit"),
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
