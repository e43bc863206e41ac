"""Ids of whole texts by public byte-level and sentencepiece files, and the bytes that each id stands for.

Long texts are cut before spaces that follow a visible character. A byte-level
tokenizer with the usual pattern begins a word there, and a sentencepiece model
none of whose pieces has a space after anything else can't join across it. Both
conditions are read from the files; where they don't hold, texts stay whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np

from tidegraph.llm.common import kept
from tidegraph.llm.tokens import cuts_before_spaces

#: Letters that are encoded in one call.
PIECE = 1 << 18

#: A space after what is no white space to any of the libraries, and not the last letter: alone it would be nothing.
_SAFE = re.compile("(?<=[!-~¡-ɏ]) (?=.)", re.DOTALL)
#: Letters about whose kinds all Unicode tables agree.
_LATIN = re.compile("[^\0-ɏ]")


def cut(text: str, most: int = PIECE) -> Iterator[str]:
    """The text in pieces of about most letters, cut before safe spaces; a run without one is never cut."""
    start = 0
    while len(text) - start > most:
        match = _SAFE.search(text, start + most)
        if not match:
            break
        yield text[start : match.start()]
        start = match.start()
    yield text[start:]


_VISIBLE = {chr(i) for i in (*range(0x21, 0x7F), *range(0xA1, 0x250))}
_WORD = re.compile("(?<=[!-~¡-ɏ])(?= .)", re.DOTALL)


def words_of(text: str) -> list[str]:
    """The text cut before every safe space."""
    return _WORD.split(text)


def is_plain(word: str) -> bool:
    """Whether the word has only Latin letters and common marks, and ends in a visible one."""
    return word[-1:] in _VISIBLE and not _LATIN.search(word)


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: visible Latin-1 ones for themselves, the rest from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """A byte-level file of the library tokenizers.

    Where the merges of the file are in the order of their ids, the library
    tiktoken gives the same ids several times as fast; it then encodes texts
    of Latin letters, and tokenizers all others.
    """

    def __init__(self, path: str, plain_specials: bool):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = plain_specials
        self.safe = cuts_before_spaces(rules)
        specials = {x["content"]: x["id"] for x in rules["added_tokens"]}
        letters = byte_alphabet()
        plain = {token: i for token, i in self.model.get_vocab().items() if token not in specials}
        self.bytes = {i: bytes(letters[c] for c in token) for token, i in plain.items()} | {i: s.encode() for s, i in specials.items()}
        pairs = [x if isinstance(x, list) else x.split(" ") for x in rules["model"]["merges"]]
        self.fast = None
        if self.safe and [plain["".join(x)] for x in pairs] == list(range(256, 256 + len(pairs))) and len(plain) == 256 + len(pairs):
            import public_tokenizers
            import tiktoken

            ranks = {self.bytes[i]: i for i in plain.values()}
            fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={} if plain_specials else specials)
            self.fast = fast.encode_to_numpy
            self.allowed = set() if plain_specials else "all"

    def ids(self, text: str) -> np.ndarray:
        found = [self._ids(x) for x in cut(text)] if self.safe and len(text) > PIECE else [self._ids(text)]
        return found[0] if len(found) == 1 else np.concatenate(found)

    def reads_bytes(self, text: str) -> bool:
        """Whether the faster library reads it, of which each id is a run of the text's bytes."""
        return self.fast is not None and not _LATIN.search(text)

    def _ids(self, text: str) -> np.ndarray:
        if self.reads_bytes(text):
            return self.fast(text, allowed_special=self.allowed, disallowed_special=())
        return np.array(self.model.encode(text, add_special_tokens=False).ids, np.uint32)


class Pieces:
    """A sentencepiece file whose model puts a space before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.safe = not any("▁" in n.lstrip("▁") for n in names) and self.model.encode("x", out_type=str)[0][:1] == "▁"
        self.bytes = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]

    def list(self, text: str) -> list[int]:
        if not self.safe or len(text) <= PIECE:
            return self.model.encode(text, num_threads=1)
        # a later piece begins with the space that the model adds
        first, *others = cut(text)
        return [i for x in (first, *(o[1:] for o in others)) for i in self.model.encode(x, num_threads=1)]

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.list(text), np.uint32)


def byte_level(path: str, *, plain_specials: bool) -> ByteLevel:
    """One for each worker process, kept between tasks."""
    return kept(("byte level", path, plain_specials), lambda: ByteLevel(path, plain_specials))
