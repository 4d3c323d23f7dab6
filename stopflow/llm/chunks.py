"""Encoding of whole texts chunk by chunk with a public tokenizer.

A text is cut where the tokenizer never merges across, each distinct chunk is
encoded by the tokenizer once and kept in a bounded cache, and the text's ids
are its chunks' ids in order.  Texts whose white space or special strings make
cutting unsafe go to the tokenizer whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Chunks longer than this are encoded but not kept, and a cache is emptied
# once it holds so many: both bound a worker's memory.
LONGEST_KEPT, MOST_KEPT = 64, 400_000
# Texts are encoded together in groups of about so many bytes.
GROUP_BYTES = 8 << 20
# What marks a text's first chunk while the chunks of a group are told apart.
_FIRST = "\0"

_SPACED = re.compile(r" ?[^ \n]+|[ \n]+(?![^ \n])|[ \n]+")
# White space but space and line feed, and the runs that a space can't be split at.
_OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_RUNS = ("  ", "\n\n", " \n", "\n ")
# Letters (ASCII and Latin-1, each its own NFC form), then punctuation without
# apostrophes: what pre-tokenizers cut into just these two pieces.
_LATIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
_MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level tokenizers show bytes as: printable ones themselves, others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(others)}


_LETTERS = _byte_letters()


def load(path: str):
    """The tokenizer in ``path``, single-threaded as one task has one core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def words(text: str) -> list[str]:
    """Chunks for tokenizers that drop white space and never merge across it."""
    return list(filter(None, text.replace("\n", " ").split(" ")))


class _Kept(dict):
    """Values by key, made when first asked for and kept if the key is short."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(key) <= LONGEST_KEPT:
            self[key] = value
        return value


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers.

    ``spaced``: the tokenizer keeps case and white space and joins one space
    to the word after it; otherwise it lowers case and drops white space.
    """

    def __init__(self, path: str, spaced: bool):
        self.tok, self.spaced = load(path), spaced
        self.model = self.tok.model
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.chunks, self.pieces, self.after = _Kept(self._chunk), _Kept(self._piece), _Kept(self._after_space)
        self.unsafe = "|".join(map(re.escape, (*_OTHER_SPACE, *self.special, *_RUNS, _FIRST)))

    def _piece(self, piece: str) -> bytes:
        if piece.isascii():
            shown = _LETTERS[32] + piece[1:] if piece[:1] == " " else piece
        else:
            shown = piece.encode().decode("latin-1").translate(_LETTERS)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _after_space(self, part: str) -> bytes:
        """What stands between two single spaces; a line feed at its start took the place of the first."""
        return self._chunk("\n") + self._chunk(part[1:]) if part[:1] == "\n" else self._chunk(part, " ")

    def _chunk(self, chunk: str, before: str = "") -> bytes:
        """The ids of ``before``, a space or nothing, and ``chunk``."""
        word = chunk.rstrip(_MARKS)
        letters = word if before or word[:1] != " " else word[1:]
        if letters.isalpha() and (letters.isascii() or _LATIN.fullmatch(letters)):
            ids = self.pieces[before + word if self.spaced else word.lower()]
            return ids + self.pieces[chunk[len(word):]] if len(word) < len(chunk) else ids
        return array("I", self.tok.encode(before + chunk, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        """The whole text's ids."""
        for kept in (self.chunks, self.pieces, self.after):
            if len(kept) > MOST_KEPT:
                kept.clear()
        if not self.spaced:
            return b"".join(map(self.chunks.__getitem__, words(text)))
        if any(s in text for s in (*_OTHER_SPACE, *self.special)):
            return self._chunk(text)
        if any(s in text for s in _RUNS):
            return b"".join(map(self.chunks.__getitem__, _SPACED.findall(text)))
        first, *rest = text.replace("\n", " \n").split(" ")
        return b"".join([self._chunk(first), *map(self.after.__getitem__, rest)])


    def encode_many(self, texts: pa.Array) -> Iterator[bytes]:
        """Each text's ids as ``encode`` gives them; a null text is empty.

        A group's chunks are told apart at once, each distinct one is looked
        up once, and the ids are taken by position.
        """
        texts = texts if pa.types.is_large_string(texts.type) else texts.cast(pa.large_string())
        texts = texts.fill_null("") if texts.null_count else texts
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) if len(texts) else np.zeros(0, np.int64)
        a = 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + GROUP_BYTES, "right")))
            yield from self._group(texts.slice(a, b - a))
            a = b

    def _group(self, texts: pa.Array) -> Iterator[bytes]:
        for kept in (self.chunks, self.pieces, self.after):
            if len(kept) > MOST_KEPT:
                kept.clear()
        if self.spaced:
            unsafe = pc.match_substring_regex(texts, self.unsafe).to_numpy(zero_copy_only=False)
            if unsafe.any():
                safe = self._gathered(texts.filter(pa.array(~unsafe)))
                for text, alone in zip(texts, unsafe.tolist(), strict=True):
                    yield self.encode(text.as_py()) if alone else next(safe)
                return
        yield from self._gathered(texts)

    def _gathered(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of texts that may be cut at every single space."""
        if not len(texts):
            return
        if self.spaced:
            texts = pc.binary_join_element_wise(pa.scalar(_FIRST, pa.large_string()), pc.replace_substring(texts, "\n", " \n"), pa.scalar("", pa.large_string()))
        else:
            texts = pc.replace_substring(texts, "\n", " ")
        parts = pc.split_pattern(texts, " ")
        coded = parts.flatten().dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if self.spaced:
            ids = [self._after_space(x) if x[:1] != _FIRST else self._chunk(x[1:]) for x in names]
        else:
            ids = [self._chunk(x) if x else b"" for x in names]
        placed = pa.array(ids, pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(placed.buffers()[1], np.int64)
        data = memoryview(placed.buffers()[2] or b"")
        bounds = ends[parts.offsets.to_numpy() - parts.offsets[0].as_py()].tolist()
        for x, y in zip(bounds[:-1], bounds[1:], strict=True):
            yield bytes(data[x:y])


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, spaced: bool) -> Encoder:
    """This worker's encoder, kept between tasks."""
    if (path, spaced) not in _encoders:
        _encoders[path, spaced] = Encoder(path, spaced)
    return _encoders[path, spaced]
