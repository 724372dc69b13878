"""Tokenizing whole texts with the tokenizers library, a distinct word at a time.

Both vocabularies in use never merge across a boundary between a non-space
character and the white space after it, nor across the end of a run of letters,
so a text's ids are the ids of such pieces in order. Each worker takes a
distinct piece through the library's normalizer, pre-tokenizer and model once
and joins the stored ids. Texts with control characters that the library and Python class
differently, and texts that hold the literal of an added token such as
``<|endoftext|>``, are encoded in one go by the library.
"""

from __future__ import annotations

import re
import struct
import sys
from array import array
from codecs import charmap_decode
from itertools import chain

from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

MAX_STORED = 300_000  # pieces that a store of a worker keeps in each of two generations
_PIECES = re.compile(r"\s*\S+|\s+")
_RUN = re.compile(r"( ?)([^\W\d_]*)(.*)", re.DOTALL)
_ASCII = "".join(map(chr, range(33, 127)))
_BIG_ENDIAN = sys.byteorder == "big"
_RARE_SPACE = "\t\r\x0b\x0c\x85\xa0"  # with space, line end and what is odd, all white space of Latin-1
_DOUBLE_SPACE = ("  ", " \n", "\n ", "\n\n")
_ODD_SPACE = "\x1c\x1d\x1e\x1f"


def _single_spaced(text: str) -> bool:
    """Whether all white space is single spaces and line ends between words; texts beyond Latin-1 are compared in full."""
    if any(c in text for c in _RARE_SPACE):
        return False
    try:
        text.isascii() or text.encode("latin-1")
    except UnicodeEncodeError:
        return list(chain.from_iterable(line.split(" ") for line in text.split("\n"))) == text.split()
    return not (any(c in text for c in _DOUBLE_SPACE) or text[0] in " \n" or text[-1] in " \n")


class _Stored(dict):
    """Values made on first use. Past ``keep`` of them the store starts anew and draws on the one before."""

    def __init__(self, make, keep: int):
        super().__init__()
        self.make, self.keep, self.before = make, keep, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.keep:
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value


class PieceEncoder:
    """Ids of whole texts as little-endian unsigned 16- or 32-bit integers."""

    def __init__(self, path: str, keeps_space: bool):
        """``keeps_space``: white space has ids of its own (byte-level), else it only separates words."""
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.normalized for t in added):
            raise ValueError("added tokens that are looked up in normalized text are not supported")
        # what the library may treat otherwise than a piece of a text
        self.whole = [t.content for t in added] + list(_ODD_SPACE)
        self.keeps_space = keeps_space
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = "H" if self.width == 2 else "I"
        self.normalizer, self.model = self.tokenizer.normalizer, self.tokenizer.model
        self.pre_tokenizer = self.tokenizer.pre_tokenizer
        byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        # the library's letter for each byte, from characters that hold all bytes of UTF-8 (the others never occur)
        letters = {}
        for c in map(chr, (*range(0x800), *range(0x800, 0xD800, 0x800), *range(0xE000, 0x110000, 0x1000))):
            letters.update(zip(c.encode(), byte_level.pre_tokenize_str(c)[0][0]))
        self.byte_letters = "".join(letters.get(b, "\ufffe") for b in range(256))
        self.pieces = _Stored(self._piece, MAX_STORED)
        self.spaced = _Stored(self._spaced, MAX_STORED)
        self.space = letters[32]
        self.tokenize = self.model.tokenize
        self.packers = [struct.Struct(f"<{n}{self.kind}").pack for n in range(12)]
        # where the normalizer does no more to ASCII than lower its case, str.lower is a shorter way
        self.lowers = self.normalizer is not None and self.normalizer.normalize_str(_ASCII) == _ASCII.lower()

    def _bytes(self, ids: list[int]) -> bytes:
        out = array(self.kind, ids)
        if _BIG_ENDIAN:
            out.byteswap()
        return out.tobytes()

    def _word(self, word: str) -> bytes:
        ids = [t.id for t in self.tokenize(word)]
        n = len(ids)
        return self.packers[n](*ids) if n < len(self.packers) else self._bytes(ids)

    def _normal(self, piece: str) -> str:
        if self.normalizer is None:
            return piece
        return piece.lower() if self.lowers and piece.isascii() else self.normalizer.normalize_str(piece)

    def _piece(self, piece: str) -> bytes:
        if piece.isalpha():
            return self._letters(piece, False)
        space, letters, rest = _RUN.match(piece).groups()
        # İ, for one, ends in a mark when lowered, which belongs to the word after it
        if letters and rest and rest[0].isascii() and self._normal(letters).isalpha():
            return (self.spaced if space else self.pieces)[letters] + self.pieces[rest]
        if letters and not rest:
            return self._letters(letters, bool(space))
        return self._pre_tokenized(piece)

    def _spaced(self, word: str) -> bytes:
        """A word behind a space, or with the line end that stands before it."""
        if word[0] == "\n":
            return self.pieces["\n"] + self.pieces[word[1:]]
        return self._letters(word, True) if word.isalpha() else self._piece(" " + word)

    def _letters(self, letters: str, space: bool) -> bytes:
        """A run of letters, which is one word of the model if it still is one when normalized."""
        word = letters if self.normalizer is None else self._normal(letters)
        if not word.isascii():
            if self.normalizer is not None and not word.isalpha():
                return self._pre_tokenized(" " + letters if space else letters)
            # its bytes in the library's own alphabet; ASCII letters stand for themselves
            word = charmap_decode(word.encode(), "strict", self.byte_letters)[0]
        elif not word.isalpha():
            return self._pre_tokenized(" " + letters if space else letters)
        return self._word(self.space + word if space else word)

    def _pre_tokenized(self, piece: str) -> bytes:
        return b"".join([self._word(w) for w, _ in self.pre_tokenizer.pre_tokenize_str(self._normal(piece))])

    def _text(self, text: str) -> bytes:
        if any(c in text for c in self.whole):
            return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if self.lowers and text.isascii():
            text = text.lower()
        if not self.keeps_space:
            return b"".join(map(self.pieces.__getitem__, text.split()))
        if not _single_spaced(text):
            return b"".join(map(self.pieces.__getitem__, _PIECES.findall(text)))
        # every white space is a single space or line end between two words: a word goes with the one before it
        first, *words = text.replace("\n", " \n").split(" ")
        return self.pieces[first] + b"".join(map(self.spaced.__getitem__, words))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """One bytes object per text; null and empty texts give no ids."""
        return [self._text(t) if t else b"" for t in texts]


_loaded: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, keeps_space: bool) -> PieceEncoder:
    """The encoder of this worker process; its stored pieces serve all tasks that run here."""
    key = (path, keeps_space)
    if key not in _loaded:
        _loaded[key] = PieceEncoder(path, keeps_space)
    return _loaded[key]
