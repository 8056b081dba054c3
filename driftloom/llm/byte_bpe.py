"""Token ids of whole texts by a byte-level BPE vocabulary file, with a cache of pre-tokens."""

from __future__ import annotations

import functools
import re
import unicodedata
from array import array

import numpy as np
import regex

CACHE_PIECES = 220_000
_KEPT_LENGTH = 64
_LIMIT = 0x250  # classes of characters below are the same in every Unicode version


def _class(group: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(_LIMIT) if unicodedata.category(chr(c))[0] == group)


# The pattern is fixed by the vocabulary file; its alternatives begin with unlike characters, the most frequent come first.
_SPACE, _LETTER, _DIGIT = r"\t-\r \x85\xa0", _class("L"), _class("N")
_PIECES = re.compile(
    rf" ?[{_LETTER}]+| ?[{_DIGIT}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{_SPACE}{_LETTER}{_DIGIT}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
#: the tokenizer itself cuts texts with other characters
_RARE = regex.compile(rf"[^\x00-\u{_LIMIT - 1:04x}]")


def byte_alphabet() -> dict[int, int]:
    """Code point that stands for each byte: printable bytes for themselves, the others from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: b if b in printable else next(others) for b in range(256)}


class _Kept(dict):
    """Pre-tokens with their ids; makes what is missing.

    At ``CACHE_PIECES`` entries they become the older half, replacing the one before; those asked for again return from there.
    """

    def __init__(self, model):
        self.older: dict[str, bytes] = {}
        self.tokenize = model.tokenize
        self.alphabet = byte_alphabet()
        self.blank = chr(self.alphabet[32])

    def _ids(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            shown = piece.replace(" ", self.blank)
        else:
            shown = piece.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.tokenize(shown)]).tobytes()

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece) or self._ids(piece)
        if len(piece) <= _KEPT_LENGTH:
            if len(self) >= CACHE_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class ByteEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers, equal to those of the tokenizer.

    The model merges within pre-tokens only, so the ids of each are kept.
    ``plain``: the strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, plain: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.special = [] if plain else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kept = _Kept(self.tokenizer.model)

    def encode(self, text: str) -> bytes:
        if _RARE.search(text) or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.kept.__getitem__, _PIECES.findall(text)))

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id of the vocabulary file."""
        back = {chr(c): b for b, c in byte_alphabet().items()}
        special = self.tokenizer.get_added_tokens_decoder()
        size = self.tokenizer.get_vocab_size()
        return [
            special[i].content.encode() if i in special else bytes(back[c] for c in self.tokenizer.id_to_token(i)) for i in range(size)
        ]


@functools.lru_cache(maxsize=2)
def byte_encoder(path: str, plain: bool = False) -> ByteEncoder:
    return ByteEncoder(path, plain)
