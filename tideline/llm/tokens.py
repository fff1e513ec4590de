"""Token ids of whole texts by the tokenizers library, with a bounded cache of pieces."""

from __future__ import annotations

import os
import re
import struct
from array import array

import numpy as np

TOKENIZER = "byte_bpe_50k.json"


def default_path() -> str:
    """Where the installed vocabulary file is; executors resolve it for themselves."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


#: A piece that splits into one word and its punctuation whatever the Unicode tables of a regex engine.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-/:-@\[-`{-~]*)")
_PACK = [struct.Struct(f"={n}I").pack for n in range(16)]
_MARKS = "".join(chr(b) for a, z in ((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)) for b in range(a, z + 1))
#: A space that starts no piece: white space follows it, or another space stands before it, or the text ends.
_ODD = re.compile(r" (?:\s|$)")


def _byte_characters() -> dict[int, str]:
    """The character by which a byte-level vocabulary writes each byte: itself if printable, else the next from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


#: Characters of a piece that is kept, at most; longer ones (encoded data) rarely come again.
LONGEST = 64


class _Pieces(dict):
    """Ids of pieces as bytes. A piece that isn't here is encoded, or fetched from the generation before."""

    def __init__(self, owner: Encoder, prefix: str) -> None:
        super().__init__()
        self.owner, self.prefix, self.old = owner, prefix, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.owner.piece(self.prefix, piece)
        if len(piece) <= LONGEST:
            self[piece] = ids
        return ids

    def age(self, most: int) -> None:
        if len(self) > most:
            self.old = dict(self)
            self.clear()


class Encoder:
    """Encodes texts with a byte-level BPE tokenizer.

    Such a tokenizer splits a text before every space that a non-space character follows, and encodes each piece by
    itself. So pieces are cut there first and only pieces that are new are handed to the library: natural text repeats
    most of them. Plain pieces (a word with punctuation, between line ends) go to the library's BPE model directly,
    all others through its whole chain. The cache keeps two generations of at most `most` pieces each, none of
    them long, which bounds its bytes. Exactness against encoding whole texts is
    tested.
    """

    def __init__(self, path: str | None = None, most: int = 500_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path or default_path()), most
        self.model, self.table = self.tokenizer.model, _byte_characters()
        self.line = self._model("\n")
        self.first, self.later = _Pieces(self, ""), _Pieces(self, " ")

    def _model(self, part: str) -> bytes:
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(self.table)
        elif part[0] == " ":
            part = self.table[0x20] + part[1:]
        elif part == "\n":
            part = self.table[0x0A]
        ids = [t.id for t in self.model.tokenize(part)]
        return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else array("I", ids).tobytes()

    def piece(self, prefix: str, piece: str) -> bytes:
        """The ids of prefix + piece, as the bytes of unsigned 32-bit integers."""
        word = piece.rstrip(_MARKS)
        if word.isascii() and word.isalpha():  # the most usual of the plain pieces, without a pattern
            if len(word) == len(piece):
                return self._model(prefix + piece)
            return (self.later if prefix else self.first)[word] + self.first[piece[len(word) :]]
        if (m := _PLAIN.fullmatch(piece)) and piece:
            word, marks = m.groups()
            if not word or not marks:
                return self._model(prefix + piece)
            return (self.later if prefix else self.first)[word] + self.first[marks]
        if "\n" in piece and all(map(_PLAIN.fullmatch, lines := piece.split("\n"))) and all(lines):
            start = self.later if prefix else self.first
            return start[lines[0]] + b"".join(self.line + self.first[x] for x in lines[1:])
        return array("I", self.tokenizer.encode(prefix + piece, add_special_tokens=False).ids).tobytes()

    def _odd(self, parts: list[str]) -> bytes:
        """For a text with spaces that start no piece: they stay with what stands before them."""
        out = [parts[0]]
        for part in parts[1:]:
            if part and not part[0].isspace():
                out.append(part)
            else:
                out[-1] += f" {part}"
        return self.first[out[0]] + b"".join(map(self.later.__getitem__, out[1:]))

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text as unsigned 32-bit integers."""
        out = []
        for text in texts:
            parts = text.split(" ")
            if _ODD.search(text):
                ids = self._odd(parts)
            else:
                ids = self.first[parts[0]] + b"".join(map(self.later.__getitem__, parts[1:])) if text else b""
            out.append(np.frombuffer(ids, dtype=np.uint32))
            self.first.age(self.most // 4)
            self.later.age(self.most)
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """One encoder for each worker process and path."""
    key = path or default_path()
    if key not in _encoders:
        _encoders[key] = Encoder(key)
    return _encoders[key]
