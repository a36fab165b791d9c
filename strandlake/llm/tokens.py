"""Token ids by the tokenizers library, with a memo of the pieces between spaces.

Both kinds of vocabulary used here cut a text at white space before merging, so the ids
of a text are those of its space-separated pieces one after another. A piece met before
is not encoded again: its ids are kept as bytes, within a bound. A new piece that is a
plain word, perhaps with one mark behind it, goes straight to the library's BPE model;
any other goes through the whole tokenizer. So does a whole text in which the string of a
special token may stand: by default it becomes that token's id, as the library has it;
``special_as_text`` takes such strings for ordinary text instead.
"""

from __future__ import annotations

import ctypes
import gc
import re
import unicodedata
from array import array

#: Pieces in each of the two generations that one Python worker remembers, per vocabulary.
MEMO_PIECES = 500_000
#: Longer pieces are encoded but not remembered.
MEMO_CHARS = 48

_word = re.compile(r"(\n?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!]?)")
#: What every special token of these vocabularies begins with.
MARK = "<|"
#: White space in a piece beyond one line break before it.
_odd_space = re.compile(r"\A\n?\Z|.\s|\A[^\S\n]|[\x1c-\x1f\x85]", re.S)
_encoders: dict[tuple, "Encoder"] = {}


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes each byte as a printable character: itself or one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Memo(dict):
    """Piece -> ids as bytes; None: the text needs the whole tokenizer."""

    def __init__(self, tokenizer, leading_space: bool):
        super().__init__()
        self.older: dict[str, bytes | None] = {}
        self.tokenizer, self.model, self.leading_space = tokenizer, tokenizer.model, leading_space
        self.letters = _byte_letters()
        self.space = self.letters[32] if leading_space else ""
        self.marks = {c: self.encoded(c) for c in ".,!\n"}

    def __missing__(self, piece: str) -> bytes | None:
        found = self.older.pop(piece, 0)
        if found == 0:
            found = self.new(piece)
        if len(piece) <= MEMO_CHARS:
            self[piece] = found
        return found

    def age(self) -> None:
        """Between texts: what wasn't used for a whole generation is forgotten."""
        if len(self) > MEMO_PIECES:
            self.older = dict(self)
            self.clear()

    def new(self, piece: str) -> bytes | None:
        m = _word.fullmatch(piece)
        if m and (self.leading_space or not m[1]):
            line, word, mark = m.groups()
            if mark:
                return self[line + word] + self.marks[mark]
            if self.leading_space:
                return (self.marks[line] + self.merged(word)) if line else self.merged(word, self.space)
            # lower case and composed form, as the vocabulary's normaliser has them for these letters
            return self.merged(unicodedata.normalize("NFC", word).lower())
        if not self.leading_space:
            return self.encoded(piece)
        return None if _odd_space.search(piece) else self.encoded(piece if piece[0] == "\n" else " " + piece)

    def merged(self, word: str, space: str = "") -> bytes:
        letters = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return array("H", [t.id for t in self.model.tokenize(space + letters)]).tobytes()

    def encoded(self, text: str) -> bytes:
        return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


class Encoder:
    """Texts to ids of 16 bits each, in the machine's (little-endian) order.

    ``leading_space``: the vocabulary joins a space to the word after it (byte-level
    BPE); otherwise it is lower-cased and white space only separates.
    """

    def __init__(self, path: str, leading_space: bool, special_as_text: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.mark = None if special_as_text else MARK
        if not all(t.content.startswith(MARK) for t in self.tokenizer.get_added_tokens_decoder().values()):
            raise ValueError("added tokens that don't begin with <| aren't supported")
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of over 16 bits aren't supported")
        self.leading_space = leading_space
        self.memo = Memo(self.tokenizer, leading_space)

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of every text, as bytes."""
        self.memo.age()
        return [self.one(t) if t else b"" for t in texts]

    def one(self, text: str) -> bytes:
        if self.mark and self.mark in text:
            return self.memo.encoded(text)
        get = self.memo.__getitem__
        if not self.leading_space:
            return b"".join(map(get, text.replace("\n", " ").split(" ")))
        pieces = text.replace("\n", " \n").split(" ")
        pieces[0] = "\n" + pieces[0]  # no space before the first piece: a line break, one id, stands in
        try:
            return b"".join(map(get, pieces))[2:]
        except TypeError:  # None: white space that the vocabulary joins differently
            return self.memo.encoded(text)


def encoder(path: str, leading_space: bool, special_as_text: bool = False) -> Encoder:
    """One per Python worker; a worker that is used again keeps it."""
    key = (path, leading_space, special_as_text)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def forget() -> None:
    """Frees the memory of this worker's encoders, for operators that don't encode, and gives it back to the system."""
    if _encoders:
        _encoders.clear()
        gc.collect()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # GNU's C library has it
        if trim:
            trim(0)
