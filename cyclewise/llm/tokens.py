"""Token ids of whole texts with a tokenizer file, through a bounded cache of the pieces between white space.

Both kinds of tokenizer used here split a text at every change from non-white to ASCII white space, so a
text's ids are the ids of its pieces in order.  A piece that is not in the cache goes through the library's
own normalizer, pre-tokenizer and model; for letters with punctuation behind them, which are two pre-tokens,
the letters are a piece of their own, what the first two make of each letter is kept, and only the model is asked.
"""

from __future__ import annotations

import json
import re
import string
import unicodedata
from array import array

from tokenizers import Tokenizer

#: Entries of a generation of the caches of pieces and of pre-tokens, two generations each; about 190 bytes an entry:
#: 210 MB a Python worker at most.  Runs of signs behind words have a small cache of their own.
CACHE_PIECES, CACHE_WORDS, CACHE_TAILS = 400_000, 50_000, 5_000

_PIECE = re.compile(rb"[ \t\n\r\x0b\f]*[^ \t\n\r\x0b\f]+|[ \t\n\r\x0b\f]+")
#: ASCII punctuation without the apostrophe, which takes letters behind it into its pre-token.
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_SIGN_BYTES = _SIGNS.encode()
_LOOSE = re.compile(rb" [ \t\n\r\x0b\f]")
#: A line's end that is not by itself between two other signs than ASCII white space; and the same for texts that have
#: only blanks and line ends, in which the search is for one sign.
_LINES = re.compile(rb"\n(?:[ \t\n\r\x0b\f]|\Z)|[\t\r\x0b\f]\n")
_PLAIN_LINES = re.compile(rb"\n(?:[ \n]|\Z)")
_RARE_SPACE = b"\t\r\x0b\f"
_NONE = "\0"


class _Kept(dict):
    """A cache of two generations: a full one becomes the older, and what is found there moves to the new one."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class _Spaced(Exception):
    """White space beyond ASCII at a piece's end."""


class _Letters(dict):
    """For ``str.translate``: what a letter is to the model, or NUL if it is not one pre-token by itself."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, code):
        self[code] = value = self.make(chr(code)) or _NONE
        return value


class Encoder:
    """Encodes texts as the tokenizer file does with add_special_tokens=False."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.added = tuple(t["content"] for t in spec.get("added_tokens", []))
        #: white space never reaches a token: pieces need not carry it
        self.drops_space = "Removed" in json.dumps(spec.get("pre_tokenizer"))
        self.lowers = self._normal("ABC") == "abc"
        self.words = _Kept(self._word_ids, CACHE_WORDS)
        self._tokenize = self.tokenizer.model.tokenize
        self.letters = _Letters(self._letter)
        self.tails = _Kept(self._whole, CACHE_TAILS)
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        start = cut(" a")
        self.start = start[0][0][:-1] if len(start) == 1 and start[0][0].endswith("a") else None
        lines = [w for w, _ in cut("a\nb")]
        #: the ids of a line's end between two words, if it is one pre-token there
        self.line = self.words[lines[1]] if not self.drops_space and len(lines) == 3 and lines[::2] == ["a", "b"] else None
        #: ASCII letters are to the model what they are in the text, lower-cased where the tokenizer does so
        letters = string.ascii_letters
        self.same = letters.translate(self.letters) == (letters.lower() if self.lowers else letters)
        # where white space is dropped all pieces are plain; else nearly all follow a blank
        self.plain = _Kept(self._maker(""), CACHE_PIECES if self.drops_space else CACHE_PIECES // 4)
        self.spaced = _Kept(self._maker(" "), CACHE_PIECES)

    def _normal(self, text: str) -> str:
        return self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer is not None else text

    def _letter(self, c: str) -> str | None:
        """What a letter is to the model, or None if it is not one pre-token by itself."""
        parts = self.tokenizer.pre_tokenizer.pre_tokenize_str(self._normal(c))
        return parts[0][0] if len(parts) == 1 and self._normal(c).isalpha() else None

    def _word_ids(self, word: str) -> bytes:
        return array("I", [t.id for t in self._tokenize(word)]).tobytes()

    def _maker(self, blank: str):
        """A function from a piece's bytes to its ids, or to those of a blank and the piece behind it.

        Pieces behind a blank may begin with a line's end, which then stands for the blank.
        """
        tails, letters, lowers, word_ids = self.tails, self.letters, self.lowers, self._word_ids
        lead = self.start if blank else ""
        ascii_words, all_words = self.start is not None and self.same, self.start is not None
        plain = self._maker("") if blank else None

        def make(raw: bytes) -> bytes:
            if blank and raw[:1] == b"\n":
                return self.line + plain(raw[1:])
            head = raw.rstrip(_SIGN_BYTES)
            if ascii_words and raw.isascii():
                if head.isalpha():
                    if len(head) < len(raw):
                        return (self.spaced if blank else self.plain)[head] + tails[raw[len(head) :].decode()]
                    return word_ids(lead + (head.lower() if lowers else head).decode())
            elif all_words:
                word = head.decode("utf-8", "surrogatepass")
                if word.isalpha() and unicodedata.is_normalized("NFC", word):
                    word = word.translate(letters)
                    if _NONE not in word:
                        if len(head) < len(raw):
                            return (self.spaced if blank else self.plain)[head] + tails[raw[len(head) :].decode()]
                        return word_ids(lead + word)
            piece = raw.decode("utf-8", "surrogatepass")
            if not self.drops_space and not raw.isascii() and (piece[0].isspace() or piece[-1].isspace()):
                raise _Spaced  # one run of white space with what is beyond the piece
            return self._whole(blank + piece)

        return make

    def _whole(self, piece: str) -> bytes:
        tok = self.tokenizer
        if any(a in piece for a in self.added):
            return array("I", tok.encode(piece, add_special_tokens=False).ids).tobytes()
        return b"".join([self.words[w] for w, _ in tok.pre_tokenizer.pre_tokenize_str(self._normal(piece))])

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        try:
            return self._joined(text)
        except _Spaced:
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _joined(self, text: str) -> bytes:
        raw = text.encode("utf-8", "surrogatepass")
        if self.drops_space:
            return b"".join(map(self.plain.__getitem__, (raw.lower() if self.lowers else raw).split()))
        if _LOOSE.search(raw):
            return b"".join(map(self.plain.__getitem__, _PIECE.findall(raw)))
        if self.line is not None and b"\n" in raw:
            lines = _PLAIN_LINES if len(raw.translate(None, _RARE_SPACE)) == len(raw) else _LINES
            if not lines.search(raw):
                raw = raw.replace(b"\n", b" \n")
        first, *rest = raw.split(b" ")
        return self.plain[first] + b"".join(map(self.spaced.__getitem__, rest)) if first else b"".join(map(self.spaced.__getitem__, rest))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This process's encoder of a file: Python workers keep it from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
