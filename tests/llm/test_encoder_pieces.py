"""The encoder's pieces: white space beyond ASCII, line ends and signs behind words."""

import numpy as np
import pytest
from tokenizers import Tokenizer

from cyclewise.llm import tokens
from cyclewise.llm.queries import tokenizer_file
from cyclewise.llm.tokens import Encoder

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def ids(enc, text):
    return np.frombuffer(enc.encode(text), "<u4").tolist()


@pytest.mark.parametrize("name", FILES)
def test_wide_white_space_beside_blanks(name):
    tok, enc = Tokenizer.from_file(tokenizer_file(name)), Encoder(tokenizer_file(name))
    texts = [" \xa0 \xa0", "!\xa0\nCd, \xa0 \xa0", "a 　 b", "a\n　　b", "a　\nb", "\n \n", "\x85 a", "İ, b", "é,\nÉ.\n\nß"]
    for t in texts:
        assert ids(enc, t) == tok.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("name", FILES)
def test_line_ends_and_signs_need_no_new_cut(name, monkeypatch):
    tok, enc = Tokenizer.from_file(tokenizer_file(name)), Encoder(tokenizer_file(name))
    ids(enc, "dos ado., été raraes")

    def cut(*_):
        raise AssertionError("letters, signs behind them and single line ends are known")

    monkeypatch.setattr(enc, "_whole", cut)
    text = "dos., été.,\nraraes ado\ndos\nÉté raraes.,"
    assert ids(enc, text) == tok.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
def test_word_behind_which_signs_change_is_asked_once(name, monkeypatch):
    tok, enc = Tokenizer.from_file(tokenizer_file(name)), Encoder(tokenizer_file(name))
    ids(enc, "x qzvamor. a, b;")

    def asked(word):
        raise AssertionError(f"{word} again")

    monkeypatch.setattr(enc, "_tokenize", asked)
    text = "x qzvamor, qzvamor; qzvamor"
    assert ids(enc, text) == tok.encode(text, add_special_tokens=False).ids
    monkeypatch.undo()
    enc.tails.limit = 10
    signs = " ".join("a" + "!?.,"[i % 4] * (i + 1) for i in range(60))
    assert ids(enc, signs) == tok.encode(signs, add_special_tokens=False).ids
    assert len(enc.tails) + len(enc.tails.older) <= 20


def test_pieces_stay_known(monkeypatch):
    """450,000 different pieces later a piece is still in one of the cache's generations."""
    tok, enc = Tokenizer.from_file(tokenizer_file(FILES[0])), Encoder(tokenizer_file(FILES[0]))
    abc = "abcdefghijklmnopqrstuvwxyz"
    words = [a + b + c + d for a in abc for b in abc for c in abc for d in abc][:450_000]
    ids(enc, "x " + " ".join(words))

    def asked(word):
        raise AssertionError(f"{word} again")

    monkeypatch.setattr(enc, "_tokenize", asked)
    text = "x " + " ".join(words[:100])
    assert ids(enc, text) == tok.encode(text, add_special_tokens=False).ids


def test_line_ends_beside_white_space(monkeypatch):
    """Texts with only blanks and line ends need no search for the rarer white space; others get it."""
    tok, enc = Tokenizer.from_file(tokenizer_file(FILES[0])), Encoder(tokenizer_file(FILES[0]))
    space = ["\n", " ", "\t", "\r", "\x0b", "\f"]
    for gap in [a + b + c for a in ["", *space] for b in ["", *space] for c in space]:
        for t in (f"dos{gap}ado, été", f"dos ado{gap}", f"{gap}dos.\nado", f"dos\nado{gap}été\ndos"):
            assert ids(enc, t) == tok.encode(t, add_special_tokens=False).ids, repr(t)

    class Asked:
        def search(self, raw):
            raise AssertionError("searched for rare white space")

    monkeypatch.setattr(tokens, "_LINES", Asked())
    for t in ("dos ado.\nÉté, ado\ndos", "dos\n\nado", "dos\n ado", "dos ado\n"):
        assert ids(enc, t) == tok.encode(t, add_special_tokens=False).ids, repr(t)
