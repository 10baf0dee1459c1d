"""A small corpus with every odd row: nulls, empties, ties, repeated rows, very long texts, clashing columns."""

from __future__ import annotations

import random

import pytest

SYLLABLES = {
    "en": "th er on an re he in ed nd ha at en es of or nt ea ti to it st".split(),
    "fr": "es le de en re nt on er te el an se et la ai it me ou em ie é è".split(),
    "de": "en er ch de ei nd te in ie ge es ne un st re he an be se au ü ä".split(),
}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept boolean, piece string"


def prose(rng: random.Random, lang: str, n: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


def odd_rows():
    rng = random.Random(7)
    rows = []

    def add(text, lang="en", source="s1", doc_id=-1):
        rows.append((len(rows) if doc_id == -1 else doc_id, text, lang, source, len(text or ""), 5, True, "x"))

    for i in range(36):
        lang = ("en", "fr", "de")[i % 3]
        add(prose(rng, lang, rng.randint(20, 160)) + ".", lang, ("s1", "s2", "s3", None)[i % 4])
    base = rows[0][1]
    for k in range(6):  # near copies of one document
        words = base.split()
        words[5 + 3 * k] = f"edit{k}"
        add(" ".join(words), "en", "s1")
    add(base.upper(), "en", "s1")  # an exact copy after lower-casing
    add(base, "en", "s2")
    add(base, "en", "s2")
    add(None, None, None)
    add("", "en", "s1")
    add("", "fr", None)
    add("   \n\t ", None, "s2")
    add("one", "en", "s2")
    add("ONE", "en", "s2")
    add("two words", "en", "s3")
    add("123 456 !!", "en", "s3")
    add("İstanbul ß ÉCOLE naïve café 你好 мир", None, "s3")
    add(prose(rng, "en", 9000), "en", "s1")  # very long
    add("Released under the MIT License. under the mit  license", "en", "s1")
    add("x<|endoftext|> y  <|endoftext|>\n z <|startoftext|>  \x00\x01   end ", "en", "s3")
    rows.append(rows[1])  # a repeated row
    rows.append((None, "no id at all here", "en", "s1", 17, 5, True, "x"))
    rows.append((3, "another text under an id that is taken", "en", "s1", 3, 5, True, "x"))
    return rows


@pytest.fixture(scope="session")
def corpus_rows():
    return odd_rows()


@pytest.fixture(scope="session")
def corpus(spark, corpus_rows):
    return spark.createDataFrame(corpus_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
