"""Periodic runs of words: maximal stretches of at least four repeats, and the text with each run's repeats taken out.

Documents of a batch are laid one after another and given one run-length grammar (``recompression.py``).  A run of
period q and length >= 4q holds at least 3q neighbouring positions whose word equals the one q later, so one of the
positions 0, 3q, 6q, ... is among them: the harmonic grid, of n ln n / 3 candidates over all periods.  Those whose
words agree are extended to both sides by grammar LCE, which gives the run exactly.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclewise.llm.common import bound_batches, passes
from cyclewise.llm.recompression import Grammar

#: Fewest repeats of a run's period, and fewest words of a run.
REPEATS, LEAST = 4, 6
#: Candidates that are extended at once.
BLOCK = 200_000

SCHEMA = ("n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
          "collapsed_sha256 string")


@dataclass
class Runs:
    """Runs of a batch, ordered by document, start and period."""

    doc: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _candidates(text: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid positions (and their periods) whose word is repeated one period later, in blocks.

    Separators differ from each other and from all words, so none of them agrees with anything.
    """
    held, where, what = 0, [], []
    for q in range(1, longest // REPEATS + 1):
        step = (REPEATS - 1) * q
        at = np.flatnonzero(text[: len(text) - q : step] == text[q::step]) * step
        if len(at):
            where.append(at)
            what.append(np.full(len(at), q))
            held += len(at)
        if held >= BLOCK:
            yield np.concatenate(where), np.concatenate(what)
            held, where, what = 0, [], []
    if held:
        yield np.concatenate(where), np.concatenate(what)


def find_runs(docs: list[np.ndarray]) -> Runs:
    """The runs of each document, given as word numbers from 0 on that all documents of the call share."""
    sizes = np.array([len(d) for d in docs], np.int64)
    offset = np.r_[0, np.cumsum(sizes + 1)] + 1  # place of each document's first word; a separator before it
    text = np.empty(int(offset[-1]), np.int64)
    text[offset - 1] = -np.arange(1, len(offset) + 1)
    for d, o in zip(docs, offset, strict=False):
        text[o : o + len(d)] = d
    found = [np.empty((0, 3), np.int64)]
    grammar = None
    for i, q in _candidates(text, int(sizes.max(initial=0))):
        grammar = grammar or Grammar(text)
        after = grammar.extend(i, i + q, forward=True)
        before = grammar.extend(i - 1, i + q - 1, forward=False)
        length = before + after + q
        run = length >= np.maximum(LEAST, REPEATS * q)
        found.append(np.unique(np.stack([(i - before)[run], length[run], q[run]], axis=1), axis=0))
    runs = np.concatenate(found)
    # one interval found with several periods is the run of the smallest one
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    if len(runs):
        runs = runs[np.r_[True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1)]]
        runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    doc = np.searchsorted(offset, runs[:, 0], side="right") - 1
    return Runs(doc, runs[:, 0] - offset[doc], runs[:, 1], runs[:, 2])


def kept_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay when every run keeps its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1]) == 0


def planted(words: np.ndarray, doc_id: str | None) -> np.ndarray:
    """The query's word rule: with h = crc32 of the id as text (null: empty) and h % 10 = 0, the words from a on repeat
    the first p after a."""
    h = zlib.crc32((doc_id or "").encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.r_[words[:a], words[a + np.arange(n - a) % p]]


def _collapse(batches: Iterator[pd.DataFrame], rule) -> Iterator[pd.DataFrame]:
    for pdf in passes(batches, "text"):
        texts = [t.encode("utf-8", "surrogatepass").split() if t is not None else [] for t in pdf["text"]]
        numbers = pd.factorize(np.array([w for t in texts for w in t] + [None], object)[:-1])[0].astype(np.int64)
        ends = np.cumsum([len(t) for t in texts])[:-1]
        own = np.split(numbers, ends) if texts else []
        if rule is not None:
            picked = [rule(np.arange(len(t)), d) for t, d in zip(texts, pdf["doc_id"], strict=True)]
            own = [o[k] for o, k in zip(own, picked, strict=True)]
            texts = [t if len(k) == 0 or k[-1] == len(t) - 1 and (np.diff(k) == 1).all() else [t[x] for x in k.tolist()]
                     for t, k in zip(texts, picked, strict=True)]
        runs = find_runs(own)
        lo = np.searchsorted(runs.doc, np.arange(len(texts)))
        hi = np.searchsorted(runs.doc, np.arange(len(texts)), side="right")
        rows = []
        for k, words in enumerate(texts):
            s, m, q = (x[lo[k] : hi[k]] for x in (runs.start, runs.length, runs.period))
            if not len(s):
                rows.append((0, None, None, None, None, hashlib.sha256().hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()))
                continue
            best = np.lexsort((q, s, -m))[0]
            listed = "".join(f"{x},{y},{z}\n" for x, y, z in zip(s.tolist(), m.tolist(), q.tolist(), strict=True))
            stay = np.flatnonzero(kept_words(len(words), s, m, q)).tolist()
            rows.append((len(s), int(s[best]), int(m[best]), int(q[best]), int(1000 * m[best] // q[best]),
                         hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join([words[x] for x in stay])).hexdigest()))
        out = pd.DataFrame(rows, columns=["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])
        for c in ("start", "length", "period", "exponent_milli"):
            out[c] = out[c].astype("Int64")
        out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
        yield out


def run_digest(docs: DataFrame, rule=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id`` and the columns of ``SCHEMA``.

    Words are the stretches without the blanks of ASCII.  Runs: see the module.  ``start, length, period,
    exponent_milli`` belong to the longest run (ties: the smallest start, then period), null without one; the digests
    are of all runs and of the words that stay.  ``rule(word numbers, id as text)`` may rearrange a document's words first.
    Null, empty and blank texts have no words and so no run; repeated rows are answered each; a null id stays null;
    other columns are not read.  An empty table gives an empty one.
    """
    bound_batches(docs.sparkSession)
    # the id travels as text: pandas has no whole number that can be null
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInPandas(lambda batches: _collapse(batches, rule), f"doc_id string, {SCHEMA}")
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def collapse_runs(docs: DataFrame, text_col: str = "text", out: str = "collapsed") -> DataFrame:
    """``docs`` with the column ``out``: the text's words without the repeats of runs, joined by one space.

    The other columns stay as they are (one named ``out`` is replaced); a null text gives an empty one.
    """
    bound_batches(docs.sparkSession)
    schema = docs.drop(out).withColumn(out, F.lit("")).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in passes(batches, text_col):
            texts = [(t or "").encode("utf-8", "surrogatepass").split() for t in pdf[text_col]]
            numbers = pd.factorize(np.array([w for t in texts for w in t] + [None], object)[:-1])[0].astype(np.int64)
            runs = find_runs(np.split(numbers, np.cumsum([len(t) for t in texts])[:-1]))
            made = []
            for k, words in enumerate(texts):
                mine = runs.doc == k
                stay = kept_words(len(words), runs.start[mine], runs.length[mine], runs.period[mine])
                made.append(b" ".join([w for w, s in zip(words, stay.tolist(), strict=True) if s]).decode("utf-8", "surrogatepass"))
            yield pdf.drop(columns=[out], errors="ignore").assign(**{out: made})

    return docs.mapInPandas(run, schema)
