"""Toxicity scores from a learned lexicon, matched with misspellings and weighed by context.

The lexicon (whole words and stems) is learned from labelled documents.  A Levenshtein automaton over its trie
finds terms and their misspellings; what stands around a hit tells quotation and report from abuse; a
logistic regression turns the weighed hits into a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclewise.llm.common import bound_batches, crc_fold, cut_lineage
from cyclewise.llm.levenshtein import OPEN_STEM, STEM, WORD, LexiconAutomaton

#: Labelled documents that the model is fitted on, at most, in the order of a hash of their ids.
SAMPLE_DOCS = 20_000
#: Share of the toxic documents that a term must be in.
MIN_SUPPORT = 0.005
#: Share of a term's documents that must be toxic, and log-odds from which a hit counts in full.
MIN_PRECISION, FULL_ODDS = 0.5, 4.0
#: Letters of a stem.
STEMS = range(4, 11)
#: Words before and after a hit that its context score reads.
WINDOW = 8
#: What a hit in quotation marks, or near words of report, still counts.
QUOTED, REPORTED = 0.25, 0.6
#: Prior of a misspelling's credit, and how many documents it weighs.
CREDIT, CREDIT_DOCS = 0.8, 2.0

#: Words that announce a quotation or a report, in the four languages.
REPORT_WORDS = frozenset(
    "said says wrote writes quoted quote quotes called term word insult insults slur reported allegedly "
    "sagte sagt schrieb zitat zitierte nannte wort begriff beleidigung "
    "dit écrit cité citation appelé mot terme insulte "
    "dijo dice escribió cita citó llamó palabra término insulto".split()
)
_OPEN, _CLOSE = "\"“„«‘'", "\"”“»’'"

_LETTERS = re.compile(r"[^\W\d_]+")
WORDS_KEPT = 300_000


def _terms_of(text: str) -> set[tuple[str, int]]:
    """Whole words and stems that a text has."""
    out: set[tuple[str, int]] = set()
    for w in set(_LETTERS.findall((text or "").lower())):
        if 3 <= len(w) <= 40:
            out.add((w, WORD))
            out.update((w[:n], STEM) for n in STEMS if n <= len(w))
            out.update((w[:n], OPEN_STEM) for n in STEMS if n < len(w))
    return out


def _count_terms(only: frozenset | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for pdf in batches:
            for text in pdf["text"]:
                found = _terms_of(text)
                seen.update(found if only is None else found & only)
        yield pd.DataFrame([(t, s, c) for (t, s), c in seen.items()], columns=["term", "stem", "c"])

    return run


def choose_terms(toxic: dict, clean: dict, n_toxic: int, n_clean: int) -> list[tuple[str, int]]:
    """Terms that are significantly toxic, shorter stems first; none that a chosen stem covers.

    A stem gives way to a longer one that loses no documents, or is much more precise, and to the whole word
    that loses none; a stem that is harmless by itself may still count with letters after it.
    """
    prior = n_toxic / max(1, n_toxic + n_clean)
    bar = np.log(max(2, len(toxic))) + 3

    def share(term):
        t = toxic.get(term, 0)
        return t / (t + clean.get(term, 0)) if t else 0.0

    def passes(term):
        t, c, p = toxic[term], clean.get(term, 0), share(term)
        return p >= MIN_PRECISION and t * np.log(p / prior) + (c * np.log((1 - p) / (1 - prior)) if c else 0.0) > bar

    good = {k for k in toxic if passes(k)}
    longer: dict[str, list[str]] = {}
    for term, kind in good:
        if kind == STEM:
            longer.setdefault(term[:-1], []).append(term)
    chosen: set[tuple[str, int]] = set()

    def covered(term, kind):
        return any((term[:n], STEM) in chosen or n < len(term) and (term[:n], OPEN_STEM) in chosen for n in STEMS if n <= len(term))

    for term, kind in sorted(good, key=lambda k: (k[1] == WORD, len(k[0]), k)):
        if covered(term, kind):
            continue
        if kind == STEM:
            at = term
            while True:
                tox = toxic[at, STEM]
                next_ = [x for x in longer.get(at, []) if toxic[x, STEM] >= 0.97 * tox
                         or share((x, STEM)) >= 0.9 > share((at, STEM)) and toxic[x, STEM] >= 0.5 * tox]
                if not next_:
                    break
                at = max(next_, key=lambda x: (toxic[x, STEM], x))
            whole = (at, WORD) in good and toxic[at, WORD] >= 0.97 * toxic[at, STEM]
            chosen.add((at, WORD if whole else STEM))
        elif kind == OPEN_STEM and (term, STEM) not in good or kind == WORD:
            chosen.add((term, kind))
    return sorted(chosen)


class _Looks(dict):
    """White-space separated piece of a text -> None, or (edits, term) of its best match."""

    def __init__(self, automaton: LexiconAutomaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, piece: str):
        if len(self) >= WORDS_KEPT:
            self.clear()
        found = [m for w in _LETTERS.findall(piece.lower()) if (m := self.automaton.match(w))]
        out = self[piece] = min(found, default=None)
        return out


def context_weight(pieces: list[str], at: int) -> float:
    """1 for plain use; less inside quotation marks and near words of report."""
    lo, hi = max(0, at - WINDOW), min(len(pieces), at + WINDOW + 1)
    opened = any(p[0] in _OPEN for p in pieces[lo : at + 1])
    closed = any(p.rstrip(".,;:!?)")[-1:] in _CLOSE and p.rstrip(".,;:!?)")[-1:] for p in pieces[at:hi])
    weight = QUOTED if opened and closed else 1.0
    near = {w for p in pieces[lo:at] + pieces[at + 1 : hi] for w in _LETTERS.findall(p.lower())}
    return weight * (REPORTED if near & REPORT_WORDS else 1.0)


def find_hits(text: str | None, looks: _Looks) -> tuple[list[int], list[int], list[float], int]:
    """Terms, edits and context weights of the hits in a whole text, and its number of words."""
    pieces = (text or "").split()
    hits = [(i, m) for i, m in enumerate(map(looks.__getitem__, pieces)) if m]
    return [m[1] for _, m in hits], [m[0] for _, m in hits], [context_weight(pieces, i) for i, _ in hits], len(pieces)


@dataclass
class ToxicityModel:
    terms: list[tuple[str, int]]
    strength: np.ndarray  # what an exact hit of each term counts
    credit: np.ndarray  # the part of it that a misspelled hit counts
    weights: np.ndarray

    def features(self, terms, edits, context, words) -> np.ndarray:
        terms, edits, context = np.asarray(terms, int), np.asarray(edits, int), np.asarray(context, float)
        s = float((context * self.strength[terms] * np.where(edits > 0, self.credit[terms], 1.0)).sum()) if len(terms) else 0.0
        return np.array([1.0, 1 - np.exp(-3 * s), np.log1p(s), s / (s + 0.01 * words + 1)])

    def score(self, hits) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.features(*hits) @ self.weights, -30, 30))))


def _regression(x: np.ndarray, y: np.ndarray, penalty: float = 0.05) -> np.ndarray:
    w = np.zeros(x.shape[1])
    reg = np.full(x.shape[1], penalty)
    reg[0] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(reg)
        step = np.linalg.solve(h, x.T @ (y - p) - reg * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample_docs: int = SAMPLE_DOCS) -> ToxicityModel:
    """Learns from labelled documents, ``sample_docs`` at most.

    An id labelled more than once counts as toxic if any label says so; null labels count as none.  What comes
    to the driver are counts of terms in at least ``MIN_SUPPORT`` of the toxic documents and the hits of the sample.
    Without toxic documents the lexicon is empty and every score the prior.
    """
    bound_batches(docs.sparkSession)
    marked = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_lid")).agg(
        F.max(F.col(label_col).cast("int")).alias("toxic")
    )
    marked = marked.orderBy(F.xxhash64("_lid"), "_lid").limit(sample_docs)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    sample = cut_lineage(rows.join(marked, F.col("_id") == F.col("_lid")).select("toxic", "text").repartition(8), "toxic-sample")
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    least = max(2, MIN_SUPPORT * n_toxic)
    schema = "term string, stem int, c long"
    toxic = sample.filter("toxic = 1").select("text").mapInPandas(_count_terms(None), schema).groupBy("term", "stem").agg(F.sum("c").alias("c"))
    toxic = {(r["term"], r["stem"]): r["c"] for r in toxic.filter(F.col("c") >= least).collect()}
    clean = sample.filter("toxic = 0").select("text").mapInPandas(_count_terms(frozenset(toxic)), schema).groupBy("term", "stem").agg(F.sum("c").alias("c"))
    clean = {(r["term"], r["stem"]): r["c"] for r in clean.collect()}
    terms = choose_terms(toxic, clean, n_toxic, n_clean) if n_toxic else []
    odds = np.array([np.log((toxic[t] + 0.1) / (clean.get(t, 0) + 0.1)) for t in terms])
    model = ToxicityModel(terms, np.clip(odds / FULL_ODDS, 0.1, 1.0), np.full(len(terms), CREDIT), np.zeros(4))
    hits = sample.mapInPandas(_hit_rows(terms, ["toxic"]), "toxic int, terms array<int>, edits array<int>, context array<double>, words int").toPandas()
    # credit of misspellings: documents that have them and no exact hit
    seen = np.zeros((len(terms), 2))
    for toxic_, t, e in zip(hits["toxic"], hits["terms"], hits["edits"], strict=True):
        if len(t) and min(e) > 0:
            for k in set(t):
                seen[k, int(toxic_)] += 1
    if len(terms):
        model.credit = np.clip((seen[:, 1] + CREDIT * CREDIT_DOCS) / (seen.sum(axis=1) + CREDIT_DOCS), 0, 1)
        model.credit[model.credit < 0.5] = 0.0
    if len(hits):
        x = np.array([model.features(t, e, c, w) for t, e, c, w in zip(hits["terms"], hits["edits"], hits["context"], hits["words"], strict=True)])
        model.weights = _regression(x, hits["toxic"].to_numpy(float))
    return model


def _hit_rows(terms: list, keep: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        looks = _Looks(LexiconAutomaton(terms))
        for pdf in batches:
            found = [find_hits(t, looks) for t in pdf["text"]]
            out = pd.DataFrame(found, columns=["terms", "edits", "context", "words"])
            yield pd.concat([pdf[keep].reset_index(drop=True), out], axis=1)

    return run


_LOOKS: dict[str, _Looks] = {}


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, score, n_hits, n_quoted``.  Null texts count as empty; these have the
    score of a text without hits.  Repeated rows are scored each."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = held.value
        key = repr(own.terms)
        if key not in _LOOKS:  # kept by the Python worker from task to task
            _LOOKS.clear()
            _LOOKS[key] = _Looks(LexiconAutomaton(own.terms))
        looks = _LOOKS[key]
        for pdf in batches:
            hits = [find_hits(t, looks) for t in pdf["text"]]
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"], "score": [own.score(h) for h in hits], "n_hits": [len(h[0]) for h in hits],
                "n_quoted": [sum(c < 1 for c in h[2]) for h in hits],
            })

    return rows.mapInPandas(run, f"doc_id {kind}, score double, n_hits int, n_quoted int")


def learn_and_score(docs: DataFrame, labels: DataFrame, held_out_fold: int = 1, folds: int = 3, threshold: float = 0.7) -> DataFrame:
    """The query's form: learns from labels outside one crc32 fold of the ids and scores all documents."""
    model = fit(docs, labels.filter(crc_fold(F.col("doc_id"), folds) != held_out_fold))
    out = score(docs, model)
    return out.select("doc_id", (crc_fold(F.col("doc_id"), folds) == held_out_fold).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"), "n_hits", "n_quoted")
