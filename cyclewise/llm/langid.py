"""Language identification with language-bitmask n-gram filters.

A Bloom filter is held in bit slices: each position has one bit per language, so that one look returns all
languages that contain an n-gram.  A text's n-grams are looked up, the hits of each language counted,
corrected for the filter's false positives, and the language with most hits decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclewise.llm import ngrams
from cyclewise.llm.common import bound_batches, crc_fold, cut_lineage, passes

SIZES = (2, 3, 4)
#: An n-gram belongs to a language if it makes up this share of the language's n-grams of its size ...
MIN_SHARE = 5e-5
#: ... and at least this part of the largest share that any language has of it.
MIN_OF_BEST = 0.1
HASHES = 3
#: Filter positions per n-gram held; rounded up to a power of two.
POSITIONS_PER_GRAM = 16

#: A text is in a learned language if that language knows this share of its n-grams.  Labelled documents have 0.48 at
#: least (sf 0.1, 10,000 documents), foreign scripts of 50 words and more 0.002 at most, whatever their length.
MIN_COVERAGE = 0.1

UNKNOWN = "und"


@dataclass
class LanguageFilter:
    """``slices``: position -> bitmask of languages.  ``false_rate``: per language, what a foreign n-gram hits by chance."""

    languages: list[str]
    docs: np.ndarray
    slices: np.ndarray
    false_rate: np.ndarray

    def positions(self, h: np.ndarray) -> list[np.ndarray]:
        bits = int(np.log2(len(self.slices)))
        a = h >> np.uint64(64 - bits)
        b = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits) | np.uint64(1)
        mask = np.uint64(len(self.slices) - 1)
        return [((a + np.uint64(i) * b) & mask).astype(np.int64) for i in range(HASHES)]

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Bitmask of all languages that contain each n-gram."""
        found = None
        for p in self.positions(h):
            got = self.slices[p]
            found = got if found is None else found & got
        return found

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Corrected hits per text and language, n-grams per text, whether the text has a letter."""
        low, owner, has = ngrams.letters(texts)
        hits = np.zeros((len(texts), len(self.languages)))
        total = np.zeros(len(texts))
        for n in SIZES:
            h, who = ngrams.hashes(low, owner, n)
            found = self.lookup(h)
            total += np.bincount(who, minlength=len(texts))
            for k in range(len(self.languages)):
                bit = (found >> found.dtype.type(k)) & found.dtype.type(1)
                hits[:, k] += np.bincount(who, weights=bit, minlength=len(texts))
        return np.maximum(0.0, (hits - total[:, None] * self.false_rate) / (1 - self.false_rate)), total, has

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language (``und`` without a letter), score in [0, 1], share of the n-grams that some language knows best."""
        hits, total, has = self.scores(texts)
        # ties go to the language with more documents, then to the first by name
        best = np.lexsort((-np.arange(len(self.languages)), self.docs))[::-1]
        pick = best[np.argmax(hits[:, best], axis=1)] if len(self.languages) else np.zeros(len(texts), int)
        top = hits[np.arange(len(texts)), pick] if len(self.languages) else np.zeros(len(texts))
        lang = np.array(self.languages + [UNKNOWN], dtype=object)[np.where(has & bool(self.languages), pick, len(self.languages))]
        sums = hits.sum(axis=1)
        score = np.where(has & (sums > 0), top / np.maximum(sums, 1e-12), 0.0)
        return lang, score, np.where(total > 0, top / np.maximum(total, 1), 0.0)


def _gram_counts(languages: list[str]):
    index = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        waiting: dict[tuple[int, int], list] = {}

        def settle(key):
            hs, cs = zip(*([held[key]] if key in held else []) + waiting.pop(key), strict=True)
            u, inv = np.unique(np.concatenate(hs), return_inverse=True)
            held[key] = u, np.bincount(inv, weights=np.concatenate(cs)).astype(np.int64)

        for pdf in passes(batches, "text"):
            for lang, part in pdf.groupby("lang"):
                low, owner, _ = ngrams.letters(part["text"].tolist())
                for n in SIZES:
                    u, c = np.unique(ngrams.hashes(low, owner, n)[0], return_counts=True)
                    key = index[lang], n
                    waiting.setdefault(key, []).append((u, c))
                    if len(waiting[key]) >= 16:
                        settle(key)
        for key in list(waiting):
            settle(key)
        for (k, n), (u, c) in held.items():
            yield pd.DataFrame({"lang": k, "n": n, "h": u.view(np.int64), "c": c})

    return count


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageFilter:
    """Learns from all rows with a text and a language.

    n-grams are counted per partition and summed over the cluster.  What comes to the driver is bounded by the
    shares: at most ``len(SIZES) / MIN_SHARE`` n-grams per language, whatever the corpus.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()
    known = rows.groupBy("lang").count().orderBy("lang").collect()
    languages = [r["lang"] for r in known]
    if len(languages) > 64:
        raise ValueError("more than 64 languages: one slice word holds 64")
    counts = rows.mapInPandas(_gram_counts(languages), "lang int, n int, h long, c long")
    sums = counts.groupBy("lang", "n", "h").agg(F.sum("c").alias("c"))
    sums = cut_lineage(sums, "lang-grams")  # the totals come from the sums: the texts are read once
    totals = sums.groupBy("lang", "n").agg(F.sum("c").alias("t"))
    grams = sums.join(F.broadcast(totals), ["lang", "n"]).filter(F.col("c") >= F.lit(MIN_SHARE) * F.col("t")).select(
        "lang", "h", (F.col("c") / F.col("t")).alias("share")
    ).toPandas()
    grams = grams[grams["share"] >= MIN_OF_BEST * grams.groupby("h")["share"].transform("max")] if len(grams) else grams
    kind = np.uint8 if len(languages) <= 8 else np.uint16 if len(languages) <= 16 else np.uint32 if len(languages) <= 32 else np.uint64
    size = 1 << int(np.ceil(np.log2(max(1024, POSITIONS_PER_GRAM * len(grams)))))
    model = LanguageFilter(languages, np.array([r["count"] for r in known], dtype=np.int64), np.zeros(size, kind), np.zeros(len(languages)))
    for k, part in grams.groupby("lang"):
        h = part["h"].to_numpy().view(np.uint64)
        for p in model.positions(h):
            model.slices[p] |= kind(1 << int(k))
    for k in range(len(languages)):
        fill = np.count_nonzero(model.slices & kind(1 << k)) / size
        model.false_rate[k] = fill**HASHES
    return model


def identify(docs: DataFrame, model: LanguageFilter, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per input row: ``doc_id``, the columns in ``keep``, ``lang_pred, score, coverage``.

    ``und`` with score 0 for null texts and texts without a letter.  ``coverage`` is the corrected share of
    the text's n-grams that its language knows.  Rows repeated are predicted each; an empty table gives an empty result.
    """
    bound_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in passes(batches, "_text"):
            lang, score, cover = held.value.predict(pdf["_text"].fillna("").tolist())
            yield pdf.drop(columns=["_text"]).assign(lang_pred=lang, score=score, coverage=cover)

    rows = docs.select(F.col(id_col).alias("doc_id"), *[F.col(f"`{c}`") for c in keep or []], F.col(text_col).cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_text")
    return rows.mapInPandas(run, schema + ", lang_pred string, score double, coverage double")


def learn_and_identify(docs: DataFrame, held_out_fold: int = 2, folds: int = 4) -> DataFrame:
    """The query's form: learns from the documents outside one crc32 fold of the ids and predicts all of them."""
    fold = crc_fold(F.col("doc_id"), folds)
    model = fit(docs.filter(fold != held_out_fold))
    out = identify(docs, model)
    return out.select("doc_id", (crc_fold(F.col("doc_id"), folds) == held_out_fold).alias("held_out"), "lang_pred", "score", "coverage")


def drop_unknown(docs: DataFrame, model: LanguageFilter, id_col: str = "doc_id", text_col: str = "text", min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """The rows of ``docs`` in a learned language, with their own columns.

    Rejected are only texts without a letter and those whose language knows less than ``min_coverage`` of their
    n-grams, corrected for the filter's chance hits: the number of these grows with a text, their share does not.
    """
    schema = docs.schema
    at = docs.columns.index(text_col)
    bound_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            keep, start = [], 0
            while start < len(texts):
                end, size = start, 0
                while end < len(texts) and (end == start or size + len(texts[end]) <= ngrams.PASS_CHARS):
                    size += len(texts[end])
                    end += 1
                lang, _, cover = held.value.predict(texts[start:end])
                keep.extend((lang != UNKNOWN) & (cover >= min_coverage))
                start = end
            yield batch.filter(pa.array(keep, type=pa.bool_()))

    return docs.mapInArrow(run, schema)
