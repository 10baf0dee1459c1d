"""Near-duplicate groups by SetSketch registers.

A document's set of word shingles is sketched in registers: the minima of exponential variables over the set,
exponentially spaced and truncated.  Documents whose registers agree in a band are candidates; the registers'
joint likelihood drops pairs that cannot reach the similarity, and the rest is confirmed on the full sets.
Links join into components.

Candidates stay linear in the size of a bucket: first every member goes with the one that shares most buckets with
most others.  Only then, and only between members that are still in different components, the remaining
pairs of a bucket are compared, in blocks and by registers, so that no link that the bands see is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclewise.llm.common import bound_batches, cut_lineage
from cyclewise.llm.graph import components

BANDS, ROWS = 40, 6  # a pair at similarity 0.8 shares no band with probability 5e-6
REGISTERS = BANDS * ROWS
#: SetSketch parameters: base of the spacing, rate of the exponentials, largest register value.
BASE, RATE, LIMIT = 1.001, 20.0, 65535
#: A pair is dropped unconfirmed if the threshold is e**-LOG_ODDS times as likely as the best estimate.
LOG_ODDS = 13.0
SALTS = 64
#: Members of a bucket that one block of the remaining pairs takes on average.
BLOCK = 512
#: Bits of the finer sketch: a pair at similarity 0.8 passes, one at 0.75 hardly.
BITS = 4096
#: Words whose hashes a Python worker keeps.
WORDS_KEPT = 200_000

_rng = np.random.default_rng(20240229)
_A = _rng.integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, REGISTERS, dtype=np.uint64)
_C = _rng.integers(0, 2**63, BITS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_D = _rng.integers(0, 2**63, BITS, dtype=np.uint64)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _WordHashes()


def words_of(text: str | None) -> list[bytes]:
    """Lower-cases A-Z and splits at the ASCII white space characters."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; fewer words than ``width`` are one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        out = _mix(out + h[k : k + n])
    return np.unique(out)


def shingle_set(words: list[bytes], width: int) -> set:
    """The shingles themselves, for confirmation."""
    width = max(1, min(width, len(words)))
    return set(zip(*(words[k:] for k in range(width)), strict=False)) if words else set()


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set: larger registers stand for smaller minima."""
    low = np.full(REGISTERS, 2**64 - 1, dtype=np.uint64)
    for i in range(0, len(hashes), 512):
        np.minimum(low, (hashes[i : i + 512, None] * _A + _B).min(axis=0), out=low)
    x = -np.log1p(-np.minimum((low.astype(np.float64) + 0.5) / 2**64, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, LIMIT).astype("<u2")


def band_keys(regs: np.ndarray) -> np.ndarray:
    """documents x bands: one 64-bit key per band of registers."""
    parts = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(regs), BANDS)) << np.uint64(32)
    for k in range(ROWS):
        key = _mix(key + parts[:, :, k] + np.uint64(1))
    return key.view(np.int64)


def may_reach(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray, threshold: float) -> np.ndarray:
    """False where the registers rule the similarity out.

    With known sizes the similarity fixes how often a register of one set exceeds, equals or falls short of the
    other's; the threshold's likelihood is compared with that of the best estimate below it.
    """
    equal = (ra == rb).sum(axis=1)
    above = (ra > rb).sum(axis=1)
    below = ra.shape[1] - equal - above

    def likelihood(j):
        union = (na + nb) / (1 + j)
        tiny = 1e-4  # registers also agree or differ by rounding
        p = np.stack([j, (na - j * union) / union, (nb - j * union) / union])
        p = np.maximum(p, tiny)
        p /= p.sum(axis=0)
        return equal * np.log(p[0]) + above * np.log(p[1]) + below * np.log(p[2])

    at = likelihood(np.full(len(na), threshold))
    best = at
    for j in np.linspace(0.01, threshold, 40)[:-1]:
        best = np.maximum(best, likelihood(np.full(len(na), j)))
    return best - at <= LOG_ODDS


def sketch(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n, set_key, regs`` per row; a key of the empty set is null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n, keys, regs = [], [], []
            for text in pdf["text"]:
                h = shingle_hashes(words_of(text), width)
                n.append(len(h))
                keys.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
                regs.append(registers(h).tobytes() if len(h) else None)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n": n, "set_key": keys, "regs": regs})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id long, n long, set_key binary, regs binary")


def _bands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        if len(pdf):
            keys = band_keys(np.frombuffer(b"".join(pdf["regs"]), "<u2").reshape(len(pdf), REGISTERS))
            yield pd.DataFrame({"band": keys.ravel(), "slot": np.tile(np.arange(BANDS), len(pdf)),
                                "rep": np.repeat(pdf["rep"].to_numpy(), BANDS), "n": np.repeat(pdf["n"].to_numpy(), BANDS)})


def fine_bits(hashes: np.ndarray) -> bytes:
    """One bit of each of ``BITS`` further minima: a finer sketch in fewer bytes, for documents that share a bucket."""
    low = np.full(BITS, 2**64 - 1, dtype=np.uint64)
    for i in range(0, len(hashes), 128):
        np.minimum(low, (hashes[i : i + 128, None] * _C + _D).min(axis=0), out=low)
    return np.packbits((_mix(low) & np.uint64(1)).astype(np.uint8)).tobytes()


def _with_bits(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            hashes = [shingle_hashes(words_of(t), width) for t in pdf["text"]]
            keys = [band_keys(registers(h)[None]).astype(np.uint32).tobytes() for h in hashes]
            yield pdf.assign(bits=[fine_bits(h) for h in hashes], keys=keys)

    return run


def _most_unequal(percent: int) -> int:
    """Unequal bits that a pair at the similarity exceeds with probability 1e-7 at most; a pair of similarity j has
    unequal bits at the rate (1 - j) / 2."""
    p, total = (1 - percent / 100) / 2, 0.0
    for k in range(BITS, 0, -1):
        total += math.exp(math.lgamma(BITS + 1) - math.lgamma(k + 1) - math.lgamma(BITS - k + 1) + k * math.log(p) + (BITS - k) * math.log(1 - p)) if p else 0.0
        if total > 1e-7:
            return k
    return 0


def _cross(percent: int):
    """Rows sorted by block (band, i, j) -> pairs of side 0 and side 1 of a block in different components whose sizes
    and bits allow the similarity, once: in the first bucket that they share.  A block is held at a time."""
    most = _most_unequal(percent)

    def pairs(g: pd.DataFrame) -> Iterator[pd.DataFrame]:
        side = g["side"].to_numpy()
        x, y = g[side == 0], g[side == 1]
        if not len(x) or not len(y):
            return
        bits = lambda d: np.frombuffer(b"".join(d["bits"]), np.uint64).reshape(len(d), BITS // 64)
        keys = lambda d: np.frombuffer(b"".join(d["keys"]), np.uint32).reshape(len(d), BANDS)
        bx, by, kx, ky, slot = bits(x), bits(y), keys(x), keys(y), int(g["slot"].iloc[0])
        ny, cy, ids, big = y["n"].to_numpy(), y["comp"].to_numpy(), y["rep"].to_numpy(), y["big"].to_numpy()
        for k, (a, n, c) in enumerate(zip(x["rep"], x["n"], x["comp"], strict=True)):
            ok = (cy != c) & (np.minimum(ny, n) * 100 >= np.maximum(ny, n) * percent) & (big | (ids > a))
            at = np.flatnonzero(ok)
            at = at[np.bitwise_count(by[at] ^ bx[k]).sum(axis=1) <= most]
            at = at[(ky[at] == kx[k]).argmax(axis=1) == slot]
            if len(at):
                yield pd.DataFrame({"a": np.minimum(ids[at], a), "b": np.maximum(ids[at], a)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        last = None
        for pdf in batches:
            for key, g in pdf.groupby(["band", "i", "j"], sort=False):
                if key != last and held:
                    yield from pairs(pd.concat(held))
                    held = []
                held.append(g)
                last = key
        if held:
            yield from pairs(pd.concat(held))

    return run


def _confirm(pairs: DataFrame, classes: DataFrame | None, texts: DataFrame, width: int, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) of class representatives whose full sets reach the similarity.

    Without ``classes`` the registers are not asked: the pairs have passed the finer sketch.
    """

    def likely(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                ra = np.frombuffer(b"".join(pdf["ra"]), "<u2").reshape(len(pdf), REGISTERS)
                rb = np.frombuffer(b"".join(pdf["rb"]), "<u2").reshape(len(pdf), REGISTERS)
                ok = may_reach(ra, rb, pdf["na"].to_numpy(float), pdf["nb"].to_numpy(float), percent / 100)
                yield pdf.loc[ok, ["a", "b"]]

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, own = None, set()
        for pdf in batches:
            keep = []
            for a, ta, tb in zip(pdf["a"], pdf["ta"], pdf["tb"], strict=True):
                if a != last:
                    last, own = a, shingle_set(words_of(ta), width)
                other = shingle_set(words_of(tb), width)
                both = len(own & other)
                keep.append(100 * both >= percent * (len(own) + len(other) - both))
            yield pdf.loc[keep, ["a", "b"]]

    maybe = pairs
    if classes is not None:
        side = lambda c: classes.select(F.col("rep").alias(c), F.col("regs").alias(f"r{c}"), F.col("n").alias(f"n{c}"))
        maybe = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ra", "rb", "na", "nb").mapInPandas(likely, "a long, b long")
        maybe = cut_lineage(maybe, f"{name}-maybe")
    text = lambda c: texts.select(F.col("rep").alias(c), F.col("text").alias(f"t{c}"))
    # the pairs' own documents only; sorted by a, so that its set is built once in a run
    full = maybe.join(text("b"), "b").join(text("a"), "a").sortWithinPartitions("a").select("a", "b", "ta", "tb")
    return cut_lineage(full.mapInPandas(check, "a long, b long").distinct(), f"{name}-links")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept, links``.

    Sets of ``width``-word shingles (fewer words: the whole sequence) are linked when 100 * intersection >=
    ``percent`` * union.  ``component_id`` is the smallest id reachable over links, ``kept`` says that it is the
    row's own, ``links`` counts the confirmed links of the row's class of equal sets to other classes that were
    needed to settle components.  Null and empty texts have no shingles and no links.  Rows repeated with id and
    text get equal rows; one id with several texts is linked by any of them.  Rows without an id count as linked with nothing.  An empty table gives an empty result.
    """
    bound_batches(docs.sparkSession)
    sketches = cut_lineage(sketch(docs, width, id_col, text_col).withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))), "nd-sketch")
    some = sketches.filter("set_key is not null and doc_id is not null")
    # documents of equal sets are one class; its smallest id stands for it
    local = some.groupBy("set_key", "_salt").agg(F.min(F.struct("doc_id", "n", "regs")).alias("m"))
    merged = local.groupBy("set_key").agg(F.min("m").alias("m"), F.collect_list("_salt").alias("salts"))
    classes = cut_lineage(merged.select("set_key", F.col("m.doc_id").alias("rep"), F.col("m.n").alias("n"), F.col("m.regs").alias("regs"), "salts"), "nd-classes")
    bands = classes.select("rep", "n", "regs").mapInPandas(_bands, "band long, slot int, rep long, n long")
    sizes = bands.groupBy("band").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    shared = cut_lineage(bands.join(sizes, "band"), "nd-shared")
    # the texts that may be compared: one shuffle of the whole texts, then only these
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).cast("string").alias("text"))
    texts = texts.join(shared.select("rep").distinct(), "rep", "left_semi")
    texts = cut_lineage(texts.mapInPandas(_with_bits(width), "rep long, text string, bits binary, keys binary"), "nd-texts")
    # the member that shares most buckets with most others is the likeliest original: all go with it
    weight = shared.groupBy("rep").agg(F.sum("c").alias("w"))
    top = shared.select("band", "rep").join(weight, "rep").groupBy("band").agg(F.max(F.struct("w", (-F.col("rep")).alias("r"))).alias("t"))
    star = shared.select("band", "rep").join(top.select("band", (-F.col("t.r")).alias("top")), "band")
    star = star.filter("rep <> top").select(F.least("rep", "top").alias("a"), F.greatest("rep", "top").alias("b")).distinct()
    first = _confirm(star, classes, texts, width, percent, "nd-star")
    label = components(first)
    # what is left: members of one bucket in different components
    tagged = shared.select("band", "slot", "rep", "n").join(label, F.col("rep") == F.col("node"), "left").select(
        "band", "slot", "rep", "n", F.coalesce("component", "rep").alias("comp")
    )
    parts = tagged.groupBy("band", "comp").agg(F.count(F.lit(1)).alias("c"))
    mixed = parts.groupBy("band").agg(F.max(F.struct("c", "comp")).alias("m"), F.count(F.lit(1)).alias("k"), F.sum("c").alias("c")).filter("k > 1")
    mixed = mixed.select("band", F.col("m.comp").alias("major"), F.ceil(F.col("c") / F.lit(BLOCK)).alias("_all"),
                         F.ceil((F.col("c") - F.col("m.c")) / F.lit(BLOCK)).alias("_few"))
    member = tagged.join(mixed, "band").join(texts.select("rep", "bits", "keys"), "rep").select(
        "band", "slot", "rep", "n", "comp", (F.col("comp") == F.col("major")).alias("big"), "bits", "keys", "_all", "_few"
    )
    member = cut_lineage(member, "nd-members")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = F.pmod(F.xxhash64("rep"), F.col("_all"))
    few = F.pmod(F.xxhash64("rep"), F.col("_few"))
    left = member.filter("not big").select("band", few.alias("i"), every("_all").alias("j"), F.lit(0).alias("side"), "slot", "rep", "n", "comp", "big", "bits", "keys")
    right = member.select("band", every("_few").alias("i"), own.alias("j"), F.lit(1).alias("side"), "slot", "rep", "n", "comp", "big", "bits", "keys")
    both = left.union(right).repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "side")
    rest = both.mapInPandas(_cross(percent), "a long, b long")
    rest = cut_lineage(rest.join(first, ["a", "b"], "left_anti"), "nd-rest")
    second = _confirm(rest, None, texts, width, percent, "nd-cross")
    links = first.union(second)
    label = cut_lineage(components(links), "nd-components")
    degree = links.select(F.col("a").alias("r")).union(links.select(F.col("b").alias("r"))).groupBy("r").agg(F.count(F.lit(1)).alias("links"))
    of_class = classes.join(label, F.col("rep") == F.col("node"), "left").join(degree, F.col("rep") == F.col("r"), "left").select(
        "set_key", F.coalesce("component", "rep").alias("component_id"), F.coalesce("links", F.lit(0)).cast("long").alias("links"), F.explode("salts").alias("_salt")
    )
    out = sketches.select("doc_id", "n", "set_key", "_salt").join(of_class, ["set_key", "_salt"], "left")
    own = F.coalesce(F.col("component_id"), F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), own.eqNullSafe(F.col("doc_id")).alias("kept"),
                      F.coalesce("links", F.lit(0)).cast("long").alias("links"))
