"""Best-fit packing of token pieces into sequences of one length.

The lengths' histogram is all that the plan needs.  A configuration linear program over it is solved by
multiplicative weights: a knapsack dynamic program prices, under the current weights, the best filling of a
sequence around every length at once, and lengths that were handed out lose weight.  The fractional solution is
rounded to whole sequences, the program is solved again for what rounding left, and best fit packs the few pieces
that no rounded configuration takes.  The configurations become ranges of ranks, by which the pieces find their
places in parallel.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclewise.llm.common import bound_batches, cut_lineage
from cyclewise.llm.tokens import encoder

CAPACITY = 2048
#: Rounds of pricing at most, and the phases that they are spread over: after each, no length has been handed out beyond
#: the same share of its pieces.
ROUNDS, PHASES = 60, 6
#: How strongly the share of a length that was handed out lowers its weight.
RATE = 1.0
#: A filling is used if its price, under the current or the starting weights, is within this share of the best.
SLACK = 0.0003
#: A phase ends early with a round that hands out less than this share of the pieces.
LEAST = 0.0002
#: Times that the program is solved again for what rounding left.
PASSES = 3
#: Parts of the rounded sequences that are kept while best fit packs the rest.
KEEP = (1.0, 0.9, 0.75, 0.5, 0.25, 0.1)
#: Pieces of one length that a window ranks on average.
BUCKET_ROWS = 1_000


class Prices:
    """The highest total value of lengths (repeats allowed) that fit, for every capacity up to the given one."""

    def __init__(self, value: np.ndarray, lengths: np.ndarray, capacity: int):
        self.lengths, self.best = lengths, np.zeros(capacity + 1)
        # the length that ends the best filling, and the last capacity at which one was added
        self.pick, self.last = [0] * (capacity + 1), [0] * (capacity + 1)
        fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
        best, low = self.best, 0.0
        for c in range(1, capacity + 1):
            self.last[c] = self.last[c - 1]
            if fits[c]:
                got = best[c - lengths[: fits[c]]] + value[: fits[c]]
                k = int(got.argmax())
                if got[k] > low:
                    low, self.pick[c], self.last[c] = float(got[k]), int(lengths[k]), c
            best[c] = low

    def filling(self, capacity: int) -> dict[int, int]:
        """The best filling of a capacity: how many of each length."""
        out: dict[int, int] = {}
        c = self.last[capacity]
        while c:
            x = self.pick[c]
            out[x] = out.get(x, 0) + 1
            c = self.last[c - x]
        return out


def knapsack(value: np.ndarray, lengths: np.ndarray, capacity: int) -> dict[int, int]:
    """The multiset of lengths (repeats allowed) of the highest total value that fits."""
    return Prices(value, lengths, capacity).filling(capacity)


def starting_weights(lengths: np.ndarray, total: np.ndarray, capacity: int) -> np.ndarray:
    """Weights from which the program starts: those of the best simple lower bound.

    With a limit e of up to half the capacity, pieces longer than ``capacity - e`` weigh a whole sequence, those
    shorter than e nothing, others their length; no sequence holds more than its capacity of that.  A little of
    the length itself is added, so that fillings of equal worth prefer a smaller gap.
    """
    best, most = lengths.astype(np.float64), float(total @ lengths)
    for e in np.unique(np.minimum(lengths, capacity + 1 - lengths)):
        if 1 < e <= capacity // 2:
            weight = np.where(lengths > capacity - e, capacity, np.where(lengths < e, 0, lengths)).astype(np.float64)
            if float(total @ weight) > most:
                best, most = weight, float(total @ weight)
    return 0.95 * best + 0.05 * lengths


def solve_configurations(counts: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> tuple[dict[tuple, float], float]:
    """Fractional configurations ((length, pieces), ...) -> how many sequences, which hand out no length beyond its count.

    Also returns a lower bound on the sequences that any packing needs: the weights of all pieces over the
    price of the best filling under them.
    """
    need = {x: n for x, n in sorted(counts.items()) if n}
    lengths, total = np.array(list(need), dtype=np.int64), np.array(list(need.values()), dtype=np.float64)
    used = np.zeros(len(lengths))
    at = {x: i for i, x in enumerate(need)}
    found: dict[tuple, float] = {}
    bound = 0.0
    phases = min(PHASES, rounds)
    start = starting_weights(lengths, total, capacity)
    first = Prices(start, lengths, capacity).best[capacity]
    for phase in range(phases if need else 0):
        room = (phase + 1) / phases * total - used * total
        top = 0.0
        for _ in range(rounds // phases):
            open_ = np.flatnonzero(room > 1e-9)
            if not len(open_):
                break
            weight = start * np.exp(-RATE * used)
            prices = Prices(weight[open_], lengths[open_], capacity)
            if len(open_) == len(lengths):
                top = prices.best[capacity]
                bound = max(bound, float(total @ weight) / top)
            worth = weight[open_] + prices.best[capacity - lengths[open_]]
            moved = 0.0
            for k in np.lexsort((-lengths[open_], -worth)).tolist():
                x = int(lengths[open_[k]])
                if room[open_[k]] <= 1e-9:
                    continue
                config = prices.filling(capacity - x)
                config[x] = config.get(x, 0) + 1
                if worth[k] < (1 - SLACK) * top and sum(start[at[y]] * n for y, n in config.items()) < (1 - SLACK) * first:
                    continue
                many = min(room[at[y]] / n for y, n in config.items())
                if many <= 1e-9:
                    continue
                for y, n in config.items():
                    room[at[y]] -= many * n
                    used[at[y]] += many * n / need[y]
                    moved += many * n
                key = tuple(sorted(config.items(), reverse=True))
                found[key] = found.get(key, 0.0) + many
            if moved < LEAST * total.sum():
                break
    return found, bound


def round_configurations(found: dict[tuple, float], left: dict[int, int]) -> dict[tuple, int]:
    """Whole sequences out of fractional ones; takes their pieces out of ``left``.

    The largest uses come first; what one loses to rounding the next ones get, as long as pieces are left.
    """
    chosen: dict[tuple, int] = {}
    due, given = 0.0, 0
    for config, x in sorted(found.items(), key=lambda c: (-c[1], c[0])):
        due += x
        whole = int(due + 1e-6) - given
        given += whole
        many = min([whole, *(left[k] // n for k, n in config)])
        if many > 0:
            chosen[config] = many
            for k, n in config:
                left[k] -= n * many
    return chosen


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> dict[tuple, int]:
    """Best fit, longest first, over the histogram: configuration -> how many sequences."""
    room: dict[int, dict[tuple, int]] = {}
    for x in sorted((x for x, n in counts.items() if n), reverse=True):
        left = counts[x]
        for r in [r for r in sorted(room) if r >= x]:
            if not left:
                break
            each, open_ = r // x, room.pop(r)
            for config in list(open_):
                if not left:
                    break
                bins = min(open_[config], left // each)
                for n, many in ((each, bins), (left - bins * each, 1)):
                    if many and 0 < n <= each and open_.get(config, 0) >= many and (n == each or bins < open_[config] + bins):
                        open_[config] -= many
                        if not open_[config]:
                            del open_[config]
                        slot = room.setdefault(r - n * x, {}) if r - n * x != r else open_
                        key = config + ((x, n),)
                        slot[key] = slot.get(key, 0) + many
                        left -= n * many
                    if config not in open_:
                        break
            if open_:
                room[r] = {**room.get(r, {}), **open_}
        each = capacity // x
        for n, many in ((each, left // each), (left % each, 1)):
            if n and many:
                slot = room.setdefault(capacity - n * x, {})
                slot[((x, n),)] = slot.get(((x, n),), 0) + many
    out: dict[tuple, int] = {}
    for open_ in room.values():
        for config, many in open_.items():
            out[config] = out.get(config, 0) + many
    return out


def take_share(chosen: dict[tuple, int], share: float) -> dict[tuple, int]:
    """About that share of the sequences of every configuration, evenly over all of them."""
    out, due, given = {}, 0.0, 0
    for config, many in sorted(chosen.items()):
        due += many * share
        keep = min(many, int(due + 1e-9) - given)
        given += keep
        if keep:
            out[config] = keep
    return out


@dataclass
class Plan:
    """Ranges of ranks of each length, sorted by (length, first rank): where the pieces of a range go."""

    key: np.ndarray  # length * 2**40 + first rank
    sequence: np.ndarray  # the first sequence of the range
    each: np.ndarray  # pieces of the length in one sequence
    place: np.ndarray  # place of the first of them
    sequences: int
    placed: int  # pieces in rounded configurations; best fit placed the others
    bound: float  # sequences that no packing can do without

    def locate(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i = np.searchsorted(self.key, (length << 40) + rank, side="right") - 1
        ahead = rank - (self.key[i] & ((1 << 40) - 1))
        return self.sequence[i] + ahead // self.each[i], self.place[i] + ahead % self.each[i] * length


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> Plan:
    """Rounds the linear program's solution, solves it again for the rest, packs what is then left by best fit, and
    lays out ranks.

    What rounding left may lack the short pieces that fill gaps.  So best fit is also tried with a part of every
    rounded configuration's sequences taken back (``KEEP``); the fewest sequences win, then the larger part kept.
    The number of configurations depends on the capacity and the rounds, not on how many pieces there are.
    """
    left = dict(counts)
    rounded: dict[tuple, int] = {}
    bound = 0.0
    for _ in range(PASSES):
        found, least = solve_configurations(left, capacity, rounds)
        bound = max(bound, least)
        for config, many in round_configurations(found, left).items():
            rounded[config] = rounded.get(config, 0) + many
    chosen, placed = {}, 0
    for share in KEEP:
        kept, rest = take_share(rounded, share), dict(counts)
        for config, many in kept.items():
            for k, n in config:
                rest[k] -= n * many
        plan = dict(kept)
        for config, many in best_fit(rest, capacity).items():
            plan[config] = plan.get(config, 0) + many
        if not chosen or sum(plan.values()) < sum(chosen.values()):
            chosen, placed = plan, sum(counts.values()) - sum(rest.values())
        if sum(chosen.values()) <= int(np.ceil(bound - 1e-6)):
            break
    given = dict.fromkeys(counts, 0)
    rows, sequence = [], 0
    for config, many in sorted(chosen.items()):
        place = 0
        for x, n in config:
            rows.append(((x << 40) + given[x], sequence, n, place))
            given[x] += n * many
            place += n * x
        sequence += many
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return Plan(cols[:, 0], cols[:, 1], cols[:, 2], cols[:, 3], sequence, placed, bound)


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
               with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``.

    Only documents longer than the capacity are cut; all their pieces but the first are full.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, end = encoder(tokenizer), int(end_id).to_bytes(4, "little")
        for pdf in batches:
            out = []
            for doc_id, text in zip(pdf["doc_id"].astype(object), pdf["text"], strict=True):
                ids = enc.encode(text or "") + end
                n = len(ids) // 4
                start, stop = 0, n % capacity or capacity
                piece = 0
                while start < n:
                    part = ids[4 * start : 4 * stop]
                    row = (None if pd.isna(doc_id) else doc_id, piece, start, stop - start, zlib.crc32(part))
                    out.append((*row, np.frombuffer(part, "<u4").astype(np.int32)) if with_ids else row)
                    start, stop, piece = stop, stop + capacity, piece + 1
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])])

    return rows.mapInPandas(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else ""))


def pack(pieces: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a table of pieces with a ``length`` of 1 to ``capacity``.

    A sequence is filled from offset 0 without gaps.  Pieces of one length are ranked in hashed buckets, so that
    a very frequent length spreads; the driver sees one count per length and bucket number only
    in sums.  Equal pieces take places of their own.  An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    pieces = cut_lineage(pieces, "pieces")
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    plan = plan_packing(counts, capacity, rounds)
    buckets = max(1, -(-max(counts.values(), default=0) // bucket_rows))
    keyed = pieces.withColumn("_b", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    sums = keyed.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_at", F.coalesce(F.sum("_n").over(before), F.lit(0))).select(F.col("length").alias("_l"), F.col("_b").alias("_b2"), "_at")
    order = Window.partitionBy("length", "_b").orderBy("doc_id", "piece")
    ranked = keyed.withColumn("_rn", F.row_number().over(order) - 1).join(starts, (F.col("length") == F.col("_l")) & (F.col("_b") == F.col("_b2")))
    ranked = ranked.withColumn("_rank", F.col("_at") + F.col("_rn")).select(*pieces.columns, "_rank")
    held = spark.sparkContext.broadcast(plan)  # its size follows capacity and rounds

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seq, off = held.value.locate(pdf["length"].to_numpy(np.int64), pdf["_rank"].to_numpy(np.int64))
            yield pdf.drop(columns=["_rank"]).assign(sequence_id=seq, offset=off)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInPandas(place, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
                   with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``).

    Null and empty texts have the end id alone; repeated rows are packed each.
    """
    return pack(cut_pieces(docs, tokenizer, end_id, capacity, id_col, text_col, with_ids), capacity)
