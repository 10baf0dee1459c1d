"""Window statistics over sorted Arrow batches: rolling mean, std, min and max, back-filled lags, differences.

The rows of a group stand next to each other, in order.  Everything is computed for all groups of a batch at once by
shifting whole columns: a window of 2h (+ 1) rows is its last h rows joined with the h before (and one more), so a row
costs the logarithm of the window, not its size.  Means and squared deviations are joined by the pairwise formula
and stay exact for values far from 0.  A group is read whole before it is computed; groups are bounded by the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Windows up to this size are added up value by value.
DIRECT = 6
#: Rows that are computed at once, at least, where there are as many.
BUFFER_ROWS = 1 << 14


class Groups:
    """Where each row's group starts and ends; shifting that stays in the group."""

    def __init__(self, start: np.ndarray):
        """``start``: whether a row is the first of its group."""
        n = len(start)
        first = np.flatnonzero(start)
        size = np.diff(np.r_[first, n])
        self.first = np.repeat(first, size)
        self.last = np.repeat(first + size - 1, size)
        self.place = np.arange(n) - self.first

    def shift(self, a: np.ndarray, rows: int, empty: float) -> np.ndarray:
        out = np.full_like(a, empty)
        out[rows:] = a[: max(len(a) - rows, 0)]  # a task may hold fewer rows than the window
        out[self.place < rows] = empty
        return out


@dataclass
class Block:
    """Per row: number of values, their mean, sum of squared deviations, least and greatest (NaN without values)."""

    n: np.ndarray
    mean: np.ndarray
    dev: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, values: list[np.ndarray]) -> Block:
        known = [~np.isnan(v) for v in values]
        n = sum(k.astype(float) for k in known)
        mean = sum(np.where(k, v, 0.0) for k, v in zip(known, values, strict=True)) / np.where(n > 0, n, np.nan)
        dev = sum(np.where(k, (v - mean) ** 2, 0.0) for k, v in zip(known, values, strict=True))
        low, high = values[0], values[0]
        for v in values[1:]:
            low, high = np.fmin(low, v), np.fmax(high, v)
        return cls(n, mean, dev, low, high)

    def shifted(self, groups: Groups, rows: int) -> Block:
        empty = (0.0, np.nan, 0.0, np.nan, np.nan)
        return Block(*(groups.shift(a, rows, e) for a, e in zip((self.n, self.mean, self.dev, self.low, self.high), empty, strict=True)))

    def joined(self, before: Block) -> Block:
        n = self.n + before.n
        both = (self.n > 0) & (before.n > 0)
        step = np.where(both, before.mean - self.mean, 0.0)
        share = before.n / np.where(n > 0, n, 1.0)
        mean = np.where(both, self.mean + step * share, np.where(self.n > 0, self.mean, before.mean))
        return Block(n, mean, self.dev + before.dev + step * step * self.n * share, np.fmin(self.low, before.low), np.fmax(self.high, before.high))

    def std(self) -> np.ndarray:
        """Sample standard deviation, 0 for fewer than two values."""
        return np.sqrt(self.dev / np.where(self.n > 1, self.n - 1, 1.0)) * (self.n > 1)


def rolling_block(x: np.ndarray, size: int, groups: Groups, made: dict[int, Block]) -> Block:
    if size not in made:
        if size <= DIRECT:
            made[size] = Block.of([x, *[groups.shift(x, k, np.nan) for k in range(1, size)]])
        else:
            half = rolling_block(x, size // 2, groups, made)
            whole = half.joined(half.shifted(groups, size // 2))
            made[size] = whole.joined(Block.of([groups.shift(x, size - 1, np.nan)])) if size % 2 else whole
    return made[size]


def next_known(x: np.ndarray, p: np.ndarray, groups: Groups, beyond_p: np.ndarray, beyond_v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and value of the first known value at or after each row; ``beyond_*`` is what follows the group (or NaN)."""
    n = len(x)
    at = np.where(np.isnan(x), n, np.arange(n))
    at = np.minimum.accumulate(at[::-1])[::-1]
    inside = at <= groups.last
    at = np.where(inside, at, 0)
    return np.where(inside, p[at], beyond_p), np.where(inside, x[at], beyond_v)


def window_columns(x: np.ndarray, p: np.ndarray, total: np.ndarray, groups: Groups, windows: list[int], lags: list[int],
                   beyond_p: np.ndarray, beyond_v: np.ndarray) -> dict[str, np.ndarray]:
    """The feature columns of one sensor by the end of their name; NaN is missing.  ``p`` is the row's place in its
    series of ``total`` rows."""
    out, made = {}, {}
    for size in windows:
        b = rolling_block(x, size, groups, made)
        out |= {f"roll_mean_{size}": b.mean, f"roll_std_{size}": b.std(), f"roll_min_{size}": b.low, f"roll_max_{size}": b.high}
    kp, kv = next_known(x, p, groups, beyond_p, beyond_v)
    for k in lags:
        at = np.where(p <= k, groups.first, np.maximum(np.arange(len(x)) - k, 0))
        out[f"lag_{k}"] = np.where(kp[at] <= total - k, kv[at], np.nan)
    step = x - groups.shift(x, 1, np.nan)
    out["diff"] = np.where(np.isnan(step), 0.0, step)
    return out


def _doubles(column: pa.ChunkedArray) -> np.ndarray:
    return column.cast(pa.float64(), safe=False).to_numpy().astype(float)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, of ``BUFFER_ROWS`` rows or more, and where groups start in them."""
    held: list[pa.RecordBatch] = []
    rows, last = 0, False
    batches = iter(batches)
    while not last:
        batch = next(batches, None)
        last = batch is None
        if not last and batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if not held or rows < BUFFER_ROWS and not last:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        start = np.r_[True, np.zeros(table.num_rows - 1, bool)]
        for k in keys:
            code = pc.dictionary_encode(table[k].combine_chunks(), null_encoding="encode").indices.to_numpy()
            start[1:] |= code[1:] != code[:-1]
        cut = table.num_rows if last else int(np.flatnonzero(start)[-1])
        if cut:
            yield table.slice(0, cut), start[:cut]
        held = table.slice(cut).to_batches() if cut < table.num_rows else []
        rows = table.num_rows - cut


@dataclass
class Placed:
    """Rows of whole groups with their places: ``p`` of ``total`` in the series; ``keep`` are those given out."""

    table: pa.Table
    groups: Groups
    p: np.ndarray
    total: np.ndarray
    end: np.ndarray
    beyond: np.ndarray
    keep: np.ndarray

    def sensor(self, i: int, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Readings, and place and value of the next known reading beyond each row's group."""
        x = _doubles(self.table[name])
        if not len(self.beyond):
            none = np.full(len(x), np.nan)
            return x, none, none
        return np.where(self.end, np.nan, x), self.beyond[self.groups.last, i], np.where(self.end, x, np.nan)[self.groups.last]


def placed_groups(batches: Iterator[pa.RecordBatch], unit: str, sensors: list[str], seg_rows: int, whole: bool, last: int | None) -> Iterator[Placed]:
    """``whole``: a group is a unit with all its rows.  Otherwise it is a segment, see :func:`feature_batches`.  With
    ``last``, only each unit's last row is given out, from its last so many rows."""
    for table, start in whole_groups(batches, [unit] if whole else [unit, "_wseg"]):
        groups = Groups(start)
        if whole:
            p = groups.place + 1.0
            total = groups.last - groups.first + 1.0
            if last is not None:
                near = np.flatnonzero(p > total - last)
                table, p, total = table.take(pa.array(near)), p[near], total[near]
                groups = Groups(np.r_[True, groups.first[near][1:] != groups.first[near][:-1]])
            end, beyond, keep = np.zeros(len(p), bool), np.empty((0, 0)), np.arange(len(p))
        else:
            p, total, wseg = (_doubles(table[c]) for c in ("_p", "_n", "_wseg"))
            end = table["_kp"].is_valid().to_numpy()
            beyond = np.full((table.num_rows, len(sensors)), np.nan)
            if end.any():
                at = np.flatnonzero(end)
                places = np.array(table["_kp"].take(pa.array(at)).to_pylist(), float).reshape(len(at), len(sensors))
                beyond[at] = places
            keep = np.flatnonzero(~end & ((p - 1) // seg_rows == wseg))
        yield Placed(table, groups, p, total, end, beyond, keep if last is None else keep[p[keep] == total[keep]])


def feature_batches(base: list[str], unit: str, sensors: list[str], windows: list[int], lags: list[int],
                    seg_rows: int, names: list[str], whole: bool = False, last: int | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow`` over sorted rows: the columns ``names``, of which ``base`` stay as they are.

    With ``whole``, rows are sorted by ``unit`` and place and every unit is there with all its rows.  Otherwise they are
    sorted by (``unit``, ``_wseg``, ``_p``): a row with ``_kp`` set ends its group and holds place (``_kp``) and value of
    the next known reading per sensor; rows that belong to another segment than the group's are looked at and not
    given out.  With ``last``, only the last row of each unit is, whose windows reach its last so many rows.
    """
    wanted = set(names)
    sizes = {s: [w for w in windows if wanted & {f"{s}_roll_{t}_{w}" for t in ("mean", "std", "min", "max")}] for s in sensors}
    steps = {s: [k for k in lags if f"{s}_lag_{k}" in wanted] for s in sensors}
    used = [(i, s) for i, s in enumerate(sensors) if sizes[s] or steps[s] or f"{s}_diff" in wanted]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in placed_groups(batches, unit, sensors, seg_rows, whole, last):
            picked = None if len(g.keep) == g.table.num_rows else pa.array(g.keep)
            columns = {c: (g.table[c] if picked is None else g.table[c].take(picked)).combine_chunks() for c in base}
            for i, s in used:
                x, bp, bv = g.sensor(i, s)
                for name, v in window_columns(x, g.p, g.total, g.groups, sizes[s], steps[s], bp, bv).items():
                    if f"{s}_{name}" in wanted:
                        v = v if picked is None else v[g.keep]
                        columns[f"{s}_{name}"] = pa.array(v, pa.float64(), mask=np.isnan(v))
            yield from pa.table([columns[c] for c in names], names=names).to_batches()

    return run


def lag_sum_batches(unit: str, sensors: list[str], lags: list[int], seg_rows: int, whole: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """As :func:`feature_batches`, but only the sum and number of the known values of each lag column: (column, total, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {f"{s}_lag_{k}": [0.0, 0] for s in sensors for k in lags}
        for g in placed_groups(batches, unit, sensors, seg_rows, whole, None):
            for i, s in enumerate(sensors):
                x, bp, bv = g.sensor(i, s)
                made = window_columns(x, g.p, g.total, g.groups, [], lags, bp, bv)
                for k in lags:
                    v = made[f"lag_{k}"][g.keep]
                    known = ~np.isnan(v)
                    sums[f"{s}_lag_{k}"][0] += float(v[known].sum())
                    sums[f"{s}_lag_{k}"][1] += int(known.sum())
        yield pa.RecordBatch.from_pydict({"column": list(sums), "total": [t for t, _ in sums.values()], "n": [n for _, n in sums.values()]})

    return run
