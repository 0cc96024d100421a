"""Suffix order and common prefixes of a text of any length by induced sorting on disk.

Suffixes that begin a rising stretch after a falling one (the seeds) are sorted first: by the
stretches between them, recursively where these repeat. All others are induced from them in
two sweeps, upwards and downwards. A sweep takes suffixes from a priority queue in order and
puts the ones before them back in; the queue's tuples are first symbol, arrival, position and
common prefix with the one before. Whatever outgrows ``memory`` bytes lies in scratch files.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Iterator

import numpy as np

#: Tuples that a sweep handles at once.
BLOCK = 1 << 16
FAR = np.iinfo(np.int32).max


class Scratch:
    """Arrays and queues of one sort; files in ``folder`` where they are larger than ``memory``."""

    def __init__(self, folder: str, memory: int):
        self.folder, self.memory, self.files = folder, memory, 0

    def path(self) -> str:
        self.files += 1
        return os.path.join(self.folder, f"run-{self.files}")

    def array(self, size: int, dtype) -> np.ndarray:
        if size * np.dtype(dtype).itemsize <= self.memory:
            return np.zeros(size, dtype)
        return np.memmap(self.path(), dtype, "w+", shape=(size,))


class Run:
    """A spilled part of a queue: positions and common prefixes, symbol by symbol."""

    def __init__(self, path: str, held: dict[int, list[tuple[np.ndarray, np.ndarray]]]):
        self.path, self.symbols, self.bounds = path, sorted(held), [0]
        with open(path, "wb") as file:
            for symbol in self.symbols:
                parts = held[symbol]
                table = np.stack([np.concatenate([p[k] for p in parts]).astype(np.int64) for k in (0, 1)], axis=1)
                file.write(table.tobytes())
                self.bounds.append(self.bounds[-1] + len(table))
        self.at, self.row = 0, 0

    def symbol(self) -> int | None:
        return self.symbols[self.at] if self.at < len(self.symbols) else None

    def take(self, limit: int) -> tuple[np.ndarray, np.ndarray]:
        end = min(self.bounds[self.at + 1], self.row + limit)
        table = np.fromfile(self.path, np.int64, (end - self.row) * 2, offset=self.row * 16).reshape(-1, 2)
        self.row = end
        if end == self.bounds[self.at + 1]:
            self.at += 1
            if self.at == len(self.symbols):
                os.remove(self.path)
        return table[:, 0], table[:, 1].astype(np.int32)


class Queue:
    """Tuples by symbol, equal symbols in order of arrival; full memory goes to a run on disk.

    Runs are filled one after the other, so that a symbol's tuples in an older run come first.
    """

    def __init__(self, scratch: Scratch):
        self.scratch, self.runs = scratch, []
        self.held: dict[int, list] = {}
        self.order: list[int] = []
        self.size = 0

    def put(self, symbol: int, positions: np.ndarray, common: np.ndarray) -> None:
        if symbol not in self.held:
            self.held[symbol] = []
            heapq.heappush(self.order, symbol)
        self.held[symbol].append((positions, common))
        self.size += positions.nbytes + common.nbytes
        if self.size > self.scratch.memory:
            self.runs.append(Run(self.scratch.path(), self.held))
            self.held, self.order, self.size = {}, [], 0

    def least(self) -> int | None:
        self.runs = [r for r in self.runs if r.symbol() is not None]
        heads = [r.symbol() for r in self.runs] + self.order[:1]
        return min(heads, default=None)

    def take(self, symbol: int) -> tuple[np.ndarray, np.ndarray] | None:
        """The next tuples of the least symbol, a block at most; None if there are no more."""
        for run in self.runs:
            if run.symbol() == symbol:
                return run.take(BLOCK)
        parts = self.held.get(symbol)
        if not parts:
            if parts is not None:
                del self.held[symbol]
                heapq.heappop(self.order)
            return None
        positions, common = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        first, rest = slice(BLOCK), slice(BLOCK, None)
        self.size -= positions[first].nbytes + common[first].nbytes
        self.held[symbol] = [(positions[rest], common[rest])] if len(positions) > BLOCK else []
        return positions[first], common[first]


class Log:
    """Sorted suffixes of one sweep, written as they come and read back from the end."""

    def __init__(self, scratch: Scratch):
        self.scratch, self.parts, self.size = scratch, [], 0

    def add(self, symbol: int, positions: np.ndarray, common: np.ndarray) -> None:
        part = (symbol, positions, common)
        self.size += positions.nbytes + common.nbytes
        if self.size > self.scratch.memory:
            path = self.scratch.path()
            np.stack([positions.astype(np.int64), common.astype(np.int64)]).tofile(path)
            part = (symbol, path, None)
            self.size -= positions.nbytes + common.nbytes
        self.parts.append(part)

    def backwards(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        while self.parts:
            symbol, positions, common = self.parts.pop()
            if common is None:
                path = positions
                positions, common = np.fromfile(path, np.int64).reshape(2, -1)
                common = common.astype(np.int32)
                os.remove(path)
            else:
                self.size -= positions.nbytes + common.nbytes
            yield symbol, positions, common


def chunks(size: int) -> Iterator[slice]:
    for at in range(0, size, 1 << 20):
        yield slice(at, min(size, at + (1 << 20)))


def rising(text: np.ndarray, scratch: Scratch) -> np.ndarray:
    """Whether each suffix is less than the next; the last one, a symbol of its own, counts as so."""
    n = len(text)
    out = scratch.array(n, bool)
    out[n - 1] = True
    for part in reversed(list(chunks(n - 1))):
        here = text[part].astype(np.int64)
        after = np.append(here[1:], np.int64(text[part.stop]))
        step = np.sign(after - here)
        known = np.where(step != 0, np.arange(len(step)), len(step))
        at = np.minimum.accumulate(known[::-1])[::-1]
        sign = np.append(step, 1 if out[part.stop] else -1)
        out[part] = sign[at] > 0
    return out


def seeds_of(up: np.ndarray, scratch: Scratch) -> np.ndarray:
    """Positions where a rising stretch begins after a falling one, the last symbol included."""
    found = []
    for part in chunks(len(up)):
        before = np.append(up[part.start - 1] if part.start else True, up[part][:-1])
        found.append(np.flatnonzero(up[part] & ~before) + part.start)
    total = sum(len(f) for f in found)
    out, at = scratch.array(total, np.int64), 0
    for f in found:
        out[at : at + len(f)] = f
        at += len(f)
    return out


class Minima:
    """Least common prefix since the last tuple that went to each symbol."""

    def __init__(self, symbols: int, cap: int):
        self.since = np.full(symbols, -1, np.int32)
        self.cap = cap

    def of(self, common: np.ndarray, at: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Common prefix of the tuples at places ``at`` of a block, each with the one that went to
        the same target before it; ``targets`` is sorted, places ascend within a target."""
        new = np.empty(len(at), bool)
        if len(at):
            new[0] = True
            new[1:] = targets[1:] != targets[:-1]
        low = np.where(new, 0, np.append(0, at[:-1] + 1) if len(at) else 0)
        least = range_minima(common, low, at)
        firsts = np.flatnonzero(new)
        least[firsts] = np.minimum(least[firsts], self.since[targets[firsts]])
        whole = common.min()
        self.since = np.minimum(self.since, whole)
        if len(at):
            lasts = np.append(firsts[1:], len(at)) - 1
            ends = np.append(np.minimum.accumulate(common[::-1])[::-1], FAR)
            self.since[targets[lasts]] = ends[at[lasts] + 1]
        return np.minimum(least + 1, self.cap).astype(np.int32)


def range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of ``values[low..high]``, both included, from minima of power-of-two stretches."""
    out = np.empty(len(low), values.dtype)
    level = np.frexp(high - low + 1)[1] - 1
    table, k = values, 0
    while True:
        here = np.flatnonzero(level == k)
        if len(here):
            out[here] = np.minimum(table[low[here]], table[high[here] - (1 << k) + 1])
        if k >= (level.max() if len(level) else 0):
            return out
        table = np.minimum(table[: -(1 << k)], table[1 << k :])
        k += 1


class Sweep:
    """One direction of the induction: what follows in order puts what stands before it in line."""

    def __init__(self, text, up, upwards: bool, symbols: int, cap: int | None, scratch: Scratch):
        self.text, self.up, self.upwards, self.top = text, up, upwards, symbols - 1
        self.queue = Queue(scratch)
        self.minima = Minima(symbols, cap) if cap else None

    def line(self, symbols: np.ndarray) -> np.ndarray:
        return symbols if self.upwards else self.top - symbols

    def follow(self, positions: np.ndarray, common: np.ndarray) -> None:
        before = positions - 1
        fits = positions > 0
        fits[fits] = self.up[before[fits]] != self.upwards
        at = np.flatnonzero(fits)
        before = before[at]
        targets = self.line(self.text[before].astype(np.int64))
        # Few symbols sort by counting.
        order = np.argsort(targets.astype(np.uint8) if self.top < 256 else targets, kind="stable")
        at, before, targets = at[order], before[order], targets[order]
        lengths = self.minima.of(common, at, targets) if self.minima else np.zeros(len(at), np.int32)
        cuts = np.flatnonzero(targets[1:] != targets[:-1]) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
            if hi > lo:
                self.queue.put(int(targets[lo]), before[lo:hi], lengths[lo:hi])


def run_length(text: np.ndarray, at: int, cap: int) -> int:
    same = np.asarray(text[at : at + cap]) == text[at]
    return int(len(same) if same.all() else np.argmin(same))


def border(text: np.ndarray, falling: int, rising_: int, cap: int) -> int:
    """Common prefix of the last falling and first rising suffix of one symbol: its repeats."""
    return min(run_length(text, falling, cap), run_length(text, rising_, cap))


def induce(text, up, seeds, seed_common, cap: int | None, symbols: int, scratch: Scratch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes from the greatest down, with the common prefix each has with the one before it.

    Common prefixes count up to ``cap``; without one they are not kept.
    """
    sweep = Sweep(text, up, True, symbols, cap, scratch)
    log = Log(scratch)
    at = 0
    while True:
        heads = [h for h in (sweep.queue.least(), int(text[seeds[at]]) if at < len(seeds) else None) if h is not None]
        if not heads:
            break
        symbol, last = min(heads), None
        while (block := sweep.queue.take(symbol)) is not None:
            log.add(symbol, *block)
            sweep.follow(*block)
            last = int(block[0][-1])
        while at < len(seeds) and text[seeds[at]] == symbol:
            positions = np.array(seeds[at : at + BLOCK])
            positions = positions[: np.searchsorted(text[positions], symbol, side="right")]
            common = np.zeros(len(positions), np.int32)
            if cap:
                common[:] = seed_common[at : at + len(positions)]
                if last is not None:
                    common[0] = border(text, last, int(positions[0]), cap)
                    last = None
            sweep.follow(positions, common)
            at += len(positions)

    down = Sweep(text, up, False, symbols, cap, scratch)
    falling = log.backwards()
    part = next(falling, None)
    while True:
        heads = [h for h in (down.queue.least(), None if part is None else down.top - part[0]) if h is not None]
        if not heads:
            return
        line, last = min(heads), None
        while (block := down.queue.take(line)) is not None:
            down.follow(*block)
            last = int(block[0][-1])
            yield block
        kept = 0  # of the suffix above, with the one that follows here
        if cap and last is not None and part is not None and down.top - part[0] == line:
            kept = border(text, int(part[1][-1]), last, cap)
        while part is not None and down.top - part[0] == line:
            positions, with_lower = part[1][::-1].copy(), part[2][::-1]
            common = np.append(np.int32(kept), with_lower[:-1]).astype(np.int32)
            kept = int(with_lower[-1])
            down.follow(positions, common)
            yield positions, common
            part = next(falling, None)


def by_doubling(text: np.ndarray) -> np.ndarray:
    """Suffix order of a short text in memory, by prefixes of doubling length.

    A rank is the number of smaller suffixes so far; only suffixes that share one go on.
    """
    n, k = len(text), 1
    order = np.argsort(text)
    ranks_in_order = first_places(text[order])
    rank = np.empty(n, np.int64)
    rank[order] = ranks_in_order
    live = order[shared(ranks_in_order)]
    while len(live):
        beyond = np.minimum(live + k, n)
        key = rank[live] * np.int64(n + 1) + np.where(live + k < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        live = live[np.argsort(key)]
        key.sort()
        old = rank[live]
        new = old + first_places(key) - first_places(old)
        rank[live] = new
        live = live[shared(new)]
        k *= 2
    order[rank] = np.arange(n)
    return order


def first_places(values: np.ndarray) -> np.ndarray:
    """For sorted values, the place of the first equal one."""
    new = np.concatenate([[True], values[1:] != values[:-1]])
    return np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))


def shared(values: np.ndarray) -> np.ndarray:
    """For sorted values, whether a neighbour is equal."""
    same = np.concatenate([[False], values[1:] == values[:-1], [False]])
    return same[1:] | same[:-1]


def same_stretches(text: np.ndarray, one: np.ndarray, two: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the stretches of ``lengths`` symbols at ``one`` and ``two`` are equal."""
    same = np.ones(len(one), bool)
    live, offset = np.flatnonzero(lengths > 0), 0
    while len(live) > 64:
        equal = text[one[live] + offset] == text[two[live] + offset]
        same[live[~equal]] = False
        offset += 1
        live = live[equal & (lengths[live] > offset)]
    for k in live.tolist():
        a, b, rest = int(one[k]) + offset, int(two[k]) + offset, int(lengths[k]) - offset
        same[k] = np.array_equal(text[a : a + rest], text[b : b + rest])
    return same


def common_prefixes(text: np.ndarray, order: np.ndarray, cap: int, scratch: Scratch) -> np.ndarray:
    """Common prefix of each suffix in ``order`` with the one before it, up to ``cap``.

    Eight bytes are compared at once; the first unequal one is the lowest set bit's.
    """
    out = scratch.array(len(order), np.int32)
    n, width = len(text), 8 // text.itemsize
    wide = np.lib.stride_tricks.as_strided(text[: n // width * width].view(np.uint64), (max(n - width + 1, 0),), (text.itemsize,))
    for part in chunks(len(order)):
        here = np.asarray(order[part])
        before = np.append(order[part.start - 1] if part.start else n - 1, here[:-1])
        length = np.zeros(len(here), np.int32)
        live = np.arange(len(here))
        while len(live):
            a, b = here[live] + length[live], before[live] + length[live]
            near = np.maximum(a, b) <= n - width
            for k in live[~near].tolist():
                length[k] += short_prefix(text, int(here[k] + length[k]), int(before[k] + length[k]))
            live, a, b = live[near], a[near], b[near]
            differ = wide[a] ^ wide[b]
            unequal = differ != 0
            lowest = differ[unequal] & (~differ[unequal] + np.uint64(1))
            length[live[unequal]] += ((np.frexp(lowest.astype(np.float64))[1] - 1) >> 3) // text.itemsize
            live = live[~unequal]
            length[live] += width
            live = live[length[live] < cap]
        out[part] = np.minimum(length, cap)
    return out


def short_prefix(text: np.ndarray, a: int, b: int) -> int:
    """Common prefix of two suffixes of which one ends within a few symbols."""
    k = 0
    while max(a, b) + k < len(text) and text[a + k] == text[b + k]:
        k += 1
    return k


def sorted_seeds(text, up, seeds, symbols: int, in_memory: int, scratch: Scratch) -> np.ndarray:
    """The seeds in order of their suffixes: stretches get names, and the text of names is sorted."""
    first = np.argsort(text[seeds], kind="stable")
    named = scratch.array(len(seeds), np.int64)
    at = len(seeds)
    is_seed = scratch.array(len(text), bool)
    for part in chunks(len(seeds)):
        is_seed[seeds[part]] = True
    is_seed[len(text) - 1] = False
    for positions, _ in induce(text, up, seeds[first], None, None, symbols, scratch):
        found = positions[is_seed[positions]]
        named[at - len(found) : at] = found[::-1]
        at -= len(found)
    named[0] = len(text) - 1
    ends = scratch.array(len(seeds), np.int64)
    ends[:-1] = seeds[1:]
    ends[-1] = len(text) - 1
    names = scratch.array(len(seeds), np.int64)
    last, before = 0, None
    for part in chunks(len(named)):
        here = np.asarray(named[part])
        place = np.searchsorted(seeds, here)
        length = ends[place] - here + 1
        prior = np.append(here[0] if before is None else before[0], here[:-1])
        prior_length = np.append(length[0] if before is None else before[1], length[:-1])
        differ = prior_length != length
        check = np.flatnonzero(~differ)
        differ[check] = ~same_stretches(text, here[check], prior[check], length[check])
        if before is None:
            differ[0] = False
        values = last + np.cumsum(differ)
        names[place] = values
        last, before = int(values[-1]), (here[-1], length[-1])
    if last == len(seeds) - 1:
        return named
    return seeds[suffix_order(names, in_memory, scratch)]


def suffix_order(text: np.ndarray, in_memory: int, scratch: Scratch) -> np.ndarray:
    """Order of the suffixes of ``text``, which ends in its only least symbol, 0."""
    if len(text) <= in_memory:
        return by_doubling(np.asarray(text))
    symbols = int(text.max()) + 1
    up = rising(text, scratch)
    seeds = seeds_of(up, scratch)
    order = sorted_seeds(text, up, seeds, symbols, in_memory, scratch)
    out = scratch.array(len(text), np.int64)
    at = len(text)
    for positions, _ in induce(text, up, order, None, None, symbols, scratch):
        out[at - len(positions) : at] = positions[::-1]
        at -= len(positions)
    out[0] = len(text) - 1
    return out


def with_common_prefixes(text: np.ndarray, cap: int, in_memory: int, scratch: Scratch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes of a text, greatest first, in blocks, each with its common prefix with the one
    before. ``text`` has symbols of one or two bytes and ends in its only 0; up to ``in_memory``
    names are sorted without files."""
    symbols = np.iinfo(text.dtype).max + 1
    up = rising(text, scratch)
    seeds = seeds_of(up, scratch)
    order = sorted_seeds(text, up, seeds, symbols, in_memory, scratch)
    common = common_prefixes(text, order, cap, scratch)
    yield from induce(text, up, order, common, cap, symbols, scratch)
