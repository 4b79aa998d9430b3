"""External suffix sorting by induction, with common-prefix values.

Suffixes whose type (smaller or larger than their successor) changes are sorted first, by naming the pieces between them and
sorting the string of names, recursively while it does not fit into memory. From these seeds the order of all other suffixes
is induced: a suffix tuple (position, common prefix with the one before it) that leaves the queue of its first symbol puts
the suffix one to its left into the queue of that symbol. The common prefix of two suffixes that land next to each other is one
more than the smallest value passed between the two tuples that sent them.

Queues hold tuples in sorted runs; beyond ``memory`` tuples a run goes to disk and is mapped back. Tuples of one symbol leave in
batches, so a shard costs a few array operations for each symbol and run of equal symbols rather than one for each suffix.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

BASE = 8_000_000  # symbols up to which the string of names is sorted in memory
MEMORY = 16_000_000  # tuples that queues and results hold in memory


class Disk:
    """A task's spill folder; arrays beyond the memory limit are written there and mapped. Removed when the task is done."""

    def __init__(self, memory: int):
        self.memory, self.used, self.files, self.folder = memory, 0, 0, None

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        if self.folder:
            self.folder.cleanup()

    def keep(self, array: np.ndarray) -> np.ndarray:
        self.used += len(array)
        return self.spill(array) if self.used > self.memory else array

    def spill(self, array: np.ndarray) -> np.ndarray:
        if not len(array):
            return array
        if not self.folder:
            self.folder = tempfile.TemporaryDirectory(prefix="suffixes-")
        self.files += 1
        path = os.path.join(self.folder.name, f"{self.files}.npy")
        np.save(path, array)
        self.used -= len(array)
        return np.load(path, mmap_mode="r")


class Queue:
    """A priority queue of (symbol, position, value); tuples of a symbol leave in the order in which they came."""

    def __init__(self, disk: Disk):
        self.disk, self.runs, self.waiting, self.size, self.read = disk, [], {}, 0, {}

    def push(self, keys, positions, values) -> None:
        """``keys`` are sorted; tuples of equal keys stand in their order."""
        if not len(keys):
            return
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            self.waiting.setdefault(int(keys[a]), []).append((positions[a:b], values[a:b]))
        self.size += len(keys)
        if self.size > self.disk.memory // 4:
            parts = [(key, p, v) for key in sorted(self.waiting) for p, v in self.waiting[key]]
            run = (np.repeat([k for k, _, _ in parts], [len(p) for _, p, _ in parts]),
                   np.concatenate([p for _, p, _ in parts]), np.concatenate([v for _, _, v in parts]))
            self.runs.append(tuple(self.disk.spill(c) for c in run))
            self.waiting, self.size = {}, 0

    def pop(self, key: int):
        """(positions, values) of the tuples with this symbol that have not left yet."""
        found = []
        for keys, positions, values in self.runs[self.read.get(key, 0):]:
            a, b = np.searchsorted(keys, [key, key + 1])
            found.append((positions[a:b], values[a:b]))
        self.read[key] = len(self.runs)
        own = self.waiting.pop(key, [])
        self.size -= sum(len(p) for p, _ in own)
        found += own
        if not found:
            return np.empty(0, np.int32), np.empty(0, np.int32)
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor; the last one, the sentinel, is."""
    up = np.r_[text[1:] > text[:-1], True]
    unlike = np.flatnonzero(np.r_[text[1:] != text[:-1], True])
    # a run of one symbol has the type of its last suffix
    return np.repeat(up[unlike], np.diff(unlike, prepend=-1))


def place_type(text: np.ndarray):
    """Positions take four bytes each where they fit."""
    return np.int32 if len(text) < 1 << 30 else np.int64


def blocks(text: np.ndarray) -> np.ndarray:
    """Eight consecutive bytes from every position on, as one number each (a view)."""
    padded = np.concatenate([text.astype(np.uint8), np.zeros(8, np.uint8)])
    return np.ndarray(len(text), "<u8", padded, strides=(1,))


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Bytes, up to ``limit``, that the different suffixes at ``a`` and ``b`` have in common."""
    eight, out, alive = blocks(text) if len(a) > 64 else None, np.full(len(a), limit, np.int32), np.arange(len(a))
    if eight is None:
        for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
            n = min(limit, len(text) - max(x, y))
            unlike = np.flatnonzero(text[x:x + n] != text[y:y + n])
            out[i] = unlike[0] if len(unlike) else n
        return out
    for k in range(0, limit, 8):
        unlike = eight[a[alive] + k] ^ eight[b[alive] + k]
        ended = unlike != 0
        first = unlike[ended]
        low = np.bitwise_count((first & (~first + np.uint64(1))) - np.uint64(1)).astype(np.int32) >> 3
        out[alive[ended]] = np.minimum(k + low, limit)
        alive = alive[~ended]
        if not len(alive):
            break
    return out


def range_minimum(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(values[low:high + 1]) for each pair, by minima of power-of-two ranges."""
    out = np.empty(len(low), values.dtype)
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    table = values
    for k in range(int(level.max(initial=-1)) + 1):
        at = np.flatnonzero(level == k)
        if len(at):
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << k) + 1])
        table = np.minimum(table[:-(1 << k) or None][:max(0, len(table) - (1 << k))], table[1 << k:])
    return out


class Sender:
    """Sends the suffix left of every tuple of a batch to the queue of its first symbol, if it has the wanted type."""

    def __init__(self, text, wanted, queue: Queue, symbols: int, limit: int, with_values: bool):
        self.text, self.wanted, self.queue, self.limit, self.with_values = text, wanted, queue, limit, with_values
        self.since = np.zeros(symbols, np.int32)  # by symbol: the smallest value passed since its last tuple
        self.fresh = np.ones(symbols, bool)

    def send(self, positions: np.ndarray, values: np.ndarray) -> None:
        if not len(positions):
            return
        left = positions - 1
        ok = left >= 0
        ok[ok] = self.wanted[left[ok]]
        at = np.flatnonzero(ok)
        keys = self.text[left[at]]
        order = np.argsort(keys, kind="stable")
        at, keys = at[order], keys[order]
        if not self.with_values:
            self.queue.push(keys, left[at], np.zeros(len(at), np.int32))
            return
        low_so_far = np.minimum.accumulate(values)
        first = np.r_[True, keys[1:] != keys[:-1]] if len(keys) else np.empty(0, bool)
        got = np.empty(len(at), np.int32)
        k = keys[first]
        got[first] = np.where(self.fresh[k], -1, np.minimum(self.since[k], low_so_far[at[first]]))
        rest = np.flatnonzero(~first)
        if len(rest):
            got[rest] = range_minimum(values, at[rest - 1] + 1, at[rest])
        np.minimum(self.since, low_so_far[-1], out=self.since)
        if len(k):
            last = at[np.r_[first[1:], True]]
            after = np.minimum.accumulate(values[::-1])[::-1]
            self.since[k] = np.where(last + 1 < len(values), after[np.minimum(last + 1, len(values) - 1)], self.limit)
            self.fresh[k] = False
        self.queue.push(keys, left[at], np.minimum(got + 1, self.limit).astype(np.int32))


def induce(text, small, seeds, seed_values, limit, disk: Disk, with_values=True):
    """All suffixes in order, from the order of the seeds: yields (positions, values) from the largest symbol down.

    Values are common prefixes with the suffix before, up to ``limit``; in each batch positions ascend in order.
    """
    symbols, place = np.unique(text), place_type(text)
    seeds = seeds.astype(place, copy=False)
    top = int(symbols[-1]) + 1
    heads = text[seeds]
    bounds = np.searchsorted(heads, symbols, "left"), np.searchsorted(heads, symbols, "right")
    queue = Queue(disk)
    sender = Sender(text, ~small, queue, top, limit, with_values)
    large = []
    for s, key in enumerate(symbols.tolist()):
        parts = []
        while True:
            positions, values = queue.pop(key)
            if not len(positions):
                break
            parts.append((positions, values))
            sender.send(positions, values)
        positions = np.concatenate([p for p, _ in parts]) if parts else np.empty(0, place)
        values = np.concatenate([v for _, v in parts]) if parts else np.empty(0, np.int32)
        large.append((disk.keep(positions), disk.keep(values)))
        a, b = bounds[0][s], bounds[1][s]
        if b > a:
            own = seed_values[a:b].copy()
            if with_values:
                own[0] = common_prefix(text, positions[-1:], seeds[a:a + 1], limit)[0] if len(positions) else 0
            sender.send(seeds[a:b], own)
    queue = Queue(disk)
    sender = Sender(text, small, queue, top, limit, with_values)
    for s in range(len(symbols) - 1, -1, -1):
        key = int(symbols[s])
        parts = []
        if key == text[-1] and s == 0:
            parts.append((np.array([len(text) - 1], place), np.zeros(1, np.int32)))  # the sentinel
        while True:
            positions, values = queue.pop(key)
            if not len(positions):
                break
            parts.append((positions, values))
            sender.send(positions, values)
        down = np.concatenate([p for p, _ in parts]) if parts else np.empty(0, place)
        down_values = np.concatenate([v for _, v in parts]) if parts else np.empty(0, np.int32)
        up, up_values = (np.asarray(x) for x in large.pop())
        border = 0
        if with_values and len(down) and len(up):
            border = int(common_prefix(text, up[-1:], down[-1:], limit)[0])
        if len(up):
            # processed from the largest: the value of a tuple is its common prefix with the larger neighbour
            sender.send(up[::-1], np.r_[np.int32(border), up_values[:0:-1]].astype(np.int32))
        if len(up) + len(down):
            # a smaller suffix's value, held against the next larger one, moves to that one
            values = np.concatenate([np.r_[np.int32(0), up_values[1:]] if len(up) else up_values[:0],
                                     np.r_[np.int32(border), down_values[:0:-1]] if len(down) else down_values[:0]])
            yield np.concatenate([up, down[::-1]]), values.astype(np.int32)


def unlike_before(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """True where the piece ``text[start:start + size]`` differs from the one before; symbols of equally long ones are compared."""
    out = np.r_[True, sizes[1:] != sizes[:-1]]
    alive, k = np.flatnonzero(~out), 0
    while len(alive) > 64:
        same = text[starts[alive] + k] == text[starts[alive - 1] + k]
        out[alive[~same]] = True
        k += 1
        alive = alive[same & (sizes[alive] > k)]
    for i in alive.tolist():
        a, b, size = int(starts[i - 1]), int(starts[i]), int(sizes[i])
        out[i] = not np.array_equal(text[a + k:a + size], text[b + k:b + size])
    return out


def names(text, small, starts, disk):
    """(name of each seed's piece in text order, number of names): pieces in order, by inducing from unsorted seeds."""
    starts = starts.astype(place_type(text), copy=False)
    rough = starts[np.argsort(text[starts], kind="stable")]
    is_seed = np.zeros(len(text), bool)
    is_seed[starts] = True
    ordered = [disk.keep(p[is_seed[p]]) for p, _ in
               induce(text, small, rough, np.zeros(len(rough), np.int32), 1, disk, with_values=False)]
    ordered = np.concatenate(ordered[::-1])
    number = np.searchsorted(starts, ordered)
    sizes = np.minimum(np.r_[starts[1:], len(text) - 1] + 1, len(text)) - starts
    name = np.cumsum(unlike_before(text, ordered, sizes[number])) - 1
    out = np.empty(len(starts), np.int64)
    out[number] = name
    return out, int(name[-1]) + 1


def double(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string in memory, by doubling the compared length."""
    rank, n, length = np.unique(text, return_inverse=True)[1].astype(np.int64), len(text), 1
    while True:
        after = np.zeros(n, np.int64)
        after[:max(0, n - length)] = rank[length:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key)
        sorted_ = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, sorted_[1:] != sorted_[:-1]])
        length *= 2
        if rank[order[-1]] == n - 1:
            return order


def order_seeds(text, small, disk, base):
    starts = np.flatnonzero(small & ~np.r_[True, small[:-1]])
    if len(starts) < 2:
        return starts
    name, count = names(text, small, starts, disk)
    if count == len(starts):
        return starts[np.argsort(name)]
    if len(name) <= base:
        return starts[double(name)]
    inner = [disk.keep(p) for p, _ in sort(name, 0, disk, base, with_values=False)]
    return starts[np.concatenate(inner[::-1])]


def sort(text: np.ndarray, limit: int, disk: Disk, base: int = BASE, with_values: bool = True):
    """Batches (positions, values), from the largest symbol down, of the suffixes of ``text`` in order.

    The last symbol must be smaller than all others; with values the symbols are bytes. Values are common prefixes with the suffix before, up to ``limit``.
    """
    small = types(text)
    seeds = order_seeds(text, small, disk, base)
    values = np.zeros(len(seeds), np.int32)
    if with_values:
        values[1:] = common_prefix(text, seeds[:-1], seeds[1:], limit)
    yield from induce(text, small, seeds, values, limit, disk, with_values)


def suffix_array(text: np.ndarray, limit: int, memory: int = MEMORY, base: int = BASE):
    """(order, common prefixes) of all suffixes of ``text``, whose last symbol is its smallest and unique."""
    with Disk(memory) as disk:
        batches = list(sort(text, limit, disk, base))
        return tuple(np.concatenate(c) for c in zip(*batches[::-1], strict=True))
