"""Suffix arrays with common-prefix values by induced sorting, with queues that go to disk when they outgrow memory.

The suffixes that start a rising slope (S*) are named by their substrings and ordered over the string of names. All others are
induced: a suffix takes its place from the suffix behind it, through a queue for each first symbol. Queues take and
give whole arrays of tuples (place, common prefix). What two neighbours in a queue have in common is one more than the least
common prefix between the suffixes that they come from, so that common prefixes are induced together with the order.

Nothing beyond ``cap`` symbols is told apart: the order is that of the first ``cap`` symbols, and common prefixes end there. So
the string of names, whose names stand for two symbols or more, is ranked by doubling up to that length.
"""

from __future__ import annotations

import tempfile

import numpy as np

MEMORY = 64 << 20


class Queues:
    """First-in-first-out queues of (place, common prefix), one for each symbol, in memory up to a limit and then in a file.

    The file is an unnamed one: it belongs to the task alone and ends with it.
    """

    def __init__(self, symbols: int, memory: int = MEMORY):
        self.held: list[list] = [[] for _ in range(symbols)]
        self.on_disk: list[list[tuple[int, int]]] = [[] for _ in range(symbols)]
        self.memory, self.used, self.file = memory, 0, None

    def push(self, symbol: int, places: np.ndarray, common: np.ndarray) -> None:
        self.held[symbol].append((places, common))
        self.used += places.nbytes + common.nbytes
        if self.used > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for symbol, parts in enumerate(self.held):
            if parts:
                places, common = (np.concatenate(arrays) for arrays in zip(*parts))
                self.on_disk[symbol].append((self.file.tell(), len(places)))
                self.file.write(places.tobytes() + common.tobytes())
                self.held[symbol] = []
        self.used = 0

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray] | None:
        """All that waits for a symbol, in the order in which it came."""
        parts = []
        for start, count in self.on_disk[symbol]:
            self.file.seek(start)
            parts.append((np.frombuffer(self.file.read(8 * count), np.int64), np.frombuffer(self.file.read(count), np.uint8)))
        parts += self.held[symbol]
        self.used -= sum(places.nbytes + common.nbytes for places, common in self.held[symbol])
        self.on_disk[symbol], self.held[symbol] = [], []
        if not parts:
            return None
        return parts[0] if len(parts) == 1 else tuple(np.concatenate(arrays) for arrays in zip(*parts))


def rising(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one (type S). The last is not, for the end is smaller than any symbol."""
    starts = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
    symbols = text[starts].astype(np.int64)
    return np.repeat(symbols < np.append(symbols[1:], -1), np.diff(np.append(starts, len(text))))


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, by comparison."""
    found = np.full(len(a), cap, np.uint8)
    left, n = np.arange(len(a)), len(text)
    for size in range(cap):
        a_at, b_at = a[left] + size, b[left] + size
        same = (a_at < n) & (b_at < n)
        same &= text[np.minimum(a_at, n - 1)] == text[np.minimum(b_at, n - 1)]
        found[left[~same]] = size
        left = left[same]
        if not len(left):
            break
    return found


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """The ranks of keys, from 1, equal ones for equal keys; and the number of different keys."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks, int(new.sum())


def _pair_ranks(first: np.ndarray, second: np.ndarray, below: int) -> tuple[np.ndarray, int]:
    """Ranks by the first key and then by the second one, which is less than ``below``."""
    return _ranks(first * below + second)


def star_order(text: np.ndarray, is_s: np.ndarray, cap: int) -> np.ndarray:
    """The S* suffixes in the order of their first ``cap`` symbols."""
    stars = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    if not len(stars):
        return stars
    stop = np.append(stars[1:] + 1, len(text) + 1)  # a substring ends with the symbol the next one starts with
    coded = np.concatenate((text.astype(np.int64) * 2 + is_s + 1, np.zeros(8, np.int64)))
    bits = int(coded.max()).bit_length()
    step = 62 // bits
    names, different = None, 0
    for first in range(0, min(int((stop - stars).max()), cap), step):
        key = np.zeros(len(stars), np.int64)
        for place in range(first, first + step):
            at = stars + place
            key = (key << bits) | np.where(at < stop, coded[np.minimum(at, len(text))], 0)
        ranks, count = _ranks(key)
        names, different = (ranks, count) if names is None else _pair_ranks(names, ranks, count + 1)
    reach = 1
    while different < len(stars) and 2 * reach < cap:
        behind = np.concatenate((names[reach:], np.zeros(min(reach, len(names)), np.int64)))[: len(names)]
        names, different = _pair_ranks(names, behind, different + 1)
        reach *= 2
    return stars[np.argsort(names, kind="stable")]


class _Scan:
    """One pass over suffixes in (falling) order, which puts the ones before them into the queues."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, symbols: int, cap: int, memory: int):
        self.text, self.wanted, self.cap = text, wanted, cap
        self.queues = Queues(symbols, memory)
        self.since = np.full(symbols, cap, np.uint8)  # least common prefix since the last push for a symbol
        self.started = np.zeros(symbols, bool)

    def over(self, places: np.ndarray, common: np.ndarray) -> None:
        """Scan suffixes; ``common`` is what each has in common with the one scanned before it."""
        from_ = np.flatnonzero(places > 0)
        from_ = from_[self.wanted[places[from_] - 1]]
        symbols = self.text[places[from_] - 1]
        order = np.argsort(symbols, kind="stable")
        from_, symbols = from_[order], symbols[order]
        head = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1]))) if len(symbols) else np.zeros(0, np.int64)
        own = symbols[head]
        table = _MinTable(common)
        before = np.concatenate(([-1], from_[:-1])) if len(from_) else from_
        before[head] = -1
        least = table.least(before + 1, from_ + 1)
        least[head] = np.minimum(least[head], self.since[own])
        shared = np.minimum(least.astype(np.int64) + 1, self.cap).astype(np.uint8)
        shared[head[~self.started[own]]] = 0
        self.started[own] = True
        self.since = np.minimum(self.since, table.all)
        ends = np.append(head[1:], len(symbols))
        if len(own):
            last = from_[ends - 1]
            self.since[own] = table.least(last + 1, np.full(len(last), len(common)), self.cap)
        new = places[from_] - 1
        for symbol, start, end in zip(own.tolist(), head.tolist(), ends.tolist()):
            self.queues.push(symbol, new[start:end], shared[start:end])


class _MinTable:
    """Least values of ranges, from the least of each range with a power of two as length."""

    def __init__(self, values: np.ndarray):
        rows, size = [values], 1
        while 2 * size <= len(values):
            rows.append(np.minimum(rows[-1][:-size], rows[-1][size:]))
            size *= 2
        self.all = values.min()
        self.flat = np.concatenate(rows)
        self.begin = np.cumsum([0, *map(len, rows[:-1])])  # where each length has its values

    def least(self, start: np.ndarray, stop: np.ndarray, empty: int = 255) -> np.ndarray:
        size = stop - start
        level = np.frexp(np.maximum(size, 1))[1] - 1
        full = size > 0
        first, last = np.where(full, start, 0), np.where(full, stop - (1 << level), 0)
        begin = self.begin[level]
        return np.where(full, np.minimum(self.flat[begin + first], self.flat[begin + last]), np.uint8(empty))


def suffix_order(text: np.ndarray, cap: int, memory: int = MEMORY) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in order, and what each has in common with the one before it, both up to ``cap`` (254 at most) symbols."""
    if not len(text):
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    used = np.flatnonzero(np.bincount(text))
    dense = np.zeros(int(used[-1]) + 1, np.uint16)
    dense[used] = np.arange(len(used))
    text, symbols = dense[text], len(used)
    is_s = rising(text)
    stars = star_order(text, is_s, cap)
    star_common = np.zeros(len(stars), np.uint8)
    star_common[1:] = common_prefix(text, stars[:-1], stars[1:], cap)
    star_from = np.searchsorted(text[stars], np.arange(symbols + 1))

    def joint(a: int, b: int) -> int:
        return int(common_prefix(text, np.array([a]), np.array([b]), cap)[0])

    # Falling suffixes (L), from the smallest symbol up; the end induces the last suffix.
    falling, scan = [], _Scan(text, ~is_s, symbols, cap, memory)
    scan.over(np.array([len(text)]), np.zeros(1, np.uint8))
    for symbol in range(symbols):
        parts = []
        while (part := scan.queues.pop(symbol)) is not None:
            parts.append(part)
            scan.over(*part)
        own = tuple(np.concatenate(arrays) for arrays in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.uint8))
        falling.append(own)
        start, stop = star_from[symbol], star_from[symbol + 1]
        if start < stop:
            common = star_common[start:stop].copy()
            common[0] = joint(own[0][-1], stars[start]) if len(own[0]) else 0
            scan.over(stars[start:stop], common)

    # Rising suffixes (S), from the largest symbol down.
    order, shared, scan = [], [], _Scan(text, is_s, symbols, cap, memory)
    for symbol in range(symbols - 1, -1, -1):
        parts = []
        while (part := scan.queues.pop(symbol)) is not None:
            parts.append(part)
            scan.over(*part)
        up, up_common = tuple(np.concatenate(arrays) for arrays in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.uint8))
        down, down_common = falling[symbol]
        between = joint(down[-1], up[-1]) if len(up) and len(down) else 0
        if len(down):
            scan.over(down[::-1], np.concatenate(([between], down_common[:0:-1])).astype(np.uint8))
        order += [up, down[::-1]]  # from the largest down, to be turned round at the end
        shared += [np.append(up_common[1:], between).astype(np.uint8) if len(up) else up_common, down_common[::-1]]
    return np.concatenate(order)[::-1], np.concatenate(shared)[::-1]
