"""Suffix order with common-prefix lengths by induced sorting.

The suffixes of a shard are split into descending (L) and ascending (S) ones.
The leftmost S suffixes (LMS) are sorted through their reduced string; from
them the L suffixes are induced in ascending and the S suffixes in descending
order. Induction goes through one queue per leading symbol, which hands out
its entries in the order of (symbol, arrival): a priority queue over suffix
tuples (symbol, rank of the suffix that induced it). An entry carries its
common prefix with the entry before it: one more than the least common prefix
among the inducing suffixes in between. Queues keep their entries on disk once
they hold more than a given number, and the sorted suffixes are handed out in
blocks as the queues are read, from the last to the first: order and common
prefixes are never held whole. What stays in memory is the text, a few small
numbers for each of its symbols, and the LMS suffixes.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

BIG = np.int32(1 << 30)
#: Entries handled at a time.
STEP = 1 << 16


class Queues:
    """Queues of (position, common prefix), one per symbol. Past ``in_memory``
    entries, what each queue holds goes as one block to an unnamed file of the
    task. With ``keep`` entries that were handed out can be read once more,
    backwards."""

    def __init__(self, symbols: int, in_memory: int, keep: bool):
        self.here: list[list] = [[] for _ in range(symbols)]
        self.there: list[list] = [[] for _ in range(symbols)]  # (place in the file, entries)
        self.next_here = [0] * symbols
        self.next_there = [(0, 0)] * symbols  # (block, entry in it)
        self.room, self.held, self.keep, self.file, self.end = in_memory, 0, keep, None, 0

    def push(self, symbol: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.here[symbol].append((pos, lcp))
        self.held += len(pos)
        if self.held > self.room:
            self.spill()

    def spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(self.end)
        for c, blocks in enumerate(self.here):
            if not blocks:
                continue
            pos, lcp = joined(blocks)
            handed = sum(len(b[0]) for b in blocks[: self.next_here[c]])
            if handed:  # then all before it in the file was handed out too
                self.next_there[c] = (len(self.there[c]), handed) if handed < len(pos) else (len(self.there[c]) + 1, 0)
            self.file.write(pos.astype(np.int64).tobytes())
            self.file.write(lcp.astype(np.int32).tobytes())
            self.there[c].append((self.end, len(pos)))
            self.end += 12 * len(pos)
            self.here[c], self.next_here[c] = [], 0
        self.held = 0

    def load(self, block: tuple[int, int], lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        at, n = block
        self.file.seek(at + 8 * lo)
        pos = np.frombuffer(self.file.read(8 * (hi - lo)), np.int64)
        self.file.seek(at + 8 * n + 4 * lo)
        return pos, np.frombuffer(self.file.read(4 * (hi - lo)), np.int32)

    def take(self, symbol: int, most: int) -> tuple[np.ndarray, np.ndarray] | None:
        """The next entries of a queue, about ``most``; None if it is empty."""
        k, at = self.next_there[symbol]
        if k < len(self.there[symbol]):
            block = self.there[symbol][k]
            to = min(at + most, block[1])
            self.next_there[symbol] = (k, to) if to < block[1] else (k + 1, 0)
            return self.load(block, at, to)
        blocks, i = self.here[symbol], self.next_here[symbol]
        if i == len(blocks):
            return None
        j, n = i, 0
        while j < len(blocks) and n < most:
            n += len(blocks[j][0])
            j += 1
        got = joined(blocks[i:j])
        if self.keep:
            blocks[i:j] = [got]
            self.next_here[symbol] = i + 1
        else:
            blocks[i:j] = []
            self.held -= n
        return got

    def backwards(self, symbol: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All entries of a queue, the last blocks first."""
        yield from reversed(self.here[symbol])
        for block in reversed(self.there[symbol]):
            for hi in range(block[1], 0, -most):
                yield self.load(block, max(0, hi - most), hi)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def joined(blocks: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    if len(blocks) == 1:
        return blocks[0]
    return np.concatenate([b[0] for b in blocks]), np.concatenate([b[1] for b in blocks])


def ascending(t: np.ndarray) -> np.ndarray:
    """S types; the text ends with its smallest symbol, which is S."""
    n = len(t)
    step = np.sign(np.diff(t.astype(np.int32)))
    at = np.where(step != 0, np.arange(n - 1), n - 1)
    following = np.minimum.accumulate(at[::-1])[::-1]
    out = np.ones(n, bool)
    known = following < n - 1
    out[:-1][known] = step[following[known]] > 0
    return out


def prefixes(t: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of the suffixes at ``a`` and ``b``, up to ``most``."""
    n, out = len(t), np.zeros(len(a), np.int32)
    live = np.arange(len(a))
    for k in range(most):
        x, y = a[live] + k, b[live] + k
        fits = (x < n) & (y < n)
        same = np.zeros(len(live), bool)
        same[fits] = t[x[fits]] == t[y[fits]]
        live = live[same]
        if not len(live):
            break
        out[live] += 1
    return out


def descending(t: np.ndarray, s: np.ndarray, seeds: np.ndarray, lcp: np.ndarray, symbols: int, most: int, in_memory: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes from the last to the first, in blocks, each with its common
    prefix with the one handed out before it, from the LMS suffixes (``seeds``
    in order, ``lcp`` with the one before)."""
    bounds = np.searchsorted(t[seeds], np.arange(symbols + 1))
    left, right = Queues(symbols, in_memory, True), Queues(symbols, in_memory, False)

    def spread(pos: np.ndarray, com: np.ndarray, queues: Queues, want: bool, since: np.ndarray) -> None:
        """Hand a block's predecessors of the wanted type to their queues."""
        prev = pos - 1
        symbol = np.where((prev >= 0) & (s[prev] == want), t[prev], -1)
        now = np.minimum(since, com.min())
        for d in np.flatnonzero(np.bincount(symbol + 1, minlength=1)[1:]):
            at = np.flatnonzero(symbol == d)
            starts = np.concatenate(([0], at[:-1] + 1))
            gap = np.minimum.reduceat(com[: at[-1] + 1], starts)
            gap[0] = min(gap[0], since[d])
            queues.push(d, prev[at], np.minimum(gap + 1, most).astype(np.int32))
            rest = com[at[-1] + 1 :]
            now[d] = rest.min() if len(rest) else BIG
        since[:] = now

    def after(last: int | None, pos: int) -> int:
        """Common prefix with the suffix before, if they share their first symbol."""
        return 0 if last is None else int(prefixes(t, np.array([last]), np.array([pos]), most)[0])

    def drain(queues: Queues, c: int, want: bool, since: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Queue ``c`` to its end, with what its entries add to it."""
        first = True
        while (got := queues.take(c, STEP)) is not None:
            pos, com = got
            if first:
                com, first = com.copy(), False
                com[0] = 0  # before it stands another symbol
            spread(pos, com, queues, want, since)
            yield pos, com

    since = np.zeros(symbols, np.int32)
    for c in range(symbols):
        last = None
        for pos, _ in drain(left, c, False, since):
            last = pos[-1]
        for a in range(bounds[c], bounds[c + 1], STEP):
            b = min(a + STEP, bounds[c + 1])
            com = lcp[a:b].copy()
            if a == bounds[c]:
                com[0] = after(last, seeds[a])
            spread(seeds[a:b], com, left, False, since)
    since = np.zeros(symbols, np.int32)
    for c in range(symbols - 1, -1, -1):
        last = None
        for pos, com in drain(right, c, True, since):
            last = pos[-1]
            yield pos, com
        if c == t[-1]:  # the last suffix has none after it; it is the smallest
            yield np.array([len(t) - 1]), np.array([after(last, len(t) - 1)], np.int32)
            last = len(t) - 1
        between = None  # common prefix of the block's last suffix with the next block's first
        for low, low_com in left.backwards(c, STEP):
            head = after(last, low[-1]) if between is None else between
            back, back_com = low[::-1], np.concatenate(([head], low_com[:0:-1])).astype(np.int32)
            between = low_com[0]
            spread(back, back_com, right, True, since)
            yield back, back_com
    left.close()
    right.close()


def sorted_lms(t: np.ndarray, s: np.ndarray, symbols: int, depth: int, in_memory: int) -> np.ndarray:
    """LMS positions by their suffixes, up to ``depth`` symbols: the LMS
    substrings are sorted by induction and named, and the string of names is
    sorted in turn (by doubling, as its alphabet is large)."""
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    if len(lms) < 2:
        return lms
    rough = lms[np.argsort(t[lms], kind="stable")]
    is_lms = np.zeros(len(t), bool)
    is_lms[lms] = True
    order = [pos[is_lms[pos]] for pos, _ in descending(t, s, rough, np.zeros(len(rough), np.int32), symbols, 1, in_memory)]
    order = np.concatenate(order)[::-1]
    span = np.zeros(len(t), np.int32)
    span[lms] = np.append(np.diff(lms), 0) + 1
    a, b = order[:-1], order[1:]
    size = span[a]
    same = size == span[b]
    live = np.flatnonzero(same)
    k = 0
    while len(live):
        differ = t[a[live] + k] != t[b[live] + k]
        same[live[differ]] = False
        live = live[~differ]
        k += 1
        live = live[size[live] > k]
    names = np.zeros(len(t), np.int32)
    names[order] = np.concatenate(([0], np.cumsum(~same)))
    rank = names[lms].astype(np.int64)
    ahead, count = 1, int(rank.max()) + 1
    while count < len(lms) and ahead < depth:
        after = np.zeros(len(lms), np.int64)
        after[:-ahead] = rank[ahead:] + 1
        key = rank * (count + 1) + after
        by = np.argsort(key, kind="stable")
        ranks = np.concatenate(([0], np.cumsum(np.diff(key[by]) != 0)))
        rank = np.empty_like(rank)
        rank[by] = ranks
        count = int(ranks[-1]) + 1
        ahead *= 2
        if ahead >= len(lms):
            break
    return lms[np.argsort(rank, kind="stable")]


def suffixes_descending(t: np.ndarray, symbols: int, depth: int, in_memory: int = 1 << 26) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The suffixes of ``t`` from the last to the first, in blocks, with their
    common prefixes with the one before in this direction, both right up to
    ``depth`` symbols (larger common prefixes are given as ``depth``). ``t``
    ends with 0, which stands nowhere else."""
    t = np.asarray(t, np.int16 if symbols < 1 << 15 else np.int32)
    s = ascending(t)
    lms = sorted_lms(t, s, symbols, depth, in_memory)
    com = np.zeros(len(lms), np.int32)
    if len(lms) > 1:
        com[1:] = prefixes(t, lms[:-1], lms[1:], depth)
    yield from descending(t, s, lms, com, symbols, depth, in_memory)


def suffix_order(t: np.ndarray, symbols: int, depth: int, in_memory: int = 1 << 26) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes of ``t``, ascending, and their common prefixes
    with the one before; for texts whose order fits in memory."""
    order, com = (np.concatenate(x)[::-1] for x in zip(*suffixes_descending(t, symbols, depth, in_memory)))
    return order, np.concatenate(([0], com[:-1])).astype(np.int32)
