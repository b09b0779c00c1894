"""External induced sorting of suffixes with common-prefix values.

One queue for each first byte takes suffix tuples (position, common prefix with the tuple
pushed before) in sorted order: together the queues are a priority queue whose key is the
first byte. Scanning the queues upwards induces the suffixes that are larger than their
successor, scanning them downwards the smaller ones; each scanned suffix pushes its
predecessor, and the pushed common prefix is one more than the least over the tuples scanned
between two pushes to the same queue. Queues beyond a memory budget write their tuples to
an unnamed spill file of the task (nothing outlives the task or has to be found again) and
read them back in order.

The seeds (leftmost smaller suffixes) are ordered by rounds over eight bytes at a time, each
round on the ties of the last; DEPTH bytes suffice because only common prefixes up to
DEPTH - 8 are asked for, which bounds the recursion on seeds to that many rounds.
"""

from __future__ import annotations

import tempfile

import numpy as np

#: Bytes up to which order and common prefixes are exact.
DEPTH = 58
#: Bytes of queued tuples kept in memory before they spill.
MEMORY = 256 << 20


class TupleQueue:
    """First-in first-out tuples of (position, common prefix), spilling to disk."""

    used = 0  # bytes in memory over all queues of this process

    def __init__(self, budget: int):
        self.parts: list = []
        self.budget, self.file = budget, None

    def push(self, at: np.ndarray, lcp: np.ndarray) -> None:
        if not len(at):
            return
        size = at.nbytes + lcp.nbytes
        if TupleQueue.used + size > self.budget:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.seek(0, 2)
            place = self.file.tell()
            self.file.write(at.tobytes() + lcp.tobytes())
            self.parts.append((place, len(at)))
        else:
            TupleQueue.used += size
            self.parts.append((at, lcp))

    def drain(self) -> tuple[np.ndarray, np.ndarray]:
        """All waiting tuples, which leave the queue."""
        out, self.parts = self.parts, []
        got = []
        for a, b in out:
            if isinstance(a, int):
                self.file.seek(a)
                got.append((np.frombuffer(self.file.read(8 * b), np.int64), np.frombuffer(self.file.read(b), np.uint8)))
            else:
                TupleQueue.used -= a.nbytes + b.nbytes
                got.append((a, b))
        if not got:
            return np.zeros(0, np.int64), np.zeros(0, np.uint8)
        return np.concatenate([a for a, _ in got]), np.concatenate([b for _, b in got])


def _words(text: np.ndarray) -> np.ndarray:
    """Eight bytes from every position, as big-endian numbers (zeros after the end)."""
    padded = np.concatenate([text, np.zeros(DEPTH + 16, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text) + DEPTH + 8, np.uint64)
    for k in range(8):
        out = out << np.uint64(8) | padded[k : k + len(out)]
    return out


def common_prefix(words: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common prefix lengths of suffix pairs, some bytes over DEPTH at most."""
    n, going = np.zeros(len(a), np.int64), np.arange(len(a))
    for k in range(0, DEPTH, 8):
        x = words[a[going] + k] ^ words[b[going] + k]
        equal = x == 0
        rest = x[~equal]
        bits = np.zeros(len(rest), np.int64)
        for s in (32, 16, 8):
            high = rest >> np.uint64(64 - s)
            zero = high == 0
            bits += np.where(zero, s, 0)
            rest = np.where(zero, rest << np.uint64(s), rest)
        n[going[equal]] += 8
        n[going[~equal]] += bits // 8
        going = going[equal]
    return n.astype(np.uint8)


def _sorted_seeds(words: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Seeds by their first DEPTH bytes: eight bytes first, then five at a time together with the
    number of the group that is still tied."""
    key = words[seeds]
    order = np.argsort(key)
    seeds, key = seeds[order], key[order]
    begins = np.concatenate([[True], key[1:] != key[:-1]]) if len(seeds) else np.zeros(0, bool)
    tied, depth = np.arange(len(seeds)), 8
    while depth < DEPTH:
        alone = begins & np.concatenate([begins[1:], [True]])
        tied, begins = tied[~alone], begins[~alone]
        if not len(tied):
            break
        group = np.cumsum(begins) - 1
        own = seeds[tied]
        if group[-1] < 1 << 24:
            key = group.astype(np.uint64) << np.uint64(40) | words[own + depth] >> np.uint64(24)
            order = np.argsort(key)
            key = key[order]
            begins = np.concatenate([[True], key[1:] != key[:-1]])
            depth += 5
        else:
            key = words[own + depth]
            order = np.lexsort((key, group))
            key, group = key[order], group[order]
            begins = np.concatenate([[True], (key[1:] != key[:-1]) | (group[1:] != group[:-1])])
            depth += 8
        seeds[tied] = own[order]
    return seeds


def _range_least(values: np.ndarray):
    """Least of values[a:b] for arrays of a < b."""
    levels = [values]
    while (1 << len(levels)) <= len(values):
        last, half = levels[-1], 1 << (len(levels) - 1)
        levels.append(np.minimum(last[: len(last) - half], last[half:]))
    size = len(values)
    flat = np.concatenate([np.pad(x, (0, size - len(x))) for x in levels])

    def least(a, b):
        k = (np.frexp((b - a).astype(np.float64))[1] - 1).astype(np.int64)
        return np.minimum(flat[k * size + a], flat[k * size + b - (1 << k)])

    return least


class _Scan:
    """One direction of induction."""

    def __init__(self, text, kind, budget):
        self.text, self.kind = text, kind
        self.queues = [TupleQueue(budget) for _ in range(256)]
        self.least = np.full(256, 0, np.uint8)  # common prefix of the last push with what is scanned now
        self.pushed = np.zeros(256, bool)

    def scan(self, at: np.ndarray, lcp: np.ndarray) -> None:
        """Push the predecessors of the scanned tuples to their queues."""
        if not len(at):
            return
        before = at - 1
        ok = np.flatnonzero((at > 0) & self.kind[np.maximum(before, 0)])
        least = _range_least(lcp)
        byte = self.text[before[ok]]
        order = np.argsort(byte, kind="stable")
        ok, byte = ok[order], byte[order]
        cuts = np.flatnonzero(np.concatenate([[True], byte[1:] != byte[:-1]])) if len(ok) else np.zeros(0, np.int64)
        begin = np.concatenate([[0], ok[:-1] + 1]) if len(ok) else ok
        if len(ok):
            begin[cuts] = 0
            new = least(begin, ok + 1).astype(np.int64)
            new[cuts] = np.where(self.pushed[byte[cuts]], np.minimum(new[cuts], self.least[byte[cuts]]), -1)
            new = np.minimum(new + 1, 255).astype(np.uint8)
        self.least = np.minimum(self.least, lcp.min())
        for a, b in zip(cuts, [*cuts[1:], len(ok)]):
            c = int(byte[a])
            self.queues[c].push(before[ok[a:b]], new[a:b])
            self.pushed[c] = True
            last = ok[b - 1] + 1
            self.least[c] = least(np.array([last]), np.array([len(lcp)]))[0] if last < len(lcp) else 255


def suffix_array(text: np.ndarray, budget: int = MEMORY) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of a byte array that ends with 0, in order of their first DEPTH bytes, and each one's
    common prefix with the one before (exact up to DEPTH - 8, at least that beyond)."""
    n = len(text)
    assert n and text[-1] == 0
    words = _words(text)
    up = np.zeros(n, np.int8)
    up[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    up[-1] = 1
    known = np.where(up != 0, np.arange(n), n)
    small = up[np.minimum.accumulate(known[::-1])[::-1]] > 0  # smaller than its successor
    seeds = np.flatnonzero(small & np.concatenate([[False], ~small[:-1]]))
    seeds = _sorted_seeds(words, seeds)
    seed_lcp = np.zeros(len(seeds), np.uint8)
    seed_lcp[1:] = common_prefix(words, seeds[:-1], seeds[1:])
    bounds = np.searchsorted(text[seeds], np.arange(257))

    larger: list = [None] * 256
    upward = _Scan(text, ~small, budget)
    for c in range(256):
        parts = []
        while upward.queues[c].parts:
            at, lcp = upward.queues[c].drain()
            parts.append((at, lcp))
            upward.scan(at, lcp)
        if parts:
            larger[c] = tuple(np.concatenate(x) for x in zip(*parts))
        at, lcp = seeds[bounds[c] : bounds[c + 1]], seed_lcp[bounds[c] : bounds[c + 1]].copy()
        if len(at):
            lcp[0] = common_prefix(words, larger[c][0][-1:], at[:1])[0] if parts else 0
            upward.scan(at, lcp)
        upward.least[:] = 0  # the next queue starts with another byte

    smaller: list = [None] * 256
    downward = _Scan(text, small, budget)
    last = np.array([n - 1])
    for c in range(255, -1, -1):
        parts = []
        while downward.queues[c].parts:
            at, lcp = downward.queues[c].drain()
            parts.append((at, lcp))
            if c:
                downward.scan(at, lcp)
        if c == 0:  # the last end mark has no successor that could induce it
            parts.append((last, common_prefix(words, parts[-1][0][-1:], last) if parts else np.zeros(1, np.uint8)))
        if parts:
            smaller[c] = tuple(np.concatenate(x) for x in zip(*parts))
        if larger[c] is not None:
            at, lcp = larger[c]
            turned = np.concatenate([[0], lcp[:0:-1]]).astype(np.uint8)
            if parts:
                turned[0] = common_prefix(words, smaller[c][0][-1:], at[-1:])[0]
            downward.scan(at[::-1], turned)
        downward.least[:] = 0
    sa, out = [], []
    for c in range(256):
        tail = None
        if larger[c] is not None:
            at, lcp = larger[c]
            lcp = lcp.copy()
            lcp[0] = 0
            sa.append(at), out.append(lcp)
            tail = at[-1:]
        if smaller[c] is not None:
            at, lcp = smaller[c][0][::-1], np.concatenate([[0], smaller[c][1][:0:-1]]).astype(np.uint8)
            if tail is not None:
                lcp[0] = common_prefix(words, tail, at[:1])[0]
            sa.append(at), out.append(lcp)
    return np.concatenate(sa), np.concatenate(out)

