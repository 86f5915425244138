"""External induced sorting of suffixes, with common-prefix values.

Suffixes are classified as falling (L) or rising (S); the leftmost rising ones (LMS) are ranked first, and all others are induced
from them in one pass upwards and one downwards. The pending suffixes of a pass stand in a priority queue ordered by (first
character, arrival); characters are served in order and the arrivals of a character at once, as arrays. Every
entry is a tuple (position, common prefix with the entry before it): the prefix of two induced suffixes is one more than the
smallest prefix between their sources. The queue keeps a bounded number of entries in memory and the rest in a file.

LMS suffixes are ranked by recursion: their substrings are sorted by the same induction, named, and the shorter string of
names is ranked; as only the first `cap` characters of a suffix count here, the names' tuples are doubled until they
differ or cover the cap.
"""

from __future__ import annotations

import contextlib
import os
import tempfile

import numpy as np

MEMORY_ENTRIES = 4_000_000
_BIG = np.uint8(255)


class DiskQueue:
    """Priority queue of (position, prefix) by (character, arrival); beyond `memory` entries, entries go to a file."""

    def __init__(self, sigma: int, memory: int = MEMORY_ENTRIES) -> None:
        self.cells: list[list] = [[] for _ in range(sigma)]
        self.memory, self.held, self.file, self.end = memory, 0, None, 0

    def push(self, c: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.cells[c].append((pos, lcp))
        self.held += len(pos)
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            # scratch of this task only, in the folder that Spark gives its executors for spills
            self.file = tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)
        self.file.seek(self.end)
        for cell in self.cells:
            for k, (pos, lcp) in enumerate(cell):
                if isinstance(pos, int):
                    continue
                self.file.write(pos.astype(np.int64).tobytes())
                self.file.write(lcp.tobytes())
                cell[k] = (self.end, len(pos))
                self.end += 9 * len(pos)
        self.held = 0

    def pop(self, c: int) -> tuple[np.ndarray, np.ndarray] | None:
        """All entries of a character that have arrived, in order."""
        cell, self.cells[c] = self.cells[c], []
        if not cell:
            return None
        out = []
        for pos, lcp in cell:
            if isinstance(pos, int):
                self.file.seek(pos)
                raw = self.file.read(9 * lcp)
                pos, lcp = np.frombuffer(raw[: 8 * lcp], np.int64), np.frombuffer(raw[8 * lcp :], np.uint8)
            else:
                self.held -= len(pos)
            out.append((pos, lcp))
        return np.concatenate([p for p, _ in out]), np.concatenate([x for _, x in out])

    def close(self) -> None:
        if self.file is not None:
            with contextlib.suppress(OSError):
                self.file.close()
            self.file = None


def _range_min(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of a[lo..hi], both inclusive, by doubling."""
    width = hi - lo + 1
    level = np.frexp(width.astype(float))[1] - 1
    out = np.empty(len(lo), a.dtype)
    table, k = a, 0
    for k in range(int(level.max()) + 1 if len(level) else 0):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:])
        hit = level == k
        if hit.any():
            out[hit] = np.minimum(table[lo[hit]], table[hi[hit] - (1 << k) + 1])
    return out


def common_prefix(t: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of the suffixes at a and b, at most cap. t is padded by 8 bytes beyond cap."""
    words = np.ndarray((len(t) - 7,), "<u8", buffer=np.ascontiguousarray(t).data, strides=(1,))
    out = np.full(len(a), cap, np.int64)
    live = np.arange(len(a))
    for k in range(0, cap, 8):
        i, j = np.minimum(a[live] + k, len(words) - 1), np.minimum(b[live] + k, len(words) - 1)
        x = words[i] ^ words[j]
        diff = x != 0
        if diff.any():
            y = x[diff]
            low = (y & (~y + np.uint64(1))).astype(np.float64)
            out[live[diff]] = np.minimum(cap, k + (np.frexp(low)[1] - 1) // 8)
            live = live[~diff]
        if not len(live):
            break
    return out


class _Pass:
    """What has been scanned since the last source of each character."""

    def __init__(self, t, rising, want: bool, queue: DiskQueue, cap: int) -> None:
        self.t, self.rising, self.want, self.queue, self.cap = t, rising, want, queue, cap
        self.least = np.full(256, _BIG, np.uint8)

    def scan(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        """Induces the suffixes before `pos`, which stand in scan order with their prefixes to the one scanned before."""
        before = pos - 1
        at = np.flatnonzero((pos > 0) & (self.rising[before] == self.want))
        whole = lcp.min()
        if not len(at):
            np.minimum(self.least, whole, out=self.least)
            return
        c = self.t[before[at]]
        order = np.argsort(c, kind="stable")
        at, c = at[order], c[order]
        new = np.concatenate([[True], c[1:] != c[:-1]])
        lo = np.where(new, 0, np.concatenate([[0], at[:-1] + 1]))
        least = _range_min(lcp, lo, at)
        least[new] = np.minimum(least[new], self.least[c[new]])
        got = np.minimum(self.cap, least.astype(np.int64) + 1).astype(np.uint8)
        np.minimum(self.least, whole, out=self.least)
        starts = np.flatnonzero(new)
        ends = np.concatenate([starts[1:], [len(at)]])
        rest = np.concatenate([np.minimum.accumulate(lcp[::-1])[::-1], [_BIG]])
        self.least[c[starts]] = rest[at[ends - 1] + 1]
        src = before[at]
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            self.queue.push(int(c[a]), src[a:b], got[a:b])


def _induce(t, rising, runs, lms, lms_lcp, cap, memory):
    """All suffixes in order with prefixes to the one before, from sorted LMS suffixes with theirs."""
    sigma = int(t.max()) + 1
    edges = np.searchsorted(t[lms], np.arange(sigma + 1))
    up = DiskQueue(sigma, memory)
    step = _Pass(t, rising, False, up, cap)
    falling: list[list] = [[] for _ in range(sigma)]
    seam = lambda a, b: np.uint8(min(cap, runs[a], runs[b]))  # noqa: E731  c..c then less, against c..c then more
    for c in range(sigma):
        last = -1
        while (got := up.pop(c)) is not None:
            pos, lcp = got
            if last < 0:
                lcp = lcp.copy()
                lcp[0] = 0
            falling[c].append((pos, lcp))
            step.scan(pos, lcp)
            last = int(pos[-1])
        a, b = int(edges[c]), int(edges[c + 1])
        if b > a:
            lcp = lms_lcp[a:b].copy()
            lcp[0] = 0 if last < 0 else seam(last, lms[a])
            step.scan(lms[a:b], lcp)
    up.close()
    down = DiskQueue(sigma, memory)
    step = _Pass(t, rising, True, down, cap)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for c in range(sigma - 1, -1, -1):
        last, high = -1, []
        while (got := down.pop(c)) is not None:
            pos, lcp = got
            if last < 0:
                lcp = lcp.copy()
                lcp[0] = 0
            high.append((pos, lcp))
            step.scan(pos, lcp)
            last = int(pos[-1])
        if high:
            pos, lcp = (np.concatenate(x) for x in zip(*high, strict=True))
            asc = np.concatenate([lcp[1:][::-1], [0]]) if len(lcp) > 1 else np.zeros(1)
            # ascending: the prefix to the smaller neighbour is what the smaller one had to the larger
            s_pos, s_lcp = pos[::-1], np.concatenate([[0], asc[:-1]]).astype(np.uint8)
        if falling[c]:
            pos, lcp = (np.concatenate(x) for x in zip(*falling[c], strict=True))
            desc = np.concatenate([[0], lcp[1:][::-1]]).astype(np.uint8)
            if last >= 0:
                desc[0] = s_lcp[0] = seam(int(pos[-1]), last)
            step.scan(pos[::-1], desc)
        if high:
            out.append((s_pos, s_lcp))
        if falling[c]:
            out.append((pos, lcp))
    down.close()
    pos, lcp = (np.concatenate(x[::-1]) for x in zip(*out, strict=True))
    return pos, lcp


def suffixes(text: np.ndarray, cap: int, memory: int = MEMORY_ENTRIES) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of a byte string (values 1..255) in the order of their first `cap` characters, and each one's
    common prefix with the one before, at most cap (cap <= 200)."""
    n = len(text) + 1
    t = np.zeros(n + cap + 72, np.uint8)
    t[: n - 1] = text
    body = t[:n]
    fall = np.sign(body[:-1].astype(np.int16) - body[1:])
    nz = np.flatnonzero(fall)
    nxt = nz[np.minimum(np.searchsorted(nz, np.arange(n - 1)), len(nz) - 1)] if len(nz) else np.zeros(0, int)
    rising = np.ones(n, bool)
    rising[: n - 1] = fall[nxt] < 0
    runs = np.ones(n, np.int64)
    runs[: n - 1] = np.where(fall == 0, nxt - np.arange(n - 1) + 1, 1)
    lms = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    zero = np.zeros(len(lms), np.uint8)
    # sort the substrings between LMS positions by induction from unsorted ones
    first = lms[np.argsort(body[lms], kind="stable")]
    order, _ = _induce(body, rising, runs, first, zero, cap, memory)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    by = np.concatenate([[n - 1], order[is_lms[order]]])
    place = np.zeros(n, np.int64)
    place[lms] = np.arange(len(lms))
    length = np.append(np.diff(lms) + 1, 1)
    size = length[place[by]]
    same = (size[1:] == size[:-1]) & (common_prefix(t, by[1:], by[:-1], cap + 64) >= np.minimum(size[1:], cap + 64))
    name = np.zeros(len(lms), np.int64)
    name[place[by]] = np.concatenate([[0], np.cumsum(~same)])
    # rank the string of names by doubled tuples
    step = 1
    while name.max() + 1 < len(name) and step < cap:
        pair = name * (name.max() + 2)
        pair[: len(name) - step] += name[step:] + 1
        name = np.unique(pair, return_inverse=True)[1]
        step *= 2
    ranked = lms[np.argsort(name, kind="stable")]
    lcp = np.zeros(len(ranked), np.uint8)
    lcp[1:] = common_prefix(t, ranked[1:], ranked[:-1], cap)
    order, lcp = _induce(body, rising, runs, ranked, lcp, cap, memory)
    return order, lcp


