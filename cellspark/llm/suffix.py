"""Enhanced suffix arrays in NumPy: suffix ranks by prefix doubling, common prefixes, and the interval tree on them."""

from __future__ import annotations

from functools import cmp_to_key

import numpy as np

from .common import Rolling


class SuffixArray:
    """Suffix array of an integer sequence with the longest common prefixes of neighbours.

    key: int64 symbols.  Symbols must differ between texts (or a unique separator must end each), so that no common
    prefix reaches across a text's end.  Doubling sorts again only those suffixes whose rank is still shared, so the work
    beyond the first sort follows the repeated part.  depth: compare no more than about so many symbols (None: all).
    A symbol may pack `step` smaller ones at its place and the next; end[i] is then where the text that holds i ends, and
    equal suffixes may keep equal ranks.
    """

    def __init__(self, key: np.ndarray, depth: int | None = None, step: int = 1, end: np.ndarray | None = None):
        n = len(key)
        self.n, self.steps, self.levels, self.end = n, [], [], np.full(n, n) if end is None else end
        self.sa = np.argsort(key, kind="stable").astype(np.int64)
        s = key[self.sa]
        head = np.ones(n, bool)
        head[1:] = s[1:] != s[:-1]
        slot = np.maximum.accumulate(np.where(head, np.arange(n), 0)) if n else np.zeros(0, np.int64)
        rank = np.empty(n, np.int64)
        rank[self.sa] = slot  # of the first suffix with the same prefix
        small = np.int32 if n < 2**31 else np.int64
        h = step
        self.steps.append(h)
        self.levels.append(rank.astype(small))
        while n:
            shared = ~head
            shared[:-1] |= ~head[1:]
            slots = np.flatnonzero(shared)
            if not len(slots) or (depth is not None and h >= depth):
                break
            pos = self.sa[slots]
            nxt = pos + h
            inside = nxt < self.end[pos]
            second = np.where(inside, rank[np.where(inside, nxt, 0)] + 1, 0)
            first = rank[pos]
            order = np.lexsort((second, first))
            pos, first, second = pos[order], first[order], second[order]
            self.sa[slots] = pos
            new = np.ones(len(pos), bool)
            new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
            head[slots] = new
            rank = rank.copy()
            rank[pos] = np.maximum.accumulate(np.where(new, slots, 0))
            h *= 2
            self.steps.append(h)
            self.levels.append(rank.astype(small))

    def lcp(self) -> np.ndarray:
        """lcp[i]: common prefix of the suffixes sa[i - 1] and sa[i] in whole steps; lcp[0] = 0.  Exact below twice the last step."""
        out = np.zeros(self.n, np.int64)
        if self.n < 2:
            return out
        a, b = self.sa[:-1], self.sa[1:]
        at = np.flatnonzero(self.levels[0][a] == self.levels[0][b])
        a, b = a[at], b[at]
        got = np.zeros(len(at), np.int64)
        for h, rank in zip(reversed(self.steps), reversed(self.levels)):
            for _ in range(2 if h == self.steps[-1] else 1):
                x, y = a + got, b + got
                same = (x < self.end[a]) & (y < self.end[b])
                same[same] = rank[x[same]] == rank[y[same]]
                got += h * same
        out[at + 1] = np.minimum(got, np.minimum(self.end[a] - a, self.end[b] - b))
        return out


def climb(lcp: list[int], place: list[int], change: list[int], least: int, groups: bool) -> tuple[list[int], list[tuple[int, int, int]]]:
    """Stack scan of the common-prefix interval tree over sorted suffixes (lcp[i]: of i - 1 and i; below `least` there is no interval).

    -> for each suffix the length of the longest string that it shares with an earlier place, or 0; and, if asked for, every
    maximal repeat as (length, left, right), children before parents.  An interval is right-maximal by construction; it is
    left-maximal if its occurrences do not all follow the same symbol: `change` counts the changes of that symbol along the
    suffixes.  Each interval knows its earliest place; where two meet in their parent the later one loses, so every suffix
    loses once, and the work is linear however deep the tree is.
    """
    n = len(lcp)
    lost, out = [0] * n, []
    stack: list[list[int]] = []  # length, left, earliest
    for i in range(1, n + 1):
        v = lcp[i] if i < n else 0
        left = best = i - 1
        while stack and stack[-1][0] > v:
            size, left, other = stack.pop()
            if place[other] < place[best]:
                best, other = other, best
            lost[other] = size
            if groups and change[i - 1] != change[left]:
                out.append((size, left, i - 1))
        if v < least:
            continue
        if stack and stack[-1][0] == v:
            other = stack[-1][2]
            if place[other] < place[best]:
                best, other = other, best
            lost[other] = v
            stack[-1][2] = best
        else:
            stack.append([v, left, best])
    return lost, out


class SparseSuffixes:
    """Enhanced suffix array of those suffixes of byte strings that can begin a maximal repeat of at least `least` bytes.

    Suffixes with equal first `least` bytes make a block.  Where all of a block follow the same byte, every repeat that
    begins there begins earlier too, so the block is passed over; the others are sorted and their interval trees climbed.
    A smaller place in the strings, laid end to end, is an earlier one.  Blocks are found by hash and compared by bytes.
    own: of each string only the suffixes that begin in its first own bytes, and have `least` bytes there, are taken; what
    follows only tells how far they agree.  fronts: the byte that stands before each string, or -1.
    later(): for each suffix that shares `least` bytes or more with an earlier one, the longest such string.
    repeats: (length, places) of every maximal repeat, if groups are asked for.
    """

    SHORT = 512  # bytes that a block is sorted by first

    def __init__(self, texts: list[bytes], least: int, groups: bool = False, window: int = 1 << 20, most: int = 8 << 20, own: list[int] | None = None, fronts: list[int] | None = None):
        self.least, self.groups, self.window = least, groups, window
        self.data = b"".join(texts)
        size = np.array([len(t) for t in texts], np.int64)
        self.stop = np.cumsum(size)
        self.begin = self.stop - size
        self.last = self.begin + (size if own is None else np.array(own, np.int64)) - least  # the last suffix taken
        self.fronts = np.full(len(texts), -1) if fronts is None else np.array(fronts, np.int64)
        self.repeats: list[tuple[int, list[int]]] = []
        self._at: list[int] = []
        self._n: list[int] = []
        passes = -(-len(self.data) // most)
        for k in range(passes):  # blocks by a share of their hashes, so that memory is bounded
            self._blocks(k, passes)

    def _blocks(self, k: int, passes: int) -> None:
        data, powers = np.frombuffer(self.data, np.uint8), {}
        hashes, places = [], []
        for lo in range(0, len(data), self.window):
            at = np.arange(lo, min(lo + self.window, len(data)))
            at = at[at <= self.last[np.searchsorted(self.begin, at, "right") - 1]]
            if len(at):
                h = Rolling(data[lo : int(at[-1]) + self.least], 0xC2B2AE3D27D4EB4F, powers).of(at - lo, at - lo + self.least)
                if passes > 1:
                    mine = h % np.uint64(passes) == k
                    h, at = h[mine], at[mine]
                hashes.append(h)
                places.append(at)
        if not hashes:
            return
        h, at = np.concatenate(hashes), np.concatenate(places)
        order = np.argsort(h, kind="stable")  # places of a block ascend
        h, at = h[order], at[order]
        same = h[1:] == h[:-1]
        two = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        h, at = h[two], at[two]
        if not len(h):
            return
        head = np.concatenate([[True], h[1:] != h[:-1]])
        first = np.flatnonzero(head)
        block = np.cumsum(head) - 1
        run = np.searchsorted(self.begin, at, "right") - 1
        front = np.where(self.begin[run] != at, data[at - 1], np.where(self.fronts[run] < 0, -1 - run, self.fronts[run]))  # where nothing stands before, differs from all
        diverse = np.logical_or.reduceat(front != front[first][block], first)
        go = diverse[block]
        size = np.diff(np.append(first, len(at)))[diverse].tolist()
        at, end, front = at[go].tolist(), self.stop[run[go]].tolist(), front[go].tolist()
        i = 0
        for n in size:
            self._block(at[i : i + n], end[i : i + n], front[i : i + n])
            i += n

    def _common(self, x: int, y: int, most: int) -> int:
        """Bytes that the suffixes at x and y share, `most` at most: longer and longer pieces are compared, then halves."""
        data, n, step = self.data, 0, 128
        while n < most:
            size = min(step, most - n)
            if data[x + n : x + n + size] == data[y + n : y + n + size]:
                n += size
                step *= 2
                continue
            while size > 1:
                half = size // 2
                if data[x + n : x + n + half] == data[y + n : y + n + half]:
                    n += half
                    size -= half
                else:
                    size = half
            return n
        return most

    def _block(self, at: list[int], end: list[int], front: list[int]) -> None:
        if len(at) == 2:
            n = self._common(at[0], at[1], min(end[0] - at[0], end[1] - at[1]))
            if n >= self.least:
                self._at.append(at[1])
                self._n.append(n)
                if self.groups:
                    self.repeats.append((n, at))
            return
        data, short, common = self.data, self.SHORT, self._common
        keys = [data[p : min(p + short, e)] for p, e in zip(at, end)]
        order = sorted(range(len(at)), key=keys.__getitem__)

        def compare(i: int, j: int) -> int:
            m = min(end[i] - at[i], end[j] - at[j])
            n = common(at[i], at[j], m)
            return (end[i] - at[i]) - (end[j] - at[j]) if n == m else data[at[i] + n] - data[at[j] + n]

        lo = 0
        for hi in range(1, len(order) + 1):  # those that are equal so far, by all their bytes
            if hi == len(order) or keys[order[hi]] != keys[order[lo]]:
                if hi - lo > 1 and len(keys[order[lo]]) == short:
                    order[lo:hi] = sorted(order[lo:hi], key=cmp_to_key(compare))
                lo = hi
        lcp = [0] + [common(at[i], at[j], min(end[i] - at[i], end[j] - at[j])) for i, j in zip(order, order[1:])]
        change = [0]
        for i, j in zip(order, order[1:]):
            change.append(change[-1] + (front[i] != front[j]))
        places = [at[i] for i in order]
        lost, found = climb(lcp, places, change, self.least, self.groups)
        for p, n in zip(places, lost):
            if n:
                self._at.append(p)
                self._n.append(n)
        self.repeats += [(n, places[a : b + 1]) for n, a, b in found]

    def place(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(string, place in it)."""
        run = np.searchsorted(self.begin, at, "right") - 1
        return run, at - self.begin[run]

    def later(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(string, place in it, length)."""
        return *self.place(np.array(self._at, np.int64)), np.array(self._n, np.int64)
