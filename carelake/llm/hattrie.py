"""A HAT-trie of word-id phrases: burstable hash containers under a shallow trie, in numpy.

A phrase is up to four word ids (32 bits each, 0 where it is shorter) in two 64-bit halves. The root deals phrases to
prefix partitions; below it, an inner node deals them by a digit of the next word id; the leaves are hash containers
(open addressing, filled by whole arrays at a time). A container with more than ``burst`` phrases bursts: an inner node with
small containers takes its place. Small containers keep the probes of a batch inside the processor's cache.

When the trie holds more than ``held`` phrases, its largest root subtrees are spilled whole, each as one run sorted by
phrase, until half of the room is free again.
"""

from __future__ import annotations

import numpy as np

from carelake.llm.words import mix

FAN = 16
DEPTH = 3  # digits of the first, second and third word id below the partition
_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)


class Container:
    """Phrase counts by open addressing; a slot with count 0 is free."""

    def __init__(self, room: int = 64):
        self.hi, self.lo = np.zeros(room, dtype=np.uint64), np.zeros(room, dtype=np.uint64)
        self.n = np.zeros(room, dtype=np.int64)
        self.size = 0

    def entries(self):
        used = np.flatnonzero(self.n)
        return self.hi[used], self.lo[used], self.n[used]

    def add(self, hi: np.ndarray, lo: np.ndarray, n: np.ndarray) -> None:
        room = len(self.n)
        while 2 * (self.size + len(hi)) > room:
            room *= 2
        if room > len(self.n):
            old = self.entries()
            self.__init__(room)
            self._put(*old)
        self._put(hi, lo, n)

    def _put(self, hi, lo, n):
        last = np.uint64(len(self.n) - 1)
        slot = mix(hi * np.uint64(0x9E3779B97F4A7C15) + lo, seed=91) & last
        while len(hi):
            free = self.n[slot] == 0
            at = slot[free]
            self.hi[at], self.lo[at] = hi[free], lo[free]  # of several phrases in one free slot the last stays
            here = (self.hi[slot] == hi) & (self.lo[slot] == lo)
            np.add.at(self.n, slot[here], n[here])
            on = ~here
            hi, lo, n, slot = hi[on], lo[on], n[on], (slot[on] + np.uint64(1)) & last
        self.size = int(np.count_nonzero(self.n))


class HatTrie:
    def __init__(self, parts: int, hot: int, burst: int = 1 << 15, held: int = 1 << 20):
        self.parts, self.hot, self.burst, self.held = parts, hot, burst, held
        self._clear()

    def _clear(self):
        # a code is a leaf's number, or -1 - the number of an inner node
        self.root = np.arange(self.parts)
        self.leaves: list[Container | None] = [None] * self.parts
        self.depth = [0] * self.parts
        self.inner = np.zeros((0, FAN), dtype=np.int64)
        self.sizes = np.zeros(self.parts, dtype=np.int64)

    def part_of(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The prefix partition: by the first word; phrases of a hot first word (id ``hot`` or less) by all their words."""
        first = hi >> _HALF
        whole = mix(mix(hi, seed=92) + lo, seed=93)
        return (np.where(first <= np.uint64(self.hot), whole, mix(first, seed=94)) % np.uint64(self.parts)).astype(np.int64)

    @staticmethod
    def _digit(hi, lo, depth: int):
        word = (hi >> _HALF, hi & _LOW, lo >> _HALF)[depth]
        return (mix(word, seed=95) & np.uint64(FAN - 1)).astype(np.int64)

    def _leaf_of(self, part, hi, lo):
        code = self.root[part]
        for depth in range(DEPTH):
            inside = np.flatnonzero(code < 0)
            if not len(inside):
                break
            code[inside] = self.inner[-1 - code[inside], self._digit(hi[inside], lo[inside], depth)]
        return code

    def add(self, hi: np.ndarray, lo: np.ndarray):
        """Count phrases; yields (partition, hi, lo, n) runs that had to be spilled."""
        part = self.part_of(hi, lo)
        leaf = self._leaf_of(part, hi, lo)
        order = np.argsort(leaf.astype(np.uint16) if len(self.leaves) < 1 << 16 else leaf, kind="stable")
        hi, lo, part, leaf = hi[order], lo[order], part[order], leaf[order]
        cut = np.flatnonzero(np.concatenate([[True], leaf[1:] != leaf[:-1], [True]])) if len(leaf) else np.zeros(1, np.int64)
        one = np.ones(len(hi), dtype=np.int64)
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            at, root = int(leaf[a]), int(part[a])
            box = self.leaves[at]
            if box is None:
                box = self.leaves[at] = Container()
            before = box.size
            box.add(hi[a:b], lo[a:b], one[a:b])
            self.sizes[root] += box.size - before
            if box.size > self.burst and self.depth[at] < DEPTH:
                self._split(at, root)
        if self.sizes.sum() > self.held:
            yield from self._spill(self.held // 2)

    def _split(self, at: int, root: int) -> None:
        depth, (hi, lo, n) = self.depth[at], self.leaves[at].entries()
        digit = self._digit(hi, lo, depth)
        first = len(self.leaves)
        code = -1 - len(self.inner)
        self.inner = np.vstack([self.inner, first + np.arange(FAN)])
        for d in range(FAN):
            box = Container()
            sel = digit == d
            box.add(hi[sel], lo[sel], n[sel])
            self.leaves.append(box)
            self.depth.append(depth + 1)
        self.leaves[at] = None
        if self.root[root] == at:
            self.root[root] = code
        else:
            self.inner[self.inner == at] = code

    def _under(self, code: int):
        if code >= 0:
            return [code]
        return [leaf for child in self.inner[-1 - code] for leaf in self._under(int(child))]

    def _run(self, root: int):
        """A whole subtree as one sorted run; its root is an empty container again."""
        leaves = self._under(int(self.root[root]))
        boxes = [self.leaves[i].entries() for i in leaves if self.leaves[i] is not None]
        for i in leaves:
            self.leaves[i] = None
        hi, lo, n = (np.concatenate(x) for x in zip(*boxes))
        order = np.lexsort((lo, hi))
        self.root[root] = root  # the partition's first leaf
        self.sizes[root] = 0
        return root, hi[order], lo[order], n[order]

    def _spill(self, keep: int):
        left = int(self.sizes.sum())
        for root in np.argsort(-self.sizes).tolist():
            if left <= keep or not self.sizes[root]:
                return
            left -= int(self.sizes[root])
            yield self._run(root)

    def close(self):
        """All that is left, in sorted runs."""
        yield from self._spill(0)
        self._clear()


# --- runs as bytes ------------------------------------------------------------------------------------------------

def _planes(x: np.ndarray) -> bytes:
    """Byte planes: equal bytes stand together, which the shuffle's compression shortens."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()


def pack_run(hi, lo, n) -> dict:
    return {"hi": _planes(np.diff(hi, prepend=np.uint64(0))), "lo": _planes(lo), "n": _planes(n)}


def merge_runs(runs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases and total counts of packed runs of one partition, in phrase order."""
    hi = [np.cumsum(_from_planes(r["hi"]), dtype=np.uint64) for r in runs]
    lo, n = [_from_planes(r["lo"]) for r in runs], [_from_planes(r["n"]).astype(np.int64) for r in runs]
    hi, lo, n = np.concatenate(hi), np.concatenate(lo), np.concatenate(n)
    order = np.lexsort((lo, hi))
    hi, lo, n = hi[order], lo[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])]))
    return hi[first], lo[first], np.add.reduceat(n, first)
