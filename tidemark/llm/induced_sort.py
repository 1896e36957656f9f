"""External induced sorting of one shard: suffix order with common-prefix values.

The suffixes that begin an ascent after a descent (LMS) are put in order first:
their substrings are sorted by one induction, named, and the names, a text of a
third of the length, are ordered in turn.  From that order two sweeps induce all
others: suffixes are taken from the queue of the current first byte in order,
and each hands the suffix that starts one byte before it to the queue of that
byte.  Queues carry (position, common prefix with the item before it in the
queue); the value for a new pair is one more than the least value passed since
the queue's last item.  Values are capped at ``depth``, and order beyond ``depth``
bytes is left open, since nobody asks for it.

Queues and finished runs hold arrays; beyond ``memory`` bytes they move to an
unnamed scratch file that disappears with the task, as a sort spill would.
"""

from __future__ import annotations

import tempfile
from collections import deque
from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 20
MEMORY = 128 << 20
ALPHABET = 256


class Scratch:
    """Counts the bytes that queues hold and keeps what exceeds ``memory`` in a file."""

    def __init__(self, memory: int = MEMORY):
        self.memory, self.held, self.file, self.queues = memory, 0, None, []

    def queue(self) -> Queue:
        made = Queue(self)
        self.queues.append(made)
        return made

    def grow(self, size: int) -> None:
        self.held += size
        if self.held > self.memory:
            for q in sorted(self.queues, key=lambda q: -q.held)[:32]:
                q.spill()

    def store(self, data: np.ndarray) -> int:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        at = self.file.seek(0, 2)
        data.tofile(self.file)
        return at

    def load(self, at: int, count: int, kind: type) -> np.ndarray:
        self.file.seek(at)
        return np.fromfile(self.file, kind, count)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Queue:
    """Batches of (position, common prefix), taken from either end."""

    def __init__(self, scratch: Scratch):
        self.scratch, self.batches, self.held = scratch, deque(), 0

    def push(self, positions: np.ndarray, prefix: np.ndarray) -> None:
        if len(positions):
            self.batches.append((positions, prefix))
            size = positions.nbytes + prefix.nbytes
            self.held += size
            self.scratch.grow(size)

    def spill(self) -> None:
        for i, batch in enumerate(self.batches):
            if isinstance(batch[0], np.ndarray):
                self.batches[i] = (
                    self.scratch.store(batch[0]), self.scratch.store(batch[1]), len(batch[0]),
                )
        self.scratch.held -= self.held
        self.held = 0

    def _load(self, batch: tuple) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(batch[0], np.ndarray):
            size = batch[0].nbytes + batch[1].nbytes
            self.held -= size
            self.scratch.held -= size
            return batch
        return self.scratch.load(batch[0], batch[2], np.uint32), self.scratch.load(batch[1], batch[2], np.uint16)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """The first batches, up to about ``CHUNK`` items."""
        found = [self._load(self.batches.popleft())]
        size = len(found[0][0])
        while self.batches and size < CHUNK:
            found.append(self._load(self.batches.popleft()))
            size += len(found[-1][0])
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if len(found) > 1 else found[0]

    def take_last(self) -> tuple[np.ndarray, np.ndarray]:
        return self._load(self.batches.pop())

    def __bool__(self) -> bool:
        return bool(self.batches)


class Text:
    """The bytes of a shard with what the sweeps ask about them."""

    def __init__(self, data: bytes):
        self.data = np.frombuffer(data, np.uint8)
        self.size = n = len(data)
        padded = data + bytes(8)
        self.words = np.ndarray((n + 1,), "<u8", padded, 0, (1,))
        # The type of a position is that of the end of its run of equal bytes.
        last = np.ones(n, bool)
        last[:-1] = self.data[1:] != self.data[:-1]
        ends = np.flatnonzero(last)
        ascends = np.zeros(len(ends), bool)  # the last suffix descends to the end of the text
        ascends[:-1] = self.data[ends[:-1] + 1] > self.data[ends[:-1]]
        runs = np.diff(np.r_[-1, ends])
        self.ascends = np.repeat(ascends, runs)
        self.run_ends = ends
        lms = self.ascends.copy()
        lms[0] = False
        lms[1:] &= ~self.ascends[:-1]
        self.lms = np.flatnonzero(lms).astype(np.uint32)

    def run(self, position: int) -> int:
        """Length of the run of equal bytes from a position."""
        return int(self.run_ends[np.searchsorted(self.run_ends, position)]) - int(position) + 1

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Common prefix of the suffixes at ``a`` and ``b``, at most ``most`` bytes."""
        a, b = a.astype(np.int64), b.astype(np.int64)
        most = np.minimum(most, self.size - np.maximum(a, b))
        found = most.copy()
        open_ = np.flatnonzero(most > 0)
        at = 0
        while len(open_):
            x, y = a[open_] + at, b[open_] + at
            differ = self.words[x] ^ self.words[y]
            hit = differ != 0
            if hit.any():
                low = differ[hit]
                low &= ~low + np.uint64(1)
                zeros = np.bitwise_count(low - np.uint64(1)).astype(np.int64) // 8
                found[open_[hit]] = np.minimum(most[open_[hit]], at + zeros)
            open_ = open_[~hit]
            at += 8
            open_ = open_[most[open_] > at]
        return found


def _sweep(
    text: Text,
    scratch: Scratch,
    queues: list[Queue],
    others: list[Queue],
    depth: int,
    down: bool,
    carry: bool,
) -> Iterator[tuple[int, bool, np.ndarray, np.ndarray]]:
    """One sweep over the first bytes, upwards for descending suffixes, downwards for ascending ones.

    Yields (byte, induced, positions, common prefixes) in the order of the sweep.
    ``others`` hold the suffixes of the other kind, which follow those in
    ``queues`` at every byte.
    """
    data, ascends = text.data, text.ascends
    least = np.full(ALPHABET, depth, np.int64)  # least value since the last item of each queue

    def hand_on(positions: np.ndarray, prefix: np.ndarray) -> None:
        inner = np.flatnonzero(positions > 0)
        before = positions[inner] - np.uint32(1)
        mine = ascends[before] if down else ~ascends[before]
        inner, before = inner[mine], before[mine]
        keys = data[before]
        order = np.argsort(keys, kind="stable")
        found, starts = np.unique(keys[order], return_index=True)
        whole = int(prefix.min()) if carry and len(prefix) else depth
        touched = np.zeros(ALPHABET, bool)
        stretched = np.append(prefix, np.uint16(depth)) if carry else prefix
        for key, at in zip(found, np.split(order, starts[1:]), strict=False):
            places = inner[at]
            if carry:
                gaps = np.minimum.reduceat(stretched, places + 1).astype(np.int64)
                first = min(int(least[key]), int(prefix[: places[0] + 1].min()))
                values = np.r_[first, gaps[:-1]] + 1
                least[key] = gaps[-1]
                touched[key] = True
                made = np.minimum(values, depth).astype(np.uint16)
            else:
                made = np.zeros(len(at), np.uint16)
            queues[key].push(before[at], made)
        if carry:
            least[~touched] = np.minimum(least[~touched], whole)

    for c in range(ALPHABET - 1, -1, -1) if down else range(ALPHABET):
        first, last = True, None
        while queues[c]:
            positions, prefix = queues[c].take()
            prefix = prefix.copy()
            if first:
                prefix[0] = 0  # another first byte
                first = False
            yield c, True, positions, prefix
            last = int(positions[-1])
            hand_on(positions, prefix)
        while others[c]:
            if down:
                positions, prefix = others[c].take_last()
                # Stored upwards: the value of an item is that with the item below it.
                below = prefix[0] if carry else 0
                positions = positions[::-1]
                prefix = np.r_[np.uint16(0), prefix[:0:-1]].astype(np.uint16)
            else:
                positions, prefix = others[c].take()
                prefix = prefix.copy()
                below = 0
            if first:
                prefix[0] = 0
            elif last is not None:
                # An ascending and a descending suffix part where the shorter run of the byte ends.
                prefix[0] = min(text.run(last), text.run(int(positions[0])), depth) if carry else 0
            elif down:
                prefix[0] = pending
            first, last, pending = False, None, below
            yield c, False, positions, prefix
            hand_on(positions, prefix)


def _induce(
    text: Text, seeds: np.ndarray, prefix: np.ndarray, depth: int, carry: bool, memory: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes from the largest down, given the LMS suffixes in order.

    Yields positions with the common prefix with the (larger) one before.
    """
    scratch = Scratch(memory)
    down, up, given, finished = ([scratch.queue() for _ in range(ALPHABET)] for _ in range(4))
    firsts = text.data[seeds]
    for key in np.unique(firsts):
        at = firsts == key
        given[key].push(seeds[at], prefix[at])
    tail = text.size - 1
    up[text.data[tail]].push(np.array([tail], np.uint32), np.zeros(1, np.uint16))
    for c, induced, positions, values in _sweep(text, scratch, up, given, depth, False, carry):
        if induced:
            finished[c].push(positions, values)
    for _, _, positions, values in _sweep(text, scratch, down, finished, depth, True, carry):
        yield positions, values
    scratch.close()


def _order_names(names: np.ndarray, rounds: int) -> np.ndarray:
    """Positions of the suffixes of ``names`` in order of their first ``2**rounds`` names, by doubling."""
    order = np.argsort(names, kind="stable")
    ranked = names[order]
    rank = np.empty(len(names) + 1, np.int64)
    rank[-1] = -1
    rank[order] = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])[np.cumsum(np.r_[True, ranked[1:] != ranked[:-1]]) - 1]
    step = 1
    for _ in range(rounds):
        held = rank[order]
        same = np.r_[False, held[1:] == held[:-1]]
        tied = np.flatnonzero(same | np.r_[same[1:], False])
        if not len(tied):
            break
        items = order[tied]
        group, second = rank[items], rank[np.minimum(items + step, len(names))]
        by = np.lexsort((second, group))
        items, group, second = items[by], group[by], second[by]
        order[tied] = items
        new = np.r_[True, (group[1:] != group[:-1]) | (second[1:] != second[:-1])]
        # A rank is the place in the order of the first item that is equal so far.
        rank[items] = tied[np.flatnonzero(new)[np.cumsum(new) - 1]]
        step *= 2
    return order


def suffixes(data: bytes, depth: int, memory: int = MEMORY) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffix positions from the largest down, with common prefixes (at most ``depth``) to the one before."""
    if not data:
        return
    text = Text(data)
    lms = text.lms
    seeds, prefix = lms, np.zeros(len(lms), np.uint16)
    if len(lms) > 1:
        # Sort the LMS substrings by an induction from any order of equal first bytes.
        start = lms[np.argsort(text.data[lms], kind="stable")]
        is_lms = np.zeros(text.size, bool)
        is_lms[lms] = True
        found = [p[is_lms[p]] for p, _ in _induce(text, start, prefix, depth, False, memory)]
        ordered = np.concatenate(found)[::-1]
        which = np.searchsorted(lms, ordered)
        lengths = np.diff(np.r_[lms.astype(np.int64), text.size]) + 1  # with the first byte of the next
        size = lengths[which]
        equal = size[1:] == size[:-1]
        equal &= text.common(ordered[:-1], ordered[1:], np.where(equal, size[1:], 0)) >= size[1:]
        names = np.empty(len(lms), np.int64)
        names[which] = np.cumsum(np.r_[0, ~equal])
        # Two bytes at least lie between LMS positions.
        seeds = lms[_order_names(names, max(1, (depth // 2).bit_length()))]
        prefix = np.zeros(len(seeds), np.uint16)
        prefix[1:] = text.common(seeds[:-1], seeds[1:], np.full(len(seeds) - 1, depth))
    yield from _induce(text, seeds, prefix, depth, True, memory)
