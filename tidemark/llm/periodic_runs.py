"""Runs of words that repeat with a period, found by recompression.

A run is a stretch of words with smallest period ``q`` and at least
``max(6, 4 q)`` words that no neighbouring word extends.  Texts of a batch become
one sequence of word numbers, each text closed by a number of its own.

1. The sequence is compressed level by level: a block of one repeated symbol
   becomes a symbol of (symbol, length); where no symbols repeat side by side, the
   alphabet is dealt into a left and a right half and every pair (left, right)
   becomes one symbol.  Equal symbols of a level stand for equal words, and the
   borders depend on neighbouring symbols only, so equal stretches are cut alike
   but for their ends.  The levels are a run-length grammar of the sequence.
2. The common extension of two places is read from the grammar: climb while both
   places are borders of the next level, pass equal symbols (blocks by the lesser
   of their lengths), and descend after the first difference.
3. A run of period ``p`` holds a place ``i`` on the grid of ``2 p`` with the same word
   at ``i``, ``i + p`` and ``i + 2 p``.  The grids of all periods are a harmonic sum; the
   extensions of each such place to both sides give the run exactly.  Of equal
   stretches the smallest period stays.

No suffixes are ordered, and nothing is shuffled: texts are independent.

Defined results: null and empty texts have no words and no run; a repeated row
is judged like its first; an empty table gives no rows; a text longer than a
batch is a batch of its own; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices

#: A run has this many words at least, and this many times its period.
LEAST = 6
TIMES = 4
#: Words that share a grammar; a longer text has one of its own.
WORDS = 200_000
#: Grid places that are extended at once.
_PLACES = 1 << 18


def _blocks(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each block of one symbol, and the symbols of the blocks."""
    starts = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
    lengths = np.diff(np.r_[starts, len(symbols)])
    return starts, np.unique(symbols[starts] * (lengths.max() + 1) + lengths, return_inverse=True)[1]


def _pairs(symbols: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for pairs of a left and a right symbol, all others staying alone."""
    size = int(symbols.max()) + 1
    deal = np.random.default_rng(seed)
    first = np.zeros(0, np.int64)
    while not len(first):
        left = (deal.random(size) < 0.5)[symbols]
        ways = [np.flatnonzero(left[:-1] & ~left[1:]), np.flatnonzero(~left[:-1] & left[1:])]
        first = max(ways, key=len)
    keys = symbols.copy()
    keys[first] = (symbols[first] + 1) * size + symbols[first + 1]
    alone = np.ones(len(symbols), bool)
    alone[first + 1] = False
    starts = np.flatnonzero(alone)
    return starts, np.unique(keys[starts], return_inverse=True)[1]


class Grammar:
    """The levels of a sequence of whole numbers from 0, as flat arrays.

    A border lies before each symbol of a level and after the last.  ``up`` and
    ``down`` lead to the same border of the next and the previous level (-1: there
    is none); the symbols beside border ``b`` are ``symbols[b]`` and ``symbols[b + 1]``.
    """

    def __init__(self, sequence: np.ndarray):
        level = np.unique(sequence, return_inverse=True)[1].astype(np.int64)
        symbols, ups, downs, behind, ahead = [], [], [], [], []
        down, at, depth = np.full(len(level) + 1, -1), 0, 0
        while True:
            n = len(level)
            symbols.append(np.r_[-1, level, -2])
            downs.append(np.r_[down, -1])
            starts = np.flatnonzero(np.r_[True, level[1:] != level[:-1]]) if n else np.zeros(0, np.int64)
            # How many equal symbols end and begin at a symbol; one apiece unless there are blocks.
            lengths = np.diff(np.r_[starts, n])
            since = np.arange(n) - np.repeat(starts, lengths)
            behind.append(np.r_[0, since + 1, 0])
            ahead.append(np.r_[0, np.repeat(lengths, lengths) - since, 0])
            up = np.full(n + 2, -1)
            ups.append(up)
            # Symbols that all differ never match, so there is nothing to gain above them.
            if n < 2 or int(level.max()) + 1 == n:
                break
            starts, higher = _blocks(level) if len(starts) < n else _pairs(level, depth)
            following = at + n + 2
            up[starts] = following + np.arange(len(starts))
            up[n] = following + len(starts)
            down = at + np.r_[starts, n]
            level, at, depth = higher.astype(np.int64), following, depth + 1
        self.size = len(sequence)
        self.symbols, self.up, self.down = (np.concatenate(x) for x in (symbols, ups, downs))
        self.behind, self.ahead = np.concatenate(behind), np.concatenate(ahead)

    def extension(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """How many symbols agree from the borders ``i`` and ``j`` on, rightwards or ``back``."""
        found = np.zeros(len(i), np.int64)
        side, sign, runs = (0, -1, self.behind) if back else (1, 1, self.ahead)
        live, a, b = np.arange(len(i)), i.astype(np.int64), j.astype(np.int64)
        rising = np.ones(len(i), bool)
        while len(live):
            above, beside = self.up[a], self.up[b]
            rise = rising & (above >= 0) & (beside >= 0)
            x, y = a + side, b + side
            same = ~rise & (self.symbols[x] == self.symbols[y])
            step = sign * np.minimum(runs[x], runs[y])
            fall = ~rise & ~same
            done = fall & (a <= self.size)  # the first level comes first
            found[live[done]] = np.abs(a - i[live])[done]
            rising &= ~fall
            a, b = (
                np.where(rise, high, np.where(same, c + step, np.where(done, c, self.down[c])))
                for c, high in ((a, above), (b, beside))
            )
            go = ~done
            live, a, b, rising = live[go], a[go], b[go], rising[go]
        return found


def runs(sequence: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, end, period) of the runs of ``sequence``, by start and end; none exceeds ``longest``."""
    grammar = Grammar(sequence)
    n = len(sequence)
    found = np.zeros((0, 3), np.int64)

    def extend(places: list[np.ndarray], periods: list[int]) -> np.ndarray:
        i = np.concatenate(places)
        p = np.repeat(periods, [len(x) for x in places])
        start = i - grammar.extension(i, i + p, back=True)
        end = i + p + grammar.extension(i, i + p)
        kept = end - start >= np.maximum(LEAST, TIMES * p)
        rows = np.stack([start, end, p], axis=1)[kept]
        # Ordered by start, end and period; the first of each stretch has its smallest period.
        rows = np.unique(np.concatenate([found, rows]), axis=0)
        return rows[np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)][: len(rows)]]

    places, periods, held = [], [], 0
    for p in range(1, longest // TIMES + 1):
        here = sequence[: n - 2 * p : 2 * p]
        hits = np.flatnonzero((here == sequence[p : n - p : 2 * p]) & (here == sequence[2 * p :: 2 * p]))
        if len(hits):
            places.append(hits * (2 * p))
            periods.append(p)
            held += len(hits)
        if held > _PLACES:
            found, places, periods, held = extend(places, periods), [], [], 0
    return extend(places, periods) if places else found


def _texts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Ids and words of rows, as many as have ``most`` words together."""
    ids, texts, held = [], [], 0
    for batch in slices(batches):
        for i, text in enumerate(batch.column(1)):
            # bytes.split knows the six white-space characters only.
            found = (text.as_py() or b"").split()
            if held and held + len(found) > most:
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(batch.column(0)[i])
            texts.append(found)
            held += len(found) + 1
    if ids:
        yield ids, texts


def runs_of_texts(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Rows (start, length, period) of the runs of each list of words, by start and period."""
    number: dict[bytes, int] = {}
    parts = [[number.setdefault(w, len(number)) for w in words] for words in texts]
    # The numbers that close the texts occur once, so no run crosses them.
    for i, part in enumerate(parts):
        part.append(len(number) + i)
    firsts = np.cumsum([0, *map(len, parts)])
    sequence = np.fromiter((x for part in parts for x in part), np.int64, count=int(firsts[-1]))
    rows = runs(sequence, max(map(len, texts), default=0))
    owner = np.searchsorted(firsts, rows[:, 0], side="right") - 1
    rows = np.stack([rows[:, 0] - firsts[owner], rows[:, 1] - rows[:, 0], rows[:, 2]], axis=1)
    order = np.lexsort((rows[:, 2], rows[:, 0], owner))
    cuts = np.searchsorted(owner[order], np.arange(len(texts) + 1))
    return [rows[order][s:e] for s, e in zip(cuts, cuts[1:], strict=False)]


def _kept(words: list[bytes], found: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not len(found):
        return words
    dropped = np.zeros(len(words), bool)
    for start, length, period in found:
        dropped[start + period : start + length] = True
    return [w for w, gone in zip(words, dropped, strict=True) if not gone]


def collapse_runs(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id``, ``n_words``, the ``runs`` (start, length, period; by start, then period) and ``text`` of every row.

    ``text`` is what stays when each run is cut down to one period, with one space between words.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _texts(batches, words):
            found = runs_of_texts(texts)
            rows = np.concatenate(found)
            fields = pa.StructArray.from_arrays(
                [pa.array(rows[:, c]) for c in range(3)], ["start", "length", "period"]
            )
            ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            kept = [b" ".join(_kept(t, f)).decode() for t, f in zip(texts, found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x.as_py() for x in ids], ids[0].type),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.ListArray.from_arrays(ends, fields),
                    pa.array(kept, pa.string()),
                ],
                ["doc_id", "n_words", "runs", "text"],
            )

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(
        run,
        f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, text string",
    )
