"""Spelling variants: words of a corpus that are one edit apart, each led to its most frequent form.

Two words are near if one inserted, deleted or replaced code point makes them
equal.  All near pairs are found exactly:

1. One edit leaves the first or the second half of the shorter word as it is, so
   near words share a key: their lesser length and one of its halves.  Of a group
   of words with a common key only the rests still differ; a group beyond ``most``
   words is split in the same way by the halves of its rests, again and again, so
   no task holds a large group.  Where a rest has a single code point the group is
   bounded by the alphabet.
2. The rests of a group are a sorted list.  For every word the list behind it is
   scanned with the rows of a banded edit matrix (three cells a row): the rows of
   the prefix that a rest shares with the one before are reused, and where all
   cells of a row exceed one edit, all rests with that prefix are skipped.

The form of a word is its near word of largest count (ties: the smallest in
code-point order) if that count is at least ``ratio`` times its own.  With a ratio
over 1 counts grow along forms, so following them ends; the last form, the root,
is found by doubling the steps.

Defined results: null and empty texts have no words; letters are those of the
pattern, and only A to Z change their case; repeated rows count each; without
words there are no rows; further columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, slices

LETTERS = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 5
LEAST_COUNT = 3
RATIO = 2
#: Words of a group that one task scans together.
MOST = 2000
#: Counted words that a task holds before it hands them on.
_HELD = 200_000
_FAR = 2

Change = Callable[[object, str], str]


def _lower(word: str) -> str:
    """``word`` with A to Z in lower case and all else as it is."""
    return word.lower() if word.isascii() else word.encode().lower().decode()


def vocabulary(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    change: Change | None = None,
) -> DataFrame:
    """``word`` and its count ``n`` in all texts of ``docs``; ``change`` may edit a word by its ``doc_id``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(LETTERS).findall
        counts: Counter[str] = Counter()

        def handed() -> pa.RecordBatch:
            rows = [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(rows, ["word", "n"])

        for batch in slices(batches):
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for found, n in Counter(find(text or "")).items():
                    word = _lower(found)
                    if change is not None:
                        word = change(i, word)
                    if len(word) >= least_length:
                        counts[word] += n
            if len(counts) > _HELD:
                yield handed()
                counts.clear()
        yield handed()

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _halves(key: Column, rest: Column, least: Column) -> list[Column]:
    """Keys and rests of a ``rest`` beside words whose shorter rest has ``least`` code points."""
    length, half = F.length(rest), F.floor(least / 2).cast("int")
    tail = least - half

    def group(side: str, kept: Column, left: Column, shorter: Column) -> Column:
        name = F.concat_ws("|", key, F.lit(side), least.cast("string"), kept)
        return F.struct(name.alias("key"), left.alias("rest"), shorter.cast("int").alias("least"))

    return [
        group("<", F.substring(rest, F.lit(1), half), F.substring(rest, half + 1, length - half), tail),
        group(">", F.substring(rest, length - tail + 1, tail), F.substring(rest, F.lit(1), length - tail), half),
    ]


def _groups(words: DataFrame, most: int) -> DataFrame:
    """``key``, ``rest``, ``least`` and the word with its count: near words meet in a group of at most ``most``."""
    word, length = F.col("word"), F.length("word")
    first = _halves(F.lit(""), word, length - 1) + _halves(F.lit(""), word, length)
    rows = words.select("word", "n", F.explode(F.array(*first)).alias("g")).select("word", "n", "g.*")
    done = []
    while True:
        # A rest with one code point leaves no half to split by.
        large = cut(
            rows.filter("least > 1").groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > most).select("key")
        )
        if large.isEmpty():
            return reduce(DataFrame.unionByName, [*done, rows])
        done.append(rows.join(large, "key", "left_anti"))
        split = F.explode(F.array(*_halves(F.col("key"), F.col("rest"), F.col("least")))).alias("g")
        rows = cut(rows.join(large, "key").select("word", "n", split).select("word", "n", "g.*"))


def scan(rests: list[str]) -> Iterator[tuple[int, int]]:
    """Places ``a < b`` of all rests of a sorted list without repeats that are one edit apart."""
    shared = [0] * len(rests)
    for t in range(1, len(rests)):
        a, b = rests[t - 1], rests[t]
        n = min(len(a), len(b))
        shared[t] = next((d for d in range(n) if a[d] != b[d]), n)
    for s, word in enumerate(rests):
        length = len(word)
        # Row d holds the edits from d code points of a rest to d - 1, d and d + 1 of the word.
        rows = [(_FAR, 0, 1 if length else _FAR)]
        t = s + 1
        while t < len(rests):
            rest = rests[t]
            del rows[shared[t] + 1 if t > s + 1 else 1 :]
            low, mid, high = rows[-1]
            for d in range(len(rows) - 1, len(rest)):
                c = rest[d]
                less = min(mid + 1, low + (c != word[d - 1])) if 0 < d <= length else (mid + 1 if not d else _FAR)
                same = min(high + 1, less + 1, mid + (c != word[d])) if d < length else _FAR
                more = min(same + 1, high + (c != word[d + 1])) if d + 1 < length else _FAR
                low, mid, high = less, same, more
                rows.append((low, mid, high))
                if low >= _FAR and mid >= _FAR and high >= _FAR:
                    # All rests that begin like this one are too far: go on behind them.
                    t = bisect_left(rests, rest[:d] + chr(ord(c) + 1), t + 1)
                    break
            else:
                at = length - len(rest) + 1
                if 0 <= at <= 2 and rows[len(rest)][at] == 1:
                    yield s, t
                t += 1


def near_words(words: DataFrame, most: int = MOST) -> DataFrame:
    """Every ``word`` with each ``near`` word and the counts ``n`` and ``near_n``; ``words`` are distinct."""
    rows = _groups(words, most).select("key", "rest", "least", "word", "n")
    rows = rows.repartition("key").sortWithinPartitions("key", "rest")

    def pairs(group: list[tuple]) -> Iterator[tuple]:
        for a, b in scan([g[0] for g in group]):
            (x, least, u, n), (y, _, v, m) = group[a], group[b]
            if min(len(x), len(y)) == least:  # longer ones meet in a group of their own length
                yield u, n, v, m
                yield v, m, u, n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
        key, group = None, []

        def near() -> pa.RecordBatch:
            columns = list(zip(*pairs(group), strict=True)) or [()] * 4
            rows_ = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(rows_, ["word", "n", "near", "near_n"])

        for batch in batches:
            for of, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if of != key:
                    if len(group) > 1:
                        yield near()
                    key, group = of, []
                group.append(tuple(row))
        if len(group) > 1:
            yield near()

    return rows.mapInArrow(run, "word string, n long, near string, near_n long").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and the last form ``root`` it leads to; ``forms`` has ``word`` and ``form`` and no circles."""
    known = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        known = cut(
            known.join(onward, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            )
        )
        if known.filter("moved").isEmpty():
            return known.select("word", "root")
        known = known.drop("moved")


def variants(words: DataFrame, ratio: float = RATIO, most: int = MOST) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every distinct ``word`` with its count ``n``."""
    if ratio <= 1:
        raise ValueError("a form is more frequent than its word: the ratio exceeds 1")
    words = cut(words.select("word", "n"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    near = near_words(words, most).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    led = -F.col("best.less") >= ratio * F.col("n")
    found = cut(
        words.join(near, "word", "left").select(
            "word",
            F.when(led, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(led, -F.col("best.less")).alias("form_n"),
        )
    )
    ends = roots(found.filter("form is not null"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
