"""Order of result pages by pointer doubling."""

import random

from tidemark.sources import page_order


def order(spark, rows):
    pages = spark.createDataFrame(rows, "uri string, next_uri string")
    return {r["uri"]: tuple(r)[1:] for r in page_order(pages).collect()}


def test_shuffled_pages_get_their_numbers(spark):
    rows = [(f"u{i}", f"u{i + 1}" if i < 99 else None) for i in range(100)]
    random.Random(1).shuffle(rows)
    found = order(spark, rows + rows[:30])  # some were fetched twice
    assert found == {f"u{i}": ("u99", i, "complete", None) for i in range(100)}


def test_gaps_loops_and_forks(spark):
    rows = [("a0", "a1"), ("a1", "a2"), ("a3", None)]  # a2 is missing
    rows += [("l0", "l1"), ("l1", "l2"), ("l2", "l1"), ("s", "s")]
    rows += [("f0", "f1"), ("g0", "f1"), ("f1", None), ("h", "g0")]
    rows += [(None, "a0"), ("one", None)]
    found = order(spark, rows)
    assert found["a0"] == ("a1", 0, "gap", "a2") and found["a1"] == ("a1", 1, "gap", "a2")
    assert found["a3"] == ("a3", 0, "complete", None) and found["one"] == ("one", 0, "complete", None)
    assert all(found[u] == (None, None, "loop", None) for u in ("l0", "l1", "l2", "s"))
    assert {u: found[u][1:3] for u in ("h", "g0", "f0", "f1")} == {
        "h": (0, "fork"), "g0": (1, "fork"), "f0": (1, "fork"), "f1": (2, "fork"),
    }
    assert len(found) == 12
    assert order(spark, []) == {}
