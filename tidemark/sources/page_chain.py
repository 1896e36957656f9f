"""The order of stored result pages, each of which names the next one.

Pages arrive in any order; ``next_uri`` leads from one to the next and is NULL on
the last.  The place of a page is found by pointer doubling: every page knows the
page 1, 2, 4, ... steps ahead, so a chain takes as many joins as its length has
binary digits, and no task walks it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import named
from tidemark.session import run_dir

COMPLETE = "complete"
GAP = "gap"
LOOP = "loop"
FORK = "fork"


def page_order(pages: DataFrame, uri: str = "uri", next_uri: str = "next_uri") -> DataFrame:
    """``uri``, ``chain`` (uri of its last page), ``page`` (from 0), ``state`` and ``missing`` of every page.

    ``state`` is ``complete``; ``gap`` if the last page names one that is not there, which
    ``missing`` holds; ``fork`` if several first pages lead to the same last one, where ``page``
    is counted on the longest way; ``loop`` if no last page is reached (``chain`` and ``page``
    are NULL then).  A page fetched several times counts once, with its greatest
    ``next_uri``; one without a ``uri`` has no place and is left out.
    """
    spark = pages.sparkSession
    folder = run_dir(spark, "page-order")
    turns = 0

    def kept(frame: DataFrame) -> DataFrame:
        nonlocal turns
        turns += 1
        path = f"{folder}/{turns}"
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    known = kept(
        pages.select(named(uri).alias("uri"), named(next_uri).alias("next"))
        .where("uri IS NOT NULL")
        .groupBy("uri")
        .agg(F.max("next").alias("next"))
    )
    there = known.select(F.col("uri").alias("next"), F.lit(True).alias("there"))
    # ``to`` is the page ``steps`` ahead, NULL beyond the last page, whose name is ``last``.
    ahead = kept(
        known.join(there, "next", "left").select(
            "uri",
            F.when(F.col("there"), F.col("next")).alias("to"),
            F.when(F.col("there").isNull(), F.col("uri")).alias("last"),
            F.when(F.col("there").isNull(), F.col("next")).alias("missing"),
            F.when(F.col("there"), 1).otherwise(0).cast("long").alias("steps"),
        )
    )
    # Pages that have not arrived after so many doublings go round.
    longest = known.count()
    for _ in range(longest.bit_length()):
        if ahead.where("to IS NOT NULL").isEmpty():
            break
        further = ahead.select(
            F.col("uri").alias("to"),
            F.struct("to", "last", "missing", "steps").alias("f"),
        )
        moved = F.col("f").isNotNull()
        ahead = kept(
            ahead.join(further, "to", "left").select(
                "uri",
                F.col("f.to").alias("to"),
                F.when(moved, F.col("f.last")).otherwise(F.col("last")).alias("last"),
                F.when(moved, F.col("f.missing")).otherwise(F.col("missing")).alias("missing"),
                (F.col("steps") + F.coalesce("f.steps", F.lit(0))).alias("steps"),
            )
        )
    # First pages are those that no page names.
    named_ = known.select(F.col("next").alias("uri")).where("uri IS NOT NULL").distinct()
    firsts = ahead.join(named_, "uri", "left_anti").groupBy("last").agg(F.count(F.lit(1)).alias("heads"))
    chains = ahead.where("last IS NOT NULL").groupBy("last").agg(F.max("steps").alias("length"))
    chains = chains.join(firsts, "last", "left")
    state = (
        F.when(F.col("last").isNull(), LOOP)
        .when(F.col("heads") > 1, FORK)
        .when(F.col("missing").isNotNull(), GAP)
        .otherwise(COMPLETE)
    )
    return ahead.join(chains, "last", "left").select(
        "uri",
        F.col("last").alias("chain"),
        (F.col("length") - F.col("steps")).alias("page"),
        state.alias("state"),
        "missing",
    )
