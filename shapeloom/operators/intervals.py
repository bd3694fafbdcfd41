"""Greedy intervals of ordered polls, by successor pointers instead of a walk.

An interval begins where the one before it ended and lasts until the first poll that
is far enough away. Which poll that is depends only on where the interval begins, so
every poll gets a pointer to its successor, and the polls that end an interval are
those on the chain of pointers from a run's first poll.

The chain is found level by level. Inside blocks of time, pointers are doubled until
each leaves its block; only polls that some pointer from another block enters go on to
the next level, whose blocks are longer. Once a run's polls share a block, the marks
come back down, in each block from the one poll at which the chain enters it. No step
brings a run into one task; what goes on to the next level is a small share.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shapeloom.session import stored

# Fixed value: the rate's intervals last at least half a second.
LEAST_SECONDS = 0.5
#: Longest chain inside a block and how often pointers are doubled to run through it.
_HOPS, _DOUBLINGS = 16, 4
#: Blocks of the search for successors, in lengths of the shortest interval.
_SEARCH = 512


def _block(at: Column, width: float) -> Column:
    return F.floor(at / F.lit(width)).cast("bigint")


def _blocks(begin: float, width: float) -> Callable[[str], Column]:
    return lambda time: _block(F.col(time) - begin, width)


def successors(polls: DataFrame, run: str, time: str, least: float) -> DataFrame:
    """``polls`` with ``next``: the run's first time that is at least ``least`` later, or null.

    Times are numbers, different within a run. Polls and the points ``least`` behind
    them are put in order inside blocks of time; where a block has no poll left, the
    first one of the next block that has any comes from one small row per block.
    """
    width = least * _SEARCH
    own = polls.select(run, F.col(time).alias("at"), F.col(time).alias("poll"), F.lit(None).cast("double").alias("of"))
    asked = polls.select(run, (F.col(time) + least).alias("at"), F.lit(None).cast("double").alias("poll"), F.col(time).alias("of"))
    both = own.unionByName(asked).withColumn("block", _block(F.col("at"), width))
    behind = Window.partitionBy(run, "block").orderBy(F.col("at").desc(), F.col("poll").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("near", F.last("poll", ignorenulls=True).over(behind))
    firsts = both.groupBy(run, "block").agg(F.min("poll").alias("first"))
    later = Window.partitionBy(run).orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = firsts.withColumn("far", F.last("first", ignorenulls=True).over(later)).select(run, "block", "far")
    answered = found.where(F.col("of").isNotNull()).join(carried, [run, "block"])
    return answered.select(run, F.col("of").alias(time), F.coalesce("near", "far").alias("next"))


def _levels(nodes: DataFrame, run: str, time: str, least: float, begin: float) -> list[tuple[list[DataFrame], Callable[[str], Column]]]:
    """Per level: the tables of pointers (the k-th is 2**k hops, cut off at the block's end) and the block of a time.

    Blocks are counted from ``begin``, so that in the end all of a run lies in the first one.
    """
    levels, width = [], least * _HOPS
    first = nodes.groupBy(run).agg(F.min(time).alias(time))
    while True:
        jumps = [nodes]
        for _ in range(_DOUBLINGS):
            jumps.append(stored(_doubled(jumps[-1], run, time, _blocks(begin, width)), "jumps"))
        levels.append((jumps, _blocks(begin, width)))
        last = jumps[-1]
        leaving = last.where(F.col("next").isNotNull())
        if leaving.isEmpty():
            return levels
        entered = leaving.select(run, F.col("next").alias(time)).union(first.select(run, time)).distinct()
        nodes = stored(entered.join(last, [run, time]), "entries")
        width *= _HOPS


def _doubled(jump: DataFrame, run: str, time: str, block: Callable[[str], Column]) -> DataFrame:
    """Pointers of twice as many hops; one that has left its block stays as it is."""
    further = jump.select(run, F.col(time).alias("next"), F.col("next").alias("further"), F.lit(True).alias("known"))
    joined = jump.join(further, [run, "next"], "left")
    inside = block("next") == block(time)
    return joined.select(run, time, F.when(inside & F.col("known"), F.col("further")).otherwise(F.col("next")).alias("next"))


def chain(nodes: DataFrame, run: str, time: str, least: float, begin: float) -> DataFrame:
    """``run, time`` of the polls on each run's chain, its first poll included.

    ``nodes`` has the pointers of ``successors``, no shorter than ``least``; no time is
    before ``begin``.
    """
    nodes = stored(nodes, "pointers")
    marked = nodes.groupBy(run).agg(F.min(time).alias(time))
    for jumps, block in reversed(_levels(nodes, run, time, least, begin)):
        for jump in reversed(jumps):
            hops = jump.where(block("next") == block(time))
            both = F.array_compact(F.array(time, "next"))
            marked = marked.join(hops, [run, time], "left").select(run, F.explode(both).alias(time))
        marked = stored(marked.distinct(), "marks")
    return marked


def merge_polls(polls: DataFrame, by: list[str], time: str, images: str, least_seconds: float = LEAST_SECONDS) -> DataFrame:
    """``(*by, time, images, seconds)``: polls joined until each interval lasts ``least_seconds``.

    ``time`` is in seconds, ``images`` what came in since the poll before (null: 0);
    polls without a time are left out, those of one time are one poll. A run's first
    poll starts its clock. What comes after the last full interval is not yet an
    interval. Runs are told apart by ``by``, null values included.
    """
    own = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(by)]) if by else F.lit(0)
    slim = polls.select(own.alias("run"), F.col(time).cast("double").alias("at"), F.coalesce(F.col(images).cast("long"), F.lit(0)).alias("n")).where(F.col("at").isNotNull())
    slim = stored(slim.groupBy("run", "at").agg(F.sum("n").alias("n")), "polls")
    begin = slim.agg(F.coalesce(F.min("at"), F.lit(0.0))).first()[0]
    ends = chain(successors(slim.select("run", "at"), "run", "at", least_seconds), "run", "at", least_seconds, begin)
    return _summed(slim, ends, least_seconds).select(*[F.col("run")[f"k{i}"].alias(c) for i, c in enumerate(by)], F.col("at").alias(time), F.col("n").alias(images), "seconds")


def _summed(polls: DataFrame, ends: DataFrame, least: float) -> DataFrame:
    """``run, at, n, seconds`` of the intervals that end at ``ends`` (the first of a run begins its first interval).

    An interval's length and images come from the ends and the sums before them:
    running sums inside blocks of time, plus one small row per block.
    """
    width = least * _SEARCH
    marked = polls.join(ends.withColumn("ends", F.lit(True)), ["run", "at"], "left").withColumn("block", _block(F.col("at"), width))
    inside = Window.partitionBy("run", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    blocks = marked.groupBy("run", "block").agg(F.sum("n").alias("total"))
    earlier = Window.partitionBy("run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select("run", "block", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    summed = marked.withColumn("inside", F.sum("n").over(inside)).where("ends").join(before, ["run", "block"])
    summed = summed.select("run", "block", "at", (F.col("before") + F.col("inside")).alias("upto"))
    previous = Window.partitionBy("run", "block").orderBy("at")
    last = F.max(F.struct("at", "upto"))
    carried = summed.groupBy("run", "block").agg(last.alias("last"))
    carried = carried.select("run", "block", F.lag("last").over(Window.partitionBy("run").orderBy("block")).alias("carried"))
    paired = summed.withColumn("previous", F.lag(F.struct("at", "upto")).over(previous)).join(carried, ["run", "block"])
    since = F.coalesce("previous", "carried")
    return paired.where(since.isNotNull()).select("run", "at", (F.col("upto") - since["upto"]).alias("n"), (F.col("at") - since["at"]).alias("seconds"))
