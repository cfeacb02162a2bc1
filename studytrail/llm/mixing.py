"""Mixing sources to target weights by entropy balancing.

Every source shall give as many words as its target says. Among all rates that do so, and lie between 0 and ``most``,
those nearest to 1 in relative entropy are exponential tilts: a document of ``size`` words is taken ``min(most,
exp(dual * size / mean))`` times, with one dual value for each source. Newton steps on the convex dual find all
of them at once; a step is one aggregation of the histogram (source, size, documents). Rates then become whole copies:
going from the largest size of a source to the smallest, what rounding gave too much or too little is carried on,
so that a source misses its target by about half of its smallest document. Documents of one size and source differ by one copy
at most, and hashes of their ids decide which.

A null or blank text has no words and is taken 0 times. A null source is a source of its own, the last one. Null and
repeated ids are rows like all others; rows that are equal in id, source and size are told apart at random, which
no result shows. Texts of any length are counted as a whole. Other columns are ignored. An empty table gives an empty one; a source
without words has target 0. Where whole copies cannot come nearer (one document, say), the nearest number is taken.

Sizes: a histogram has a row for each source and size of text, the table of sources a row each; rounding orders the distinct
sizes of one source in one task and holds none of them. Everything else is spread by document, also where one source, or
one size in one source, holds much of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from studytrail.llm.tables import stored, with_group

WEIGHTS = (5, 2, 1)
MOST = 3
#: a word is a run of anything but these blanks (fixed value)
WORD = r"[^\x20\x09-\x0D]+"
NEAR = 1e-6  # of a target: where Newton's steps stop; rounding carries the rest
STEPS = 100
EXACT = "decimal(38,6)"  # sums that do not depend on the order of rows, so that reruns agree
PART = 1 << 16  # documents of one source and size that are ranked together


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, key, size): words of every document; ``key`` orders sources by code point, null last."""
    key = F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1")).alias("key")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size")
    return docs.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), key, size)


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(key, source_size, target) from (key, source_size): shares by weight, ``most`` times a source's size at most.

    Sources in order of the level (words a weight) at which they are full: those before a source are taken as full, the others
    share what is left. The level rises up to the first source that is not full and falls after it, so its maximum is
    the level that holds.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turn = F.pmod(F.row_number().over(Window.orderBy("key")) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), turn + 1)
    full = F.col("source_size") * F.lit(float(most))
    rows = sizes.withColumn("weight", weight).withColumn("full", full)
    before = Window.orderBy(F.col("full") / F.col("weight"), "key").rowsBetween(Window.unboundedPreceding, -1)

    def left(name: str) -> Column:
        return F.sum(name).over(everything) - F.coalesce(F.sum(name).over(before), F.lit(0.0))

    words = F.sum("source_size").over(everything) - F.coalesce(F.sum("full").over(before), F.lit(0.0))
    rows = rows.withColumn("level", words / left("weight"))
    rows = rows.withColumn("target", F.least("full", F.max("level").over(everything) * F.col("weight")))
    return rows.select("key", "source_size", "target")


def _tilt(most: float) -> Column:
    """ln of a document's rate."""
    return F.least(F.col("dual") * F.col("size") / F.col("mean"), F.lit(math.log(most)))


def solve(histogram: DataFrame, wanted: DataFrame, most: float = MOST) -> DataFrame:
    """(key, target, source_size, mean, dual, words): the dual value of every source and the words it gives.

    Newton's step is taken for the logarithm of the words, inside the bracket known so far; where it leads out of it, the bracket is cut.
    """
    filled = histogram.where(F.col("size") > 0)
    first = filled.groupBy("key").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"), F.min("size").alias("least"))
    top = F.lit(math.log(most)) * F.col("mean") / F.col("least")  # here every rate is ``most``
    at_top = F.col("target") >= F.col("source_size") * F.lit(float(most))
    state = first.join(wanted, "key").select(
        "key", "target", "source_size", "mean", F.lit(None).cast("double").alias("low"), top.alias("high"),
        F.when(at_top, top).otherwise(F.lit(0.0)).alias("next"),
    )
    state = stored(state.withColumns({"dual": F.col("next"), "words": F.lit(0.0)}), "mixing-start")
    for _ in range(STEPS):
        state = stored(_step(filled, state, most), "mixing-dual")
        if state.where(F.col("next") != F.col("dual")).isEmpty():
            break
    return state


def _step(filled: DataFrame, state: DataFrame, most: float) -> DataFrame:
    """One Newton step for all sources: ``words`` at the new ``dual`` and where to go ``next``."""
    state = state.withColumn("dual", F.col("next")).drop("next", "words")
    tilt = _tilt(most)
    words = F.col("n") * F.col("size") * F.exp(tilt)
    slope = F.when(tilt < F.lit(math.log(most)), words * F.col("size") / F.col("mean")).otherwise(F.lit(0.0))
    sums = (F.sum(c.cast(EXACT)).cast("double").alias(name) for name, c in (("words", words), ("slope", slope)))
    found = filled.join(state, "key").groupBy(*state.columns).agg(*sums)
    over = F.col("words") >= F.col("target")
    found = found.withColumns({"high": F.when(over, F.col("dual")).otherwise(F.col("high")), "low": F.when(over, F.col("low")).otherwise(F.col("dual"))})
    low, high = F.col("low"), F.col("high")
    newton = F.col("dual") + F.log(F.col("target") / F.col("words")) * F.col("words") / F.nullif(F.col("slope"), F.lit(0.0))
    inside = (newton < high) & (low.isNull() | (newton > low))
    below = F.least(high, F.col("dual") * 2, F.lit(-1.0))
    between = F.when(low > 0, F.sqrt(low * high)).otherwise((low + F.least(high, F.greatest(low, F.lit(0.0)) + 8)) / 2)
    near = F.abs(F.col("words") - F.col("target")) <= F.greatest(F.lit(0.25), F.col("target") * F.lit(NEAR))
    return found.withColumn("next", F.when(near, F.col("dual")).when(inside, newton).when(low.isNull(), below).otherwise(between)).drop("slope")


def copies_of(histogram: DataFrame, solved: DataFrame, most: float = MOST) -> DataFrame:
    """(key, size, n, rate, copies): whole copies of all documents of a source and size together, at most ``most`` a document."""
    rated = histogram.where(F.col("size") > 0).join(solved.select("key", "target", "words", "dual", "mean"), "key")
    rated = rated.select("key", "size", "n", F.exp(_tilt(most)).alias("rate"), "target", "words")
    limit = int(most)

    def work(batches):
        key, carried = None, 0.0
        for b in batches:
            copies = []
            columns = (b[c].to_pylist() for c in ("key", "size", "n", "rate", "target", "words"))
            for k, size, n, rate, target, words in zip(*columns, strict=True):
                if k != key:
                    key, carried = k, target - words
                carried += n * size * rate
                taken = min(limit * n, max(0, math.floor(carried / size + 0.5)))
                carried -= taken * size
                copies.append(taken)
            yield pa.RecordBatch.from_arrays([b["key"], b["size"], b["n"], b["rate"], pa.array(copies, pa.int64())], names=["key", "size", "n", "rate", "copies"])

    ordered = rated.repartition("key").sortWithinPartitions("key", F.desc("size"))
    return ordered.mapInArrow(work, "key string, size bigint, n bigint, rate double, copies bigint")


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target, taken (words with repeats), source, copies and rate of every document."""
    rows = stored(sized(docs), "mixing-sizes")
    histogram = stored(rows.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")), "mixing-histogram")
    wanted = stored(targets(histogram.groupBy("key").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, most), "mixing-targets")
    solved = solve(histogram, wanted, most)
    counted = histogram.join(wanted, "key").join(copies_of(histogram, solved, most).drop("n"), ["key", "size"], "left")
    copies = F.coalesce("copies", F.lit(0))
    groups = counted.select(
        F.concat_ws(" ", "size", "key").alias("group"), "n", "source_size", "target", F.coalesce("rate", F.lit(0.0)).alias("rate"),
        F.expr("coalesce(copies, 0) div n").alias("base"), F.pmod(copies, F.col("n")).alias("more"),
        F.expr(f"1 + n div {PART}").alias("parts"),
    )
    rows = rows.withColumn("group", F.concat_ws(" ", "size", "key"))
    grouped = with_group(rows, stored(groups, "mixing-groups"), "group", "doc_id", rows.count())
    grouped = stored(grouped.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts"))), "mixing-rows")
    order = Window.partitionBy("group", "part").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id")
    out = grouped.join(_quotas(grouped), ["group", "part"], "left").withColumn("rank", F.row_number().over(order))
    each = F.col("base") + (F.col("rank") <= F.coalesce("quota", "more")).cast("bigint")
    return out.withColumn("copies", each).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies", "rate"
    )


def _quotas(grouped: DataFrame) -> DataFrame:
    """(group, part, quota): documents of each part that get one copy more, where a group is ranked in parts."""
    parts = grouped.where(F.col("parts") > 1).groupBy("group", "part").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"), F.first("more").alias("more"))
    upto = F.sum("c").over(Window.partitionBy("group").orderBy("part"))
    parts = parts.withColumn("upto", upto)
    share = "cast(cast(more as decimal(38,0)) * ({}) div n as bigint)"
    return parts.select("group", "part", (F.expr(share.format("upto")) - F.expr(share.format("upto - c"))).alias("quota"))
