"""Mixing sources to target weights by entropy balancing, with DataFrame operations only.

Each source has a target of words.  Among all document rates in ``[0, cap]`` that meet the
target, the ones closest to one copy each in entropy are ``min(cap, exp(l * size))`` with one dual
variable ``l`` per source: rates tilted exponentially by document size.  The dual is convex in
each ``l``; Newton steps inside a shrinking bracket solve it.  A step is one Spark aggregation over the
counts per (source, size), so its cost follows the number of distinct sizes, not of documents, and no
source is gathered in one task.  Rates are then rounded into whole copies along the sizes of
a source: running sums of the fractions are rounded, so the words a source takes differ from its target
by at most its largest document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laminar.llm.common import settle, word_count

WEIGHTS = (3, 1, 2)  # fixed by the task: sources by code point, null last, repeat these weights
RATIO = 1.5  # words of the mix per word of the input
CAP = 2.0  # copies of a document, and of a source, at most
STEPS, TOLERANCE = 60, 1e-7
SALTS = 64


def _key(source: Column) -> Column:
    """A source's name as a join key that is never null."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source.cast("string")))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, ratio: float = RATIO, cap: float = CAP) -> DataFrame:
    """``sources(key, source, source_size)`` with ``target``: shares by weight that stop at ``cap`` times the size.

    Filling in order of cap per weight gives the level at which resharing ends.  The windows run over one
    row per source.
    """
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.row_number().over(turn) - 1) % len(weights) + 1)
    all_rows = Window.partitionBy()
    order = Window.orderBy(F.col("top") / F.col("weight"), "key")
    fill = order.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.col("budget") - F.coalesce(F.sum("top").over(fill), F.lit(0.0)))
             / (F.col("all_weight") - F.coalesce(F.sum("weight").over(fill), F.lit(0.0))))
    out = (sources.withColumn("weight", weight).withColumn("top", cap * F.col("source_size"))
           .withColumn("budget", ratio * F.sum("source_size").over(all_rows))
           .withColumn("all_weight", F.sum("weight").over(all_rows))
           .withColumn("level", level).withColumn("place", F.row_number().over(order)))
    # the first source, in that order, that the level leaves below its cap ends the filling
    fits = F.when(F.col("level") * F.col("weight") <= F.col("top"), F.struct("place", "level"))
    return (out.withColumn("final", F.coalesce(F.min(fits).over(all_rows)["level"], F.lit(float("inf"))))
            .withColumn("target", F.least("top", F.col("final") * F.col("weight")))
            .select("key", "source", "source_size", "target"))


def _rate(cap: float) -> Column:
    """A document's rate from its source's dual variable and its size in units of the mean."""
    tilted = F.least(F.lit(cap), F.exp(F.least(F.lit(700.0), F.col("dual") * F.col("size") / F.col("unit"))))
    return F.when(F.col("full"), F.lit(cap)).when(F.col("target") <= 0, F.lit(0.0)).otherwise(tilted)


def _exact_sum(x: Column) -> Column:
    """A sum that does not depend on the order of its rows, so reruns agree to the last digit."""
    return F.sum(x.cast("decimal(38,10)")).cast("double")


def solve(counts: DataFrame, goals: DataFrame, cap: float = CAP) -> DataFrame:
    """Newton iterations for the dual variable of each source: ``goals`` with ``dual``, ``unit`` and ``full``."""
    state = settle(goals.join(counts.groupBy("key").agg(F.sum("n").alias("docs")), "key")
                   .withColumn("unit", F.greatest(F.col("source_size") / F.col("docs"), F.lit(1e-9)))
                   .withColumn("full", F.col("target") >= cap * F.col("source_size") * (1 - 1e-12))
                   .withColumn("dual", F.log(F.greatest(F.col("target") / F.greatest("source_size", F.lit(1)), F.lit(1e-300))))
                   .withColumn("low", F.lit(float("-inf"))).withColumn("high", F.lit(float("inf")))
                   .withColumn("open", ~F.col("full") & (F.col("target") > 0)), "dual")
    live = F.col("open")
    for _ in range(STEPS):
        if state.where(live).isEmpty():
            break
        words = F.col("n") * F.col("size") * F.col("rate")
        sums = (counts.join(state.where(live).select("key", "dual", "unit", "full", "target"), "key")
                .withColumn("rate", _rate(cap)).groupBy("key")
                .agg(_exact_sum(words).alias("got"),
                     _exact_sum(F.when(F.col("rate") < cap, words * F.col("size") / F.col("unit")).otherwise(0.0)).alias("slope")))
        gap = F.col("target") - F.col("got")
        near = F.abs(gap) <= TOLERANCE * F.col("target")
        low = F.when(live & (gap > 0), F.greatest("low", "dual")).otherwise(F.col("low"))
        high = F.when(live & (gap < 0), F.least("high", "dual")).otherwise(F.col("high"))
        step = F.col("dual") + gap / F.col("slope")
        width = F.abs("dual") + 1.0
        middle = (F.when(F.col("high2") == float("inf"), F.col("dual") + width)
                  .when(F.col("low2") == float("-inf"), F.col("dual") - width).otherwise((F.col("low2") + F.col("high2")) / 2))
        inside = (F.col("slope") > 0) & (step > F.col("low2")) & (step < F.col("high2")) & (F.abs(step - F.col("dual")) <= 8 * width)
        state = settle(
            state.join(sums, "key", "left").withColumn("low2", low).withColumn("high2", high)
            .withColumn("dual", F.when(~live | near | (F.col("high2") <= F.col("low2")), F.col("dual"))
                        .when(inside, step).otherwise(middle))
            .withColumn("open", live & ~near & (F.col("low2") < F.col("high2")))
            .drop("low", "high", "got", "slope").withColumnsRenamed({"low2": "low", "high2": "high"}), "dual")
    return state.select("key", "source", "source_size", "target", "unit", "full", "dual")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, ratio: float = RATIO, cap: float = CAP,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per input row: ``(id, size, source_size, target, rate, copies)``, and ``row_col`` if given.

    ``size`` counts words (null text: 0).  Null sources form one source, last in order.  Documents
    without words get no copies.  Repeated rows are documents of their own; ties
    in size are broken by a hash of the id, so reruns agree.  ``row_col``, a column that is unique and never
    null, tells rows with a null or repeated id apart.  An empty table gives no rows; other columns are ignored.
    """
    row = [F.col(row_col).alias("row")] if row_col else []
    named = F.coalesce(*[c.cast("string") for c in (F.col("id"), *([F.col("row")] if row_col else []))])
    sized = settle(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                               word_count(F.col(text_col)).alias("size"), *row)
                   .withColumn("key", _key(F.col("source")))
                   .withColumn("spread", F.xxhash64(named, F.lit(9))), "sizes")
    goals = targets(sized.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size")),
                    weights, ratio, cap)
    salt = F.pmod(F.col("spread"), F.lit(SALTS)).alias("salt")
    salted = sized.groupBy("key", "size", salt).agg(F.count("*").alias("n"))
    counts = settle(salted.groupBy("key", "size").agg(F.sum("n").alias("n")), "counts")
    state = solve(counts, goals, cap)

    # whole copies of a group of equal documents, from the rounded running sum of the fractions
    along = Window.partitionBy("key").orderBy("size")
    rated = counts.join(state, "key").withColumn("rate", F.when(F.col("size") > 0, _rate(cap)).otherwise(0.0))
    part = F.col("n") * (F.col("rate") - F.floor("rate"))
    upto = F.floor(F.sum(part).over(along) + 0.5)
    before = F.floor(F.coalesce(F.sum(part).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)) + 0.5)
    groups = rated.withColumn("more", upto - before).select("key", "size", "source_size", "target", "rate", "more")

    # which documents of a group get one more: the first by hash, ranked salt by salt
    earlier = Window.partitionBy("key", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = salted.withColumn("skip", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    plan = groups.join(offsets, ["key", "size"]).withColumn("left", F.col("more") - F.col("skip"))
    place = Window.partitionBy("key", "size", "salt").orderBy("spread", "id", *(["row"] if row_col else []))
    ranked = sized.withColumn("salt", salt).withColumn("place", F.row_number().over(place))
    copies = (F.floor("rate") + F.when(F.col("place") <= F.col("left"), 1).otherwise(0)).cast("long")
    return (ranked.join(plan, ["key", "size", "salt"])
            .select(F.col("id").alias(id_col), "size", "source_size", "target", "rate", copies.alias("copies"),
                    *([F.col("row").alias(row_col)] if row_col else [])))
