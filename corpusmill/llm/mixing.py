"""Mixing sources to target weights by entropy balancing, with DataFrame functions only.

Each source's documents get rates r in (0, 3) that stay as close to 1 as the token constraint allows: relative
entropy with the bounds 0 and 3 is minimised subject to sum(size * r) = target. The solution is an exponential
tilt of the odds, r / (3 - r) = exp(l * x) / 2, with x the document's size in units of its source's mean; l is the
root of the convex dual's gradient. The constraints of different sources are independent, so the dual splits into
one Newton iteration per source, run side by side on the executors over a histogram of sizes (at most 16 classes
per octave), whose sums are exact.

Rates become whole copies in two passes. Documents that hold more than 0.2 % of their source (at most 500) are
rounded one after the other, each carrying the error of those before. The rest is tilted anew to what is then
missing and rounded systematically along falling sizes: running sums of the rates' fractions, taken per cell of
about 4,000 documents and carried from cell to cell, so no source is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from corpusmill.llm.common import saved

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
CLASSES_PER_OCTAVE = 16
LARGE_SHARE = 0.002
CELL_ROWS = 4000
NEWTON_STEPS = 60


def word_count(text: Column | str) -> Column:
    r"""Number of ``[^\x20\x09-\x0D]+``; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """source, source_size, target from (source, source_size): shares of all words by weight, at most ``most`` sizes.

    Sharing the excess anew until no target is above its bound ends at target = min(most * size, level * weight); the
    level follows from the order of size / weight. Only one row per source goes through the global order.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    out = sizes.withColumn("w", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    by = W.orderBy((F.col("source_size") / F.col("w")), F.col("source").asc_nulls_last())
    everything = W.partitionBy(F.lit(1))
    out = out.withColumn("bound", F.lit(float(most)) * F.col("source_size"))
    out = out.withColumn("held", F.coalesce(F.sum("bound").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
    out = out.withColumn("left_w", F.sum("w").over(by.rowsBetween(W.currentRow, W.unboundedFollowing)))
    out = out.withColumn("level", (F.sum("source_size").over(everything) - F.col("held")) / F.col("left_w"))
    # the level holds from the first source on that does not reach its bound
    out = out.withColumn("level", F.min(F.when(F.col("bound") >= F.col("level") * F.col("w"), F.struct(F.col("source_size") / F.col("w"), F.col("level").alias("l")))).over(everything)["l"])
    return out.select("source", "source_size", F.when(F.col("source_size") == 0, 0.0).otherwise(F.coalesce(F.least("bound", F.col("level") * F.col("w")), F.col("bound"))).alias("target"))


def _rate(l: Column, x: Column) -> Column:
    """The tilted rate; 1 at l = 0, between 0 and 3."""
    return F.lit(float(MOST_COPIES)) / (1.0 + (MOST_COPIES - 1.0) * F.exp(F.least(F.lit(700.0), -l * x)))


def solved(histogram: Column, target: Column) -> Column:
    """The tilt at which the rates' words are ``target``: Newton's method, held in a bracket; null where none is needed.

    ``histogram``: array of (x, words). The gradient is monotone, so a step that leaves the bracket is replaced by
    halving it.
    """

    def gradient(l: Column, slope: bool) -> Column:
        r = lambda c: _rate(l, c["x"])
        term = (lambda c: c["words"] * c["x"] * r(c) * (1.0 - r(c) / MOST_COPIES)) if slope else (lambda c: c["words"] * r(c))
        return F.aggregate(histogram, F.lit(0.0), lambda a, c: a + term(c))

    def step(s: Column, _: Column) -> Column:
        g = s["g"]
        lo, hi = F.when(g < 0, s["l"]).otherwise(s["lo"]), F.when(g > 0, s["l"]).otherwise(s["hi"])
        new = s["l"] - g / s["d"]
        # tanh-like bracket: halve towards an unbounded side by doubling
        half = F.when(F.isnull(lo), hi * 2 - 1).when(F.isnull(hi), lo * 2 + 1).otherwise((lo + hi) / 2)
        ok = (s["d"] > 0) & (F.isnull(lo) | (new > lo)) & (F.isnull(hi) | (new < hi)) & (F.abs(new - s["l"]) < 1e6)
        l = F.when(g == 0, s["l"]).when(ok, new).otherwise(half)
        return F.struct(l.alias("l"), lo.alias("lo"), hi.alias("hi"))

    # gradients are computed once per step: a nested aggregate wraps each new tilt
    def whole(s: Column, i: Column) -> Column:
        with_g = F.transform(F.array(s), lambda t: F.struct(t["l"].alias("l"), t["lo"].alias("lo"), t["hi"].alias("hi"), (gradient(t["l"], False) - target).alias("g"), gradient(t["l"], True).alias("d")))
        return F.element_at(F.transform(with_g, lambda t: step(t, i)), 1)

    start = F.struct(F.lit(0.0).alias("l"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON_STEPS)), start, whole)["l"]


def _tilts(sized: DataFrame, goal: DataFrame) -> DataFrame:
    """source, cls, rate for each class of sizes, such that each source's words come to goal's ``goal``."""
    cells = sized.groupBy("source", "cls").agg(F.count("*").alias("n"), F.sum("size").cast("double").alias("words"))
    per = cells.groupBy("source").agg(F.sum("n").alias("sn"), F.sum("words").alias("sw"), F.collect_list(F.struct((F.col("words") / F.col("n")).alias("x"), "words")).alias("h"))
    per = per.withColumn("h", F.transform(F.array_sort("h"), lambda c: F.struct((c["x"] / (F.col("sw") / F.col("sn"))).alias("x"), c["words"].alias("words"))))
    per = per.join(goal.select(F.col("source").alias("__s"), "goal"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    per = per.withColumn("full", F.col("goal") >= F.col("sw") * (MOST_COPIES * (1 - 1e-9))).withColumn("none", F.col("goal") <= 0)
    tilt = F.when(F.col("full") | F.col("none"), F.lit(None).cast("double")).otherwise(solved(F.col("h"), F.col("goal")))
    per = per.select(F.col("source").alias("__s"), (F.col("sw") / F.col("sn")).alias("mean"), "full", "none", tilt.alias("tilt"))
    out = cells.join(per, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    rate = F.when(F.col("full"), float(MOST_COPIES)).when(F.col("none"), 0.0).otherwise(_rate(F.col("tilt"), F.col("words") / F.col("n") / F.col("mean")))
    return out.select("source", "cls", "n", "words", rate.alias("rate"))


def mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies (0 to 3), taken = copies * size.

    Sources are ordered by code point with null last as one source; weights repeat in that order. Texts of no words
    (null, empty) have size 0 and one copy. Repeated rows are rows of their own. Where ids repeat with one size, which
    of them gets a further copy makes no difference to the result. Empty table: no rows. Reruns agree: nothing
    depends on the order of rows or partitions. Columns ``keys`` come first in the result and tell apart rows of one
    id and size.
    """
    rows = saved(docs.select(*keys, F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")))
    per = saved(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights))
    # one row for each source; Spark decides by its size whether to broadcast it
    named = per.select(F.col("source").alias("__s"), "source_size", "target")
    rows = rows.join(named, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    rows = rows.withColumn("cls", F.when(F.col("size") > 0, F.floor(F.log2("size") * CLASSES_PER_OCTAVE)).cast("int")).withColumn("large", F.col("size") > LARGE_SHARE * F.col("source_size"))
    some = rows.where("size > 0")

    first = _tilts(some, per.select("source", F.col("target").alias("goal"))).select(F.col("source").alias("__s"), F.col("cls").alias("__c"), "rate")
    large = some.where("large").join(first, F.col("source").eqNullSafe(F.col("__s")) & (F.col("cls") == F.col("__c"))).drop("__s", "__c")
    # at most 500 rows a source, by the definition of large
    listed = large.groupBy("source", "source_size", "target").agg(F.sort_array(F.collect_list(F.struct("size", "doc_id", *keys, "rate")), asc=False).alias("h"))

    def carry(s: Column, c: Column) -> Column:
        want = c["size"] * c["rate"] + s["owed"]
        k = F.least(F.lit(MOST_COPIES), F.greatest(F.lit(0), F.round(want / c["size"]).cast("int")))
        return F.struct((want - k * c["size"]).alias("owed"), F.concat(s["k"], F.array(k)).alias("k"))

    listed = listed.withColumn("k", F.aggregate("h", F.struct(F.lit(0.0).alias("owed"), F.array().cast("array<int>").alias("k")), carry)["k"])
    placed = saved(listed.select("source", "source_size", "target", F.explode(F.arrays_zip("h", "k")).alias("z")).select(*(F.col(f"z.h.{c}").alias(c) for c in keys), F.col("z.h.doc_id").alias("doc_id"), "source", F.col("z.h.size").alias("size"), "source_size", "target", F.col("z.k").cast("long").alias("copies")))

    taken = placed.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("got")).withColumnRenamed("source", "__s")
    goal = per.join(taken, F.col("source").eqNullSafe(F.col("__s")), "left").select("source", F.greatest(F.lit(0.0), F.col("target") - F.coalesce("got", F.lit(0))).alias("goal"))
    rest = some.where("not large")
    cells = saved(_tilts(rest, goal))
    cells = cells.withColumn("parts", F.ceil(F.col("n") / CELL_ROWS).cast("int")).withColumn("fraction", F.col("rate") - F.floor("rate"))
    named = cells.select(F.col("source").alias("__s"), F.col("cls").alias("__c"), "rate", "fraction", "parts")
    rest = rest.join(named, F.col("source").eqNullSafe(F.col("__s")) & (F.col("cls") == F.col("__c"))).drop("__s", "__c")
    rest = rest.withColumn("mixed", F.xxhash64(F.col("doc_id").cast("string"), "size", *keys)).withColumn("part", F.pmod("mixed", F.col("parts")).cast("int"))
    counts = rest.groupBy("source", "cls", "part").agg(F.count("*").alias("n"), F.first("fraction").alias("f"))
    order = W.partitionBy("source").orderBy(F.desc("cls"), "part").rowsBetween(W.unboundedPreceding, W.currentRow)
    counts = counts.select(F.col("source").alias("__s"), F.col("cls").alias("__c"), F.col("part").alias("__p"), (F.sum(F.col("n") * F.col("f")).over(order) - F.col("n") * F.col("f")).alias("before"))
    rest = rest.withColumn("k", F.row_number().over(W.partitionBy("source", "cls", "part").orderBy("mixed", "doc_id", *keys)))
    rest = rest.join(counts, F.col("source").eqNullSafe(F.col("__s")) & (F.col("cls") == F.col("__c")) & (F.col("part") == F.col("__p")))
    at = F.col("before") + F.col("k") * F.col("fraction")
    extra = F.floor(at + 0.5) - F.floor(at - F.col("fraction") + 0.5)
    rest = rest.select(*keys, "doc_id", "source", "size", "source_size", "target", F.least(F.lit(MOST_COPIES), F.floor("rate") + extra).cast("long").alias("copies"))
    void = rows.where("size = 0").select(*keys, "doc_id", "source", "size", "source_size", "target", F.lit(1).cast("long").alias("copies"))
    return placed.unionByName(rest).unionByName(void).withColumn("taken", F.col("copies") * F.col("size"))
