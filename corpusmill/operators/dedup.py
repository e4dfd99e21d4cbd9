"""Drift, exact and near duplicates; the first of each in a given order stays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from corpusmill.functions import patterns as P, text as T, udfs
from corpusmill.plans.scratch import saved, spread


def exact_duplicates(df: DataFrame, *, text: str = "text", order: str = "seq") -> DataFrame:
    """``df`` with is_duplicate: an earlier row has the same canonical text. Rows of one ``order`` follow one another as written;
    a null text is never a duplicate, nor does it make one.

    Canonical texts are hashed once, into a written table. The first row of each is found by an aggregate over hashes and
    orders alone, which pre-aggregates hot texts; no group meets in one task.
    """
    keyed = saved(spread(df).withColumns({"__key": F.sha2(T.canonical(F.col(text)), 256), "__row": F.monotonically_increasing_id()}))
    place = F.struct(order, "__row")
    first = keyed.where("__key is not null").groupBy("__key").agg(F.min(place).alias("__first"))
    marked = keyed.join(first, "__key", "left").withColumn("is_duplicate", F.coalesce(place > F.col("__first"), F.lit(False)))
    return marked.select(*df.columns, "is_duplicate")


def is_seen(df: DataFrame, seen: DataFrame, *, text: str = "text") -> DataFrame:
    """Rows of ``df`` whose canonical text is among column ``canonical`` of ``seen``."""
    return df.join(seen.select(F.col("canonical").alias("__seen")), T.canonical(F.col(text)) == F.col("__seen"), "left_semi")


def shingled(df: DataFrame, *, text: str = "text", order: str = "seq", ngram: int = P.NGRAM, fewest: int = P.FEWEST_WORDS) -> DataFrame:
    """(order, n, hashes): the number and the hashes of each row's distinct shingles, rows without any left out."""
    s = T.shingles(T.canonical(F.col(text)), ngram, fewest)
    return spread(df.select(order, text)).select(F.col(order), F.array_sort(F.array_distinct(F.transform(s, lambda x: F.xxhash64(x)))).alias("hashes")).where(F.size("hashes") > 0).withColumn("n", F.size("hashes"))


def near_pairs(sets: DataFrame, *, threshold: float = P.JACCARD, order: str = "seq") -> DataFrame:
    """Pairs (a < b, jaccard) of rows of ``shingled`` whose Jaccard similarity is ``threshold`` or more: all of them.

    Similar sets share one of their rarest n - ceil(t n) + 1 elements and have sizes within the threshold of each other, so
    only these elements are joined; frequent ones stay out of the join. Candidates are then compared exactly.
    """
    each = sets.select(F.col(order).alias("id"), "n", F.explode("hashes").alias("h"))
    rare = each.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    # elements of one row only can join nothing; they come first in the order of rarity and take their places
    ranked = each.join(rare, "h", "left").withColumn("df", F.coalesce("df", F.lit(1)))
    places = F.col("n") - F.ceil(F.col("n") * F.lit(threshold)) + 1
    ranked = ranked.withColumn("k", F.row_number().over(W.partitionBy("id").orderBy("df", "h"))).where((F.col("k") <= places) & (F.col("df") > 1)).select("id", "n", "h")
    a, b = (ranked.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), "h") for x in "ab")
    fits = (F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * threshold) & (F.col("a") < F.col("b"))
    met = a.join(b, "h").where(fits).select("a", "b").distinct()
    left, right = (sets.select(F.col(order).alias(x), F.col("hashes").alias(f"s_{x}")) for x in "ab")
    both = met.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("s_a", "s_b"))
    return both.withColumn("jaccard", shared / (F.size("s_a") + F.size("s_b") - shared)).where(F.col("jaccard") >= threshold).select("a", "b", "jaccard")


def min_hashes(df: DataFrame, rows: int = P.LSH_ROWS, *, text: str = "text", order: str = "seq") -> DataFrame:
    """(order, signature): of each text that has shingles, the least keyed BLAKE2b digest of its shingles for ``rows`` keys."""
    # written first: Spark 4.1 doesn't take a UDF out of a projection if its argument holds a lambda function
    canonical = saved(spread(df.select(order, text)).select(order, T.canonical(F.col(text)).alias("__text")))
    enough = canonical.where(F.size(T.words(F.col("__text"))) >= P.FEWEST_WORDS)
    return enough.select(order, udfs.min_hashes(F.col("__text"), rows, P.NGRAM).alias("signature"))


def greedy(nodes: DataFrame, pairs: DataFrame, *, order: str = "seq") -> DataFrame:
    """The nodes that stay if each is dropped that is near an earlier one that stays.

    Rounds over the undecided, until there are none: each round decides at least the least of them.
    """
    left = saved(pairs.select("a", "b"))
    dropped = None
    while not left.isEmpty():
        # a node without an earlier neighbour stays; what is near it goes
        later = left.select("b").distinct()
        stays = left.select("a").distinct().join(later, F.col("a") == F.col("b"), "left_anti")
        gone = saved(left.join(stays, "a", "left_semi").select("b").distinct())
        dropped = gone if dropped is None else dropped.union(gone)
        out = gone.select(F.col("b").alias("x"))
        left = saved(left.join(out, F.col("b") == F.col("x"), "left_anti").join(out, F.col("a") == F.col("x"), "left_anti"))
    return nodes if dropped is None else nodes.join(dropped.select(F.col("b").alias(order)), order, "left_anti")


def dedupe(df: DataFrame, *, text: str = "text", order: str = "seq", threshold: float = P.JACCARD, ngram: int = P.NGRAM, fewest: int = P.FEWEST_WORDS, drift: str | None = P.DRIFT) -> DataFrame:
    """Rows without drift, exact and near duplicates of rows that stay, in order.

    Texts with the same set of shingles behave alike, so all but the first go before pairs are sought. Null texts stay.
    """
    if text not in df.columns or order not in df.columns:
        raise TypeError(f"dedupe needs the columns {text} and {order}")
    rows = df if drift is None else spread(df).where(~T.has_drift(F.col(text), drift))
    rows = saved(exact_duplicates(rows, text=text, order=order).where("not is_duplicate").drop("is_duplicate"))
    sets = saved(shingled(rows, text=text, order=order, ngram=ngram, fewest=fewest))
    same = sets.withColumn("__k", F.sha2(F.array_join("hashes", ","), 256))
    firsts = same.groupBy("__k").agg(F.min(order).alias(order))
    twins = same.join(firsts, order, "left_anti").select(order)
    sets = sets.join(firsts, order, "left_semi")
    return greedy(rows.join(twins, order, "left_anti"), near_pairs(sets, threshold=threshold, order=order), order=order)


def purge_counts(df: DataFrame, **options) -> DataFrame:
    """One row: total, drift, exact, near (as dropped in that order), purged (their sum) and kept."""
    order, text, drift = options.get("order", "seq"), options.get("text", "text"), options.get("drift", P.DRIFT)
    clean = df.where(~T.has_drift(F.col(text), drift)) if drift else df
    unique = exact_duplicates(clean, text=text, order=order).where("not is_duplicate")
    counts = [x.agg(F.count("*").alias(n)) for x, n in ((df, "total"), (clean, "c"), (unique, "u"), (dedupe(df, **options), "kept"))]
    one = counts[0].crossJoin(counts[1]).crossJoin(counts[2]).crossJoin(counts[3])  # four rows of one count each
    return one.select("total", (F.col("total") - F.col("c")).alias("drift"), (F.col("c") - F.col("u")).alias("exact"), (F.col("u") - F.col("kept")).alias("near"), (F.col("total") - F.col("kept")).alias("purged"), "kept")


__all__ = ["dedupe", "exact_duplicates", "greedy", "is_seen", "min_hashes", "near_pairs", "purge_counts", "shingled"]
