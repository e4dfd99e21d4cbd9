"""Document fingerprints of closed syncmers, with DataFrame functions only.

A text's units are its words, words of more than 8 code points in pieces of 8, for all texts alike. Five marks stand before
the first unit and five after the last, so texts of few units have k-mers too. Of the k-mers of units, those count whose
least inner s-mer (by hash) is their first or their last: whether one does depends on nothing around it, so what two
texts share is chosen alike in both, wherever it stands. Such anchors are never more than k - s apart.

The fingerprint lists the anchors in text order, each with its distance from the one before; so it holds their offsets.
Two fingerprints are compared by the anchors that both have at the same distance from their predecessors, wherever they
stand, or by those that both have at the same offset from the start, whichever is more. The second also serves texts that
repeat themselves.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from corpusmill.llm.common import n_blocks, saved

K, S = 6, 2
UNIT = r"[^\x20\x09-\x0D]{1,8}"
#: Hexadecimal digits of an anchor: of its hash, and of its distance from the anchor before.
HASH_DIGITS, GAP_DIGITS = 9, 1
_BITS = 4 * (HASH_DIGITS + GAP_DIGITS)
_BEFORE, _AFTER = 1, 2


def with_syncmers(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with column ``name``: an array of anchors in text order; a text without units has none.

    An anchor is offset * 2^40 + hash * 16 + distance from the anchor before (of the first: its offset). Intermediate
    arrays are columns of their own, so that no hash is computed twice.
    """
    inner = K - S + 1
    marks = lambda m: F.array_repeat(F.lit(m).cast("bigint"), K - 1)
    units = F.regexp_extract_all(F.col(text), F.lit(f"({UNIT})"), 1)
    out = df.withColumn("__h", F.transform(units, lambda u: F.xxhash64(u)))
    out = out.withColumn("__h", F.when(F.size("__h") > 0, F.concat(marks(_BEFORE), "__h", marks(_AFTER))))
    out = out.withColumn("__s", F.transform(F.sequence(F.lit(1), F.size("__h") - (S - 1)), lambda i: F.xxhash64(*(F.element_at("__h", (i + j).cast("int")) for j in range(S)))))

    def closed(i: Column) -> Column:
        window = F.slice("__s", i, inner)
        least = F.array_min(window)
        return (F.element_at(window, 1) == least) | (F.element_at(window, inner) == least)

    out = out.withColumn("__at", F.filter(F.sequence(F.lit(1), F.size("__s") - (inner - 1)), closed))

    def anchor(at: Column, k: Column) -> Column:
        """A k-mer is known by the s-mers that tile it."""
        mer = F.xxhash64(*(F.element_at("__s", (at + j).cast("int")) for j in range(0, inner, S)))
        gap = at - F.when(k > 0, F.element_at("__at", k)).otherwise(1)
        low = F.shiftleft(mer.bitwiseAND(F.lit((1 << 4 * HASH_DIGITS) - 1)), 4 * GAP_DIGITS) + gap.cast("bigint")
        return F.shiftleft(at.cast("bigint"), _BITS).bitwiseOR(low)

    return out.withColumn(name, F.coalesce(F.transform("__at", anchor), F.array().cast("array<bigint>"))).drop("__h", "__s", "__at")


def _local(anchors: Column) -> Column:
    """The anchors without their offsets, as they are spelled."""
    return F.transform(anchors, lambda v: v.bitwiseAND(F.lit((1 << _BITS) - 1)))


def spelled(anchors: Column) -> Column:
    """The fingerprint as a string: for each anchor nine hexadecimal digits of its hash, and one of its distance."""
    return F.array_join(F.transform(_local(anchors), lambda v: F.lower(F.lpad(F.hex(v), _BITS // 4, "0"))), "")


def likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """``df`` with column ``name``, 0 to 1: shared anchors over those of the richer text. Two texts without anchors: 1.

    It follows from the two fingerprints as they are spelled: offsets are sums of distances.
    """
    out = df.withColumns({"__a": F.array_distinct(_local(F.col(a))), "__b": F.array_distinct(_local(F.col(b)))})
    anywhere = F.size(F.array_intersect("__a", "__b")) / F.greatest(F.size("__a"), F.size("__b"))
    in_place = F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.size(b))
    none = (F.size(a) == 0) & (F.size(b) == 0)
    return out.withColumn(name, F.when(none, 1.0).otherwise(F.greatest(anywhere, in_place)).cast("double")).drop("__a", "__b")


def with_next(docs: DataFrame, *, bucket_rows: int = 400) -> DataFrame:
    """Rows (doc_id, text, own) with next_text and next: the following row's by falling id; after the last comes the first.

    Rows of one id follow one another by the hash of their text; null ids come last, in the same way. Keys (id, hash) are
    range-partitioned into buckets of about ``bucket_rows`` rows, so neither a frequent id nor the nulls are one bucket; a
    text moves once, to its bucket, and of each bucket only the first row also goes to its predecessor.
    """
    parts = max(1, min(n_blocks(docs, 4 << 20), 1 + docs.count() // bucket_rows))
    # ~id falls as ids rise, without an overflow
    key = F.struct(F.isnull("doc_id").alias("last"), F.bitwise_not("doc_id").alias("id"), F.xxhash64("text").alias("h"))
    ranged = docs.select(key.alias("key")).repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id())
    # one row of numbers for each bucket, at most 2^20 by n_blocks: written, as ranges are sampled anew each time
    starts = saved(ranged.groupBy("part").agg(F.min("key").alias("low")))
    starts = starts.select("low", (F.row_number().over(W.orderBy("low"))).alias("b"), F.count("*").over(W.partitionBy(F.lit(1))).alias("n"))
    starts = starts.select("low", F.when(F.col("b") == 1, F.col("n")).otherwise(F.col("b") - 1).cast("int").alias("before"))
    lows = starts.agg(F.array_sort(F.collect_list("low")).alias("lows")).scalar()

    def halved(s: Column, _: Column) -> Column:
        """The greatest place whose key is not above the row's lies in [lo, hi]."""
        mid = F.ceil((s["lo"] + s["hi"]) / 2).cast("int")
        below = F.element_at("lows", mid) <= F.col("key")
        return F.struct(F.when(below, mid).otherwise(s["lo"]).alias("lo"), F.when(below, s["hi"]).otherwise(mid - 1).alias("hi"))

    steps = F.sequence(F.lit(1), F.lit(math.ceil(math.log2(parts + 1)) + 1))
    rows = docs.withColumn("key", key)
    bucket = F.aggregate(steps, F.struct(F.lit(1).alias("lo"), F.size("lows").alias("hi")), halved)["lo"]
    first = rows.join(F.broadcast(starts), F.col("key") == F.col("low")).groupBy("before").agg(F.min("text").alias("first_text"))
    first = with_syncmers(first, "first_text", "first_own")
    dealt = with_syncmers(rows.withColumn("lows", lows).withColumn("bucket", bucket).drop("lows"), "text", "own")
    w = W.partitionBy("bucket").orderBy("key", "text")
    dealt = dealt.withColumn("next_text", F.lead("text").over(w)).withColumn("next", F.lead("own").over(w))
    out = dealt.join(first, F.col("bucket") == F.col("before"), "left")
    last = F.col("next_text").isNull()
    return out.select("doc_id", "text", "own", F.when(last, F.col("first_text")).otherwise(F.col("next_text")).alias("next_text"), F.when(last, F.col("first_own")).otherwise(F.col("next")).alias("next"))


def fingerprinted(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text whose last floor(n/3) code points give way to the first as many (or all) of the next
    row's by falling id (nulls last, rows of one id by their text's hash; after the last comes the first). Null texts
    are empty; two texts without words are alike (1). Equal texts have equal fingerprints. Empty table: no rows.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = with_next(rows).withColumn("n_chars", F.length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - third), F.substring(F.col("next_text"), F.lit(1), third))
    rows = with_syncmers(rows.withColumn("edited", edited), "edited", "other")
    rows = likeness(likeness(rows, "own", "other", "near_edited"), "own", "next", "near_next")
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), spelled(F.col("own")).alias("fingerprint"), spelled(F.col("other")).alias("edited_fingerprint"), "near_edited", "near_next")
