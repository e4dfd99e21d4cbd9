"""How widely words are spread over speakers, and dialogues' words that few speakers use."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusmill.functions import patterns as P, text as T


def dispersion(df: DataFrame, *, text: str = "text", speaker: str = "audio", approximate: bool = False) -> DataFrame:
    """(token, n_speakers): distinct speakers of each word. ``approximate`` trades exactness for a sketch per word."""
    each = df.select(F.explode(F.array_distinct(T.lexicon_words(F.col(text)))).alias("token"), F.col(speaker).alias("s"))
    if approximate:
        return each.groupBy("token").agg(F.approx_count_distinct("s").alias("n_speakers"))
    # two steps: pairs first, so that a hot word's speakers are spread over tasks
    return each.where("s is not null").distinct().groupBy("token").agg(F.count("*").alias("n_speakers"))


def rare_words(dialogues: DataFrame, spread: DataFrame, *, key: str = "seq", text: str = "text", least: int = P.LEAST_SPEAKERS) -> DataFrame:
    """(key, position, token, n_speakers): each dialogue's distinct words below ``least`` speakers, in order of first use."""
    w = dialogues.select(key, F.posexplode(F.array_distinct(T.lexicon_words(F.col(text)))).alias("position", "token"))
    return w.join(spread, "token", "left").withColumn("n_speakers", F.coalesce("n_speakers", F.lit(0))).where(F.col("n_speakers") < least).select(key, "position", "token", "n_speakers")


def flagged(dialogues: DataFrame, spread: DataFrame, **options) -> DataFrame:
    """(key, tokens): the words above as one array a dialogue, in order."""
    key = options.get("key", "seq")
    rows = rare_words(dialogues, spread, **options).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("position", "token"))).alias("t"))
    return rows.select(key, F.col("t.token").alias("tokens"))


def report(dialogues: DataFrame, spread: DataFrame, **options) -> DataFrame:
    """(token, n): dialogues in which each word was flagged, most first."""
    return rare_words(dialogues, spread, **options).groupBy("token").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "token")
