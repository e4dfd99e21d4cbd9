"""Language identification by cross-parsing entropy.

Per language, a bounded sample of labelled text makes a suffix automaton. A text is cut, from left to right, into the
longest phrases that occur anywhere in a language's sample, over words' bounds as well as within them; the language that needs the
fewest phrases, normalised by what a phrase costs to point at in that much text, wins.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window as W, functions as F

from corpusmill.llm.common import in_training, short_batches

#: Characters of labelled text that are learnt per language, in stretches from hashed places of documents.
SAMPLE_CHARS, STRETCH_CHARS = 24_000, 1_000
#: The number of languages up to which their totals are broadcast.
BROADCAST_LANGUAGES = 10_000
#: Bits of difference in description length that make the likelier language e times as likely.
BITS_PER_NAT = 12.0
UNDETERMINED = "und"
#: Stands between the stretches of a sample; no text holds it once it is reduced to words.
_BREAK = "\n"
_WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def reduced(text: str | None) -> str:
    """A text's words, which are letters and their marks, in lower case between single spaces; without letters: ''."""
    words = _WORDS.findall((text or "").lower())
    return f" {' '.join(words)} " if words else ""


class SuffixAutomaton:
    """All substrings of a text; a state is a dictionary from a character to the next state."""

    def __init__(self, text: str):
        steps: list[dict] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            cur = len(steps)
            steps.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in steps[p]:
                steps[p][c] = cur
                p = link[p]
            if p >= 0:
                q = steps[p][c]
                if length[q] == length[p] + 1:
                    link[cur] = q
                else:
                    clone = len(steps)
                    steps.append(dict(steps[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and steps[p].get(c) == q:
                        steps[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        # states by themselves instead of by number: one look-up a character
        for s in steps:
            for c, i in s.items():
                s[c] = steps[i]
        self.root, self.size = steps[0], len(text) + 1

    def phrases(self, text: str) -> int:
        """Number of phrases of the greedy parse; a character that the text lacks is one more than its own phrase."""
        root, nothing = self.root, {}
        count, at = 0, nothing
        for c in text:
            at = at.get(c)
            if at is None:
                count += 1
                at = root.get(c)
                if at is None:
                    count, at = count + 1, nothing
        return count


class Identifier:
    """The automata of all languages."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        self.automata = [SuffixAutomaton(samples[x]) for x in self.languages]
        self.bits = np.array([math.log2(a.size) for a in self.automata])

    def predict(self, text: str | None) -> tuple[str, float]:
        words = reduced(text)
        if not words or not self.languages:
            return UNDETERMINED, 0.0
        total = np.array([a.phrases(words) for a in self.automata]) * self.bits
        best = int(total.argmin())
        score = 1.0 / np.exp(np.minimum(0.0, (total[best] - total) / BITS_PER_NAT)).sum()
        return self.languages[best], float(score)


def sample(docs: DataFrame, *, chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """At most ``chars`` characters per language that has any text, from rows (doc_id, text, lang), and a stretch more.

    The share of each language that is drawn follows from its total, so that only a few times ``chars`` are ordered. The
    driver and every worker hold the samples: their number is that of the languages.
    """
    h = F.xxhash64(F.col("doc_id").cast("string"), "text")
    rows = docs.where("lang is not null and text is not null").select("lang", h.alias("h"), "text")
    place = F.pmod(F.shiftright("h", 20), F.greatest(F.length("text") - STRETCH_CHARS, F.lit(0)) + 1) + 1
    rows = rows.select("lang", "h", F.substring("text", place, F.lit(STRETCH_CHARS)).alias("text"))
    total = rows.groupBy("lang").agg(F.sum(F.length("text")).alias("total")).where("total > 0")
    # a row per language; as long as they are few it is broadcast, so that only what is drawn is shuffled by language
    few = total.count() <= BROADCAST_LANGUAGES
    drawn = rows.join(F.broadcast(total) if few else total, "lang").where(F.pmod("h", F.lit(1 << 20)) < 4.0 * (chars + 20 * STRETCH_CHARS) / F.col("total") * (1 << 20))
    before = F.sum(F.length("text")).over(W.partitionBy("lang").orderBy("h", "text").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.length("text")
    found: dict[str, list[str]] = {}
    for r in drawn.withColumn("before", before).where(F.col("before") < chars).select("lang", "text").collect():
        if words := reduced(r.text):
            found.setdefault(r.lang, []).append(words)
    return {lang: _BREAK.join(sorted(x)) for lang, x in found.items()}


@functools.lru_cache(maxsize=1)
def _identifier(packed: tuple[tuple[str, str], ...]) -> Identifier:
    """One per Python worker."""
    return Identifier(dict(packed))


def identify(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", modulus: int = 5, held: int = 0) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score (0 to 1).

    Learns from rows with a label and crc32(doc_id) mod ``modulus`` other than ``held``; predictions see the text alone.
    Null texts and texts without letters are ``und`` with score 0; so are all where no label can be learnt. Ties go
    to the first language by name. Repeated rows are predicted each. Empty table: no rows.
    """
    short_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    # bounded by SAMPLE_CHARS for each language
    shared = docs.sparkSession.sparkContext.broadcast(tuple(sorted(sample(rows.where(in_training("doc_id", modulus, held))).items())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _identifier(shared.value)
        for b in batches:
            found = [model.predict(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
    return out.select("doc_id", (~in_training("doc_id", modulus, held)).alias("held_out"), "lang_pred", "score")
