"""Personal data in texts, also where it is disguised, with offsets into the original text.

Plain identifiers are found by fixed patterns. Then transducers rewrite a text: lookalike and full-width characters
become ASCII, invisible characters go, "(at)" and "dot" become signs, spelled digits become figures. Each rewrite keeps
where its output came from, so a match in the rewritten text maps back to the source characters it was read from.
Matches that touch no rewritten place are those of the plain patterns and are not reported again.
"""

from __future__ import annotations

import functools
import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusmill.llm.common import short_batches

KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a digit run is taken whole by its first part, so a match never starts inside one
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: all of the local part's characters before an @, from the last match's end on."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def plain_spans(text: str) -> list[Span]:
    """(kind, start, end) of undisguised identifiers, by kind."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    if "." in text:
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


# Letters of other scripts that look like Latin ones, characters without width, digits in words.
_LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "ո": "n", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H",
    "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "α": "a", "ο": "o", "ν": "v", "ρ": "p",
    "ι": "i", "κ": "k", "Α": "A", "Β": "B", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Χ": "X", "Ζ": "Z", "ı": "i", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "․": ".", "。": ".", " ": " ",
}
_INVISIBLE = "­​‌‍‎‏⁠﻿"
_DIGIT_WORDS = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9", "oh": "0",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}


@functools.cache
def _folded_char(c: str) -> str:
    """What one character becomes: '' if invisible, an ASCII sign if it is a form of one, else itself."""
    if c in _INVISIBLE:
        return ""
    if c in _LOOKALIKES:
        return _LOOKALIKES[c]
    if (d := unicodedata.decimal(c, None)) is not None:
        return str(int(d))
    wide = unicodedata.normalize("NFKC", c)
    return wide if len(wide) == 1 and wide.isascii() and wide.isprintable() else c


_WORD = "|".join(sorted(_DIGIT_WORDS, key=len, reverse=True))
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_DOT = rf"(?:\.|\s*{_OPEN}\s*(?:dot|punkt|punto|point|\.)\s*{_CLOSE}\s*|\s+dot\s+)"
_AT = rf"(?:\s*{_OPEN}\s*(?:at|@)\s*{_CLOSE}\s*|\s+(?:at|@)\s+|@)"
_RUN = re.compile(rf"(?:(?:\+|\bplus\s)\s*)?(?<![\w+])(?:(?:{_WORD})\b|[0-9]{{1,19}}(?![0-9A-Za-z]))(?:(?:[\s,-]{{1,3}}|{_DOT})(?:(?:{_WORD})\b|[0-9]{{1,19}}(?![0-9A-Za-z])))+", re.I)
_ITEM = re.compile(rf"(?P<plus>\+|\bplus\b)|(?P<word>\b(?:{_WORD})\b)|(?P<figures>[0-9]+)|(?P<dot>{_DOT})|(?P<gap>[\s,-]+)", re.I)
_BRACKETED = re.compile(rf"{_OPEN}\s*(?:at|@|dot|punkt|punto|point|\.)\s*{_CLOSE}", re.I)
_BETWEEN = str.maketrans(",-.([{<>}])+", " " * 12)
# the local part is bounded on the left by what cannot belong to it; possessive, so that no start is tried twice
_MAIL = re.compile(rf"(?<![A-Za-z0-9._%+-])(?P<local>[A-Za-z0-9_%+-]++(?:(?:\.|\s*{_OPEN}\s*(?:dot|punkt|punto|point|\.)\s*{_CLOSE}\s*)[A-Za-z0-9_%+-]++)*+)(?P<at>{_AT})(?P<domain>[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++)", re.I)
_NUMERIC = re.compile(rf"(?<![0-9.])[0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}}(?![0-9])", re.I)
_DOTS = re.compile(_DOT, re.I)


class Rewritten:
    """A text with, for each of its characters, the source characters it stands for, and whether it was changed."""

    def __init__(self, text: str, start: np.ndarray, end: np.ndarray, changed: np.ndarray):
        self.text, self.start, self.end, self.changed = text, start, end, changed

    @classmethod
    def of(cls, text: str) -> Rewritten:
        """The first transducer, on characters: lookalikes folded, invisible ones dropped."""
        n = np.arange(len(text))
        if text.isascii():
            return cls(text, n, n + 1, np.zeros(len(text), bool))
        out = list(map(_folded_char, text))
        keep = np.fromiter((len(c) > 0 for c in out), bool, len(out))
        changed = np.fromiter((a != b for a, b in zip(out, text)), bool, len(out))
        # what follows something dropped counts as changed
        dropped = np.r_[False, ~keep[:-1]]
        return cls("".join(out), n[keep], n[keep] + 1, (changed | dropped)[keep])

    def replaced(self, edits: list[tuple[int, int, str]]) -> Rewritten:
        """A further transducer: disjoint (start, end, new) in ascending order; new is at most as long as the old."""
        if not edits:
            return self
        text, s, e, c, at = [], [], [], [], 0
        for a, b, new in edits:
            text += [self.text[at:a], new]
            s.append(self.start[at:a])
            e.append(self.end[at:a])
            c.append(self.changed[at:a])
            if new:
                s.append(np.full(len(new), self.start[a]))
                e.append(np.full(len(new), self.end[b - 1]))
                c.append(np.ones(len(new), bool))
            at = b
        text.append(self.text[at:])
        return Rewritten("".join(text), *(np.concatenate([*x, own[at:]]) for x, own in ((s, self.start), (e, self.end), (c, self.changed))))

    def source(self, start: int, end: int) -> tuple[int, int]:
        return int(self.start[start]), int(self.end[end - 1])


def _digit_edits(text: str) -> list[tuple[int, int, str]]:
    """Runs with three or more digits in words: words become figures, gaps go, "dot" becomes a dot."""
    edits = []
    for run in _RUN.finditer(text):
        items = list(_ITEM.finditer(run[0]))
        if sum(i.lastgroup == "word" for i in items) < 3:
            continue
        for k, i in enumerate(items):
            new = {"plus": "+", "word": _DIGIT_WORDS.get(i[0].lower(), ""), "figures": i[0], "dot": ".", "gap": ""}[i.lastgroup]
            if new != i[0]:
                edits.append((run.start() + i.start(), run.start() + i.end(), new))
    return edits


def _dots_before(text: str, at: int, done: int) -> Iterator[tuple[int, int, str]]:
    """Each bare " dot " between the words, after ``done``, that lead up to ``at``."""
    while True:
        end = at
        while end > done and text[end - 1].isspace():
            end -= 1
        begin = end - 3
        while begin > done and text[begin - 1].isspace():
            begin -= 1
        if end == at or begin <= done or begin == end - 3 or text[end - 3 : end].lower() != "dot" or text[begin - 1] not in _LOCAL or text[begin - 1] == ".":
            return
        yield begin, at, "."
        at = begin
        while at > done and text[at - 1] in _LOCAL:
            at -= 1


def _sign_edits(text: str) -> list[tuple[int, int, str]]:
    """at and dot in words where an address results; a bare " at " only beside a spelled or bracketed dot of the domain.

    The local part's bare " dot " counts where at and a dot of the domain are spelled or bracketed too. "notes at
    example.com" is as a rule no address, so a bare " at " before a plain domain stays.
    """
    edits, done = [], 0
    for m in _MAIL.finditer(text):
        at, dots = m["at"], [d for d in _DOTS.finditer(text, m.start("domain"), m.end("domain"))]
        if at == "@" and all(d[0] == "." for d in dots) and "." == "".join(set(x[0] for x in _DOTS.finditer(m["local"]))) and not re.search(_OPEN, m["local"]):
            continue
        if at.strip().lower() == "at" and all(d[0] == "." for d in dots):
            continue
        last = text[dots[-1].end() : m.end("domain")]
        if not 2 <= len(last) <= 24 or not last.isalpha():
            continue
        inner = [(d.start(), d.end(), ".") for d in _DOTS.finditer(text, m.start("local"), m.end("local"))]
        if at != "@" and any(d[0] != "." for d in dots):
            inner += _dots_before(text, m.start(), done)
        done = m.end()
        edits += [x for x in [*inner, (m.start("at"), m.end("at"), "@"), *((d.start(), d.end(), ".") for d in dots)] if text[x[0] : x[1]] != x[2]]
    for m in _NUMERIC.finditer(text):
        edits += [(d.start(), d.end(), ".") for d in _DOTS.finditer(text, m.start(), m.end()) if d[0] != "."]
    edits.sort()
    return [x for k, x in enumerate(edits) if not k or x[0] >= edits[k - 1][1]]


def _has_digit_words(low: str) -> bool:
    """Whether three digits in words may follow one another; without a regular expression, as all texts pass here."""
    words = low.translate(_BETWEEN).split() if low.isascii() else re.sub(r"[,\-.(\[{<>}\])+]", " ", low).split()
    if _DIGIT_WORDS.keys().isdisjoint(words):
        return False
    return b"\1\1\1" in bytes(w in _DIGIT_WORDS or w.isdigit() or w == "dot" for w in words)


def _has_signs(text: str, low: str) -> bool:
    """Whether at or dot may be written in words or brackets, or an @ stand between spaces."""
    return "dot" in low or " @" in text or "@ " in text or any(c in text for c in "[({<") and _BRACKETED.search(text) is not None


def disguised_spans(text: str, plain: list[Span]) -> list[Span]:
    """Identifiers that only the rewritten text shows, in source offsets; none overlaps a plain one of its kind."""
    odd = not text.isascii() and any(_folded_char(c) != c for c in set(text))
    low = text.lower()
    if not (odd or _has_digit_words(low) or _has_signs(text, low)):
        return []
    new = Rewritten.of(text)
    if _has_digit_words(new.text.lower()):
        new = new.replaced(_digit_edits(new.text))
    if _has_signs(new.text, new.text.lower()):
        new = new.replaced(_sign_edits(new.text))
    if not new.changed.any() and len(new.text) == len(text):
        return []
    out = []
    taken = {k: [(a, b) for kind, a, b in plain if kind == k] for k in KINDS}
    for kind, a, b in plain_spans(new.text):
        if new.changed[a:b].any():
            s, e = new.source(a, b)
            if not any(s < y and x < e for x, y in taken[kind]):
                out.append((kind, s, e))
                taken[kind].append((s, e))
    return out


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered(spans))


def redacted(text: str | None) -> str | None:
    """The text with each span, overlapping ones joined, replaced by its first kind in angle brackets."""
    if not text:
        return text
    plain = plain_spans(text)
    out, at, end = [], 0, -1
    for kind, a, b in ordered(plain + disguised_spans(text, plain)):
        if a >= end:
            out += [text[at:a], f"<{kind.upper()}>"]
        end = at = max(b, end)
    return "".join([*out, text[at:]])


def personal_data(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, plain and all spans as strings, and each kind's number among both.

    Null and empty texts have no spans; ids may be null or repeat; other columns are not carried.
    """
    short_batches(docs.sparkSession)
    names = [*(f"n_{k}" for k in KINDS), *(f"all_{k}" for k in KINDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, base, every = [], [], []
            for t in b.column(1).to_pylist():
                plain = plain_spans(t or "")
                both = plain + disguised_spans(t or "", plain)
                counts.append([sum(s[0] == k for s in spans) for spans in (plain, both) for k in KINDS])
                base.append(written(plain))
                every.append(written(both))
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(2 * len(KINDS))]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns, pa.array(base, pa.string()), pa.array(every, pa.string())], names=["doc_id", *names, "base", "spans"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {', '.join(f'{n} long' for n in names)}, base string, spans string")


def without_personal_data(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with its texts redacted and, where there is such a column, n_chars brought up to date."""
    short_batches(docs.sparkSession)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = pa.array([redacted(t) for t in b.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([new if i == at else c for i, c in enumerate(b.columns)], names=b.schema.names)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length(text).cast("long")) if "n_chars" in docs.columns else out


def sha256(column: str) -> F.Column:
    return F.sha2(F.col(column), 256)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
