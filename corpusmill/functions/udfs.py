"""Arrow UDFs for what Spark's built-in functions cannot express: NFC, BLAKE2, JSON extraction, a tokenizer's ids."""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F
from pyspark.sql.functions import arrow_udf

from corpusmill.functions import patterns as P

#: Bytes of text that are encoded at a time.
ENCODED_BYTES = 1 << 18


def _each(f, kind):
    """An Arrow UDF of one string column; null stays null."""

    @arrow_udf(kind)
    def run(v: pa.Array) -> pa.Array:
        return pa.array([None if x is None else f(x) for x in v.to_pylist()])

    return run


def nfc(text: Column) -> Column:
    """Canonical composition; ASCII text takes no detour through Python."""
    other = F.when(~text.rlike(r"^\p{ASCII}*$"), text)
    return F.coalesce(_each(lambda x: unicodedata.normalize("NFC", x), "string")(other), text)


def blake2b_hex(text: Column, size: int = 16) -> Column:
    return _each(lambda x: hashlib.blake2b(x.encode(), digest_size=size).hexdigest(), "string")(text)


def blake2b_bucket(text: Column, buckets: int) -> Column:
    """The 8-byte BLAKE2b digest, read as a big-endian number, modulo ``buckets``."""
    return _each(lambda x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "big") % buckets, "long")(text)


_FENCED = re.compile(r"```(?:json)?(.*)```", re.S | re.I)
#: A whole string, to its end or the text's, or a brace outside strings.
_MARKS = re.compile(r'"(?:[^"\\]++|\\.?+)*+(?:"|\Z)|[{}]', re.S)


def first_json_object(text: str) -> str | None:
    """The first balanced {...} of a text, within a code fence or not; strings may hold braces. None if there is none."""
    fenced = _FENCED.fullmatch(text.strip())
    text = (fenced[1] if fenced else text).strip()
    start, depth = text.find("{"), 0
    for m in _MARKS.finditer(text, start) if start >= 0 else ():
        depth += {"{": 1, "}": -1}.get(m[0], 0)
        if not depth:
            return text[start : m.end()]
    return None


def extract_json(text: Column) -> Column:
    """The first balanced object of a completion; null where there is none or it doesn't close."""
    return _each(first_json_object, "string")(text)


def dialogue_of(line: str) -> tuple[str, str, str]:
    """(user, assistant, dialect) of a JSON object with these keys only, or ValueError: non-empty turns, a target dialect."""
    pairs: list[tuple[str, object]] = []
    try:
        value = json.loads(line, object_pairs_hook=lambda found: pairs.extend(found) or dict(found))
    except ValueError:
        raise ValueError("malformed") from None
    if not isinstance(value, dict):
        raise ValueError("not an object")
    if extra := set(value) - {"user", "assistant", "dialect"}:
        raise ValueError(f"extra key {min(extra)}")
    if len(value) < 3:
        raise ValueError("missing key")
    if not all(isinstance(v, str) for v in value.values()):
        raise ValueError("not a string")
    if len(pairs) > 3:
        raise ValueError("repeated key")
    if not value["user"] or not value["assistant"]:
        raise ValueError("empty turn")
    dialect = value["dialect"].strip().lower()
    if dialect not in P.DIALECTS:
        raise ValueError(f"unknown dialect {dialect!r}")
    return value["user"], value["assistant"], dialect


def dialogue(line: Column) -> Column:
    """The struct (user, assistant, dialect, problem) of a JSON line; problem is null if it is a valid dialogue."""

    @arrow_udf("struct<user: string, assistant: string, dialect: string, problem: string>")
    def run(v: pa.Array) -> pa.Array:
        out = []
        for x in v.to_pylist():
            try:
                out.append((*dialogue_of(x), None))
            except ValueError as e:
                out.append((None, None, None, str(e)))
        names = ("user", "assistant", "dialect", "problem")
        return pa.StructArray.from_arrays([pa.array([o[i] for o in out], pa.string()) for i in range(4)], names=list(names))

    return run(line)


def min_hashes(canonical: Column, rows: int, n: int) -> Column:
    """Of the word ``n``-grams of a text whose words stand between single spaces, the least 8-byte BLAKE2b digest for each of ``rows`` keys, as 16 hexadecimal digits.

    Fixed values: keys are 0 to ``rows`` - 1 as 4 bytes, least first; digests are numbers, least byte first.
    """
    keys = [i.to_bytes(4, "little") for i in range(rows)]

    def least(raw: list[bytes], key: bytes) -> str:
        started = hashlib.blake2b(digest_size=8, key=key)

        def digest(w: bytes) -> bytes:
            own = started.copy()
            own.update(w)
            return own.digest()[::-1]

        return min(map(digest, raw)).hex()

    @arrow_udf("array<string>")
    def run(v: pa.Array) -> pa.Array:
        out = []
        for x in v.to_pylist():
            words = (x or "").encode().split(b" ")
            shingles = list({b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))})
            out.append([least(shingles, k) for k in keys])
        return pa.array(out, pa.list_(pa.string()))

    return run(canonical)


def _strict(x: str) -> bool:
    try:
        json.loads(x)
    except ValueError:
        return False
    return True


def is_json(text: Column) -> Column:
    return _each(_strict, "boolean")(text)


@functools.lru_cache(maxsize=2)
def _tokenizer(spec: str):
    from tokenizers import Tokenizer

    # a task has one core, and each thread would keep memory of its own
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_str(spec)


def ids_of(texts: pa.Array, spec: str) -> Iterator[list[list[int]]]:
    """Ids of texts, in portions: an encoding holds some hundred bytes a token until its ids are taken."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy()) // ENCODED_BYTES
    cuts = np.r_[0, np.flatnonzero(np.diff(size)) + 1, len(texts)] if len(texts) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield [e.ids for e in _tokenizer(spec).encode_batch_fast([x or "" for x in texts.slice(int(a), int(b - a)).to_pylist()], add_special_tokens=False)]


def encoded(text: Column, spec: str) -> Column:
    """Ids of a text by the tokenizer whose JSON is ``spec``, without special tokens."""

    @arrow_udf("array<int>")
    def run(v: pa.Array) -> pa.Array:
        parts = [pa.array(x, pa.list_(pa.int32())) for x in ids_of(v, spec)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return run(text)


def decoded(ids: Column, spec: str) -> Column:
    @arrow_udf("string")
    def run(v: pa.Array) -> pa.Array:
        return pa.array(_tokenizer(spec).decode_batch([x or [] for x in v.to_pylist()], skip_special_tokens=False), pa.string())

    return run(ids)


def word_errors(reference: Column, hypothesis: Column) -> Column:
    """Edit distance in words."""

    @arrow_udf("int")
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a.to_pylist(), b.to_pylist()):
            x, y = (x or "").split(), (y or "").split()
            row = list(range(len(y) + 1))
            for i, w in enumerate(x, 1):
                last, row[0] = row[0], i
                for j, u in enumerate(y, 1):
                    last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (w != u))
            out.append(row[-1])
        return pa.array(out, pa.int32())

    return run(reference, hypothesis)
