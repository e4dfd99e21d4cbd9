"""Column functions on text: normalisation, canonical forms, words, shingles, prompts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from corpusmill.functions import patterns as P, udfs


def _deleted(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def stripped(text: Column) -> Column:
    """Without white space at either end, of any Unicode kind."""
    return F.regexp_replace(text, rf"^{P.WHITE_SPACE}+|{P.WHITE_SPACE}+$", "")


def words(text: Column) -> Column:
    """Words between white space of any Unicode kind; of an empty text none."""
    return F.filter(F.split(text, rf"{P.WHITE_SPACE}+"), lambda w: w != "")


def spelling_unified(text: Column) -> Column:
    """Spoken variants of one word to its written form; clitics before it stay."""
    edge = r"[\p{L}\p{N}_]"
    return F.regexp_replace(text, rf"(?<!{edge})([{P.CLITICS}]*)({'|'.join(P.SPELLINGS)})(?!{edge})", rf"$1{P.SPELLING}")


def normalized(text: Column) -> Column:
    """NFC, then marks and controls deleted, letters unified, variants rewritten, blanks collapsed, ends stripped.

    In this order: U+0671 is a mark here and goes; ta marbuta becomes ha before variants are sought; U+0085 and
    U+001C-U+001F are controls and join their neighbours.
    """
    out = _deleted(_deleted(udfs.nfc(text), P.NORMAL_MARKS), P.CONTROLS)
    out = spelling_unified(F.translate(out, P.LETTERS_FROM, P.LETTERS_TO))
    return stripped(F.regexp_replace(out, P.ASCII_BLANKS, " "))


def without_marks(text: Column) -> Column:
    return _deleted(text, P.DEDUP_MARKS)


def canonical(text: Column) -> Column:
    """Without marks, words joined by single spaces: equal for exact duplicates."""
    return F.array_join(words(without_marks(text)), " ")


def lexicon_words(text: Column) -> Column:
    """Words after marks and signs are deleted (not turned into blanks)."""
    return words(_deleted(text, P.LEXICON_SIGNS))


def shingles(text: Column, n: int = P.NGRAM, fewest: int = P.FEWEST_WORDS) -> Column:
    """Distinct word n-grams in order; none for texts of fewer than ``fewest`` words."""

    def of(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) >= max(fewest, n), F.array_distinct(each)).otherwise(F.array().cast("array<string>"))

    # the words are bound to a variable, else every n-gram would split the text anew
    return F.element_at(F.transform(F.array(words(text)), of), 1)


def has_drift(text: Column, pattern: str = P.DRIFT) -> Column:
    """Whether a word of another dialect stands in the text, marks aside."""
    return F.coalesce(without_marks(text).rlike(pattern), F.lit(False))


def is_multi_speaker(*demographics: Column) -> Column:
    """Whether any demographic column holds the marker of several speakers."""
    return F.coalesce(F.lit(P.MULTI_SPEAKER).isin(*demographics), F.lit(False))


def is_target_dialect(dialect: Column, dialects: tuple[str, ...] = P.DIALECTS) -> Column:
    return F.coalesce(F.lower(stripped(dialect)).isin(*dialects), F.lit(False))


def is_clean(text: Column) -> Column:
    return ~F.coalesce(text.rlike(P.DIRTY), F.lit(False))


def is_char_fallback(token: Column) -> Column:
    """A token of one character that is neither white space nor a clitic."""
    return (F.length(token) == 1) & ~token.rlike(P.WHITE_SPACE) & ~token.isin(*P.CLITICS)


def is_holdout(index: Column, seed: int = P.HOLDOUT_SEED, fraction: float = P.HOLDOUT) -> Column:
    """Whether a line of this number belongs to the held-out share."""
    return udfs.blake2b_bucket(F.concat_ws(":", F.lit(str(seed)), index.cast("string")), 10_000) < int(fraction * 10_000)


def is_holdout_md5(key: Column, seed: int = P.HOLDOUT_SEED, fraction: float = P.HOLDOUT) -> Column:
    """The same share by MD5, which Spark and SQL engines have built in."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"))), 1, 8)
    return F.conv(digits, 16, 10).cast("long") % 10_000 < int(fraction * 10_000)


def anchor(text: Column, age: Column, gender: Column, dialect: Column, multi: Column) -> Column:
    """A row's identity for resuming: BLAKE2b of its fields, one to a line."""
    return udfs.blake2b_hex(F.concat_ws("\n", text, age, gender, dialect, F.when(multi, "True").otherwise("False")))


SYSTEM_PROMPT = """Reply in json. From what a speaker said, write an exchange that could really have taken place: the speaker's words first, then one answer. Both sides use the speaker's own Saudi dialect and say nothing that the words don't support.

The json object has exactly these fields, each a string: "user" (the speaker), "assistant" (the answer), "dialect" ("najdi" or "hijazi", whichever the speaker uses)."""


def user_prompt(text: Column, age: Column, gender: Column, dialect: Column, multi: Column) -> Column:
    """One field a line: who speaks, whether there are several, and what was said, which comes last."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\n"))
    return F.concat(line("gender", gender), line("age", age), line("dialect", dialect), line("speakers", F.when(multi, F.lit("several")).otherwise(F.lit("one"))), F.lit("said: "), text)


def request_body(user: Column, model: str, max_tokens: int, thinking: bool = False) -> Column:
    """The body of a chat completion as JSON."""
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.to_json(F.struct(
        F.lit(model).alias("model"), F.array(message("system", F.lit(SYSTEM_PROMPT)), message("user", user)).alias("messages"),
        F.struct(F.lit("json_object").alias("type")).alias("response_format"), F.lit(max_tokens).alias("max_tokens"),
        F.struct(F.lit("enabled" if thinking else "disabled").alias("type")).alias("thinking"),
    ))


def padded(ids: Column, length: int, pad: int = 0) -> Column:
    """The first ``length`` ids, filled up with ``pad``."""
    cut = F.slice(ids, 1, length)
    return F.concat(cut, F.array_repeat(F.lit(pad), F.lit(length) - F.size(cut)))


def ratio(a: Column, b: Column, scale: float = 1.0) -> Column:
    """scale * a / b as double; 0 where b is 0."""
    return F.when(b == 0, 0.0).otherwise(F.lit(scale) * a / b).cast("double")
