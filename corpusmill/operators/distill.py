"""Turning rows into dialogues through a completion service behind a transport callable."""

from __future__ import annotations

import json
import os
import random
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, fields

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusmill.functions import patterns as P, text as T
from corpusmill.functions.udfs import dialogue_of, first_json_object
from corpusmill.operators import dedup, ingest, lexicon, resume
from corpusmill.plans.scratch import saved

#: (status, headers, body) of a request given as (url, headers, JSON body); raises OSError if the transport fails.
Transport = Callable[[str, dict[str, str], str], tuple[int, dict[str, str], str]]


class PaymentError(RuntimeError):
    """The service wants payment (402): the run ends; what is written stays and a later run goes on from there."""


class CompletionError(RuntimeError):
    """A row's completion can't be used."""


@dataclass(frozen=True)
class Config:
    api_key: str = ""
    base_url: str = "https://localhost"
    model: str = "chat"
    max_retries: int = 3
    concurrency: int = 8
    max_tokens: int = 1024
    thinking: bool = False
    backoff_seed: int = 0
    fail_fast: bool = False

    def __post_init__(self) -> None:
        if not 1 <= self.concurrency <= 16 or self.max_retries < 0 or self.max_tokens < 1:
            raise ValueError("concurrency must be 1 to 16, max_retries at least 0, max_tokens at least 1")

    @classmethod
    def from_env(cls, prefix: str = "DISTILL_") -> Config:
        kinds = {f.name: type(f.default) for f in fields(cls)}
        read = {n: os.environ[prefix + n.upper()] for n in kinds if prefix + n.upper() in os.environ}
        return cls(**{n: v.lower() in ("1", "true") if kinds[n] is bool else kinds[n](v) for n, v in read.items()})


def backoff(attempt: int, retry_after: str | None, rng: random.Random) -> float:
    """Seconds to wait, never zero: the header's if it is a positive number, else exponential up to 8 with jitter."""
    try:
        if retry_after is not None and (asked := float(retry_after)) > 0:
            return asked
    except ValueError:
        pass
    return min(2.0**attempt, 8.0) + 0.5 * rng.random()


def parse_dialogue(content: str) -> tuple[str, str, str]:
    """(user, assistant, dialect) of a completion, or CompletionError: three keys, non-empty turns, a target dialect."""
    found = first_json_object(content)
    if found is None:
        raise CompletionError("no balanced JSON object")
    try:
        return dialogue_of(found)
    except ValueError as e:
        raise CompletionError(str(e)) from None


def complete(body: str, config: Config, transport: Transport, sleep: Callable[[float], None] = time.sleep) -> tuple[str, str, str]:
    """One row's dialogue. Transport failures, 5xx, broken envelopes and blank contents are retried with backoff; 429 waits
    as asked; 402 ends the run; other 4xx and unusable contents fail at once."""
    rng, last = random.Random(config.backoff_seed), None
    headers = {"Authorization": f"Bearer {config.api_key}", "Content-Type": "application/json"}
    for attempt in range(config.max_retries + 1):
        asked = None
        try:
            status, got, text = transport(f"{config.base_url}/chat/completions", headers, body)
        except OSError as e:
            last = e
        else:
            if status == 402:
                raise PaymentError("the completion service asks for payment (402)")
            if status == 429:
                asked = {k.lower(): v for k, v in got.items()}.get("retry-after")
            elif status >= 500:
                last = CompletionError(f"status {status}")
            elif status >= 400:
                raise CompletionError(f"status {status}")
            else:
                try:
                    content = json.loads(text)["choices"][0]["message"]["content"]
                except (KeyError, ValueError) as e:
                    last = e
                else:
                    if content.strip():
                        return parse_dialogue(content)
        sleep(backoff(attempt, asked, rng))
    raise last or CompletionError("no usable completion within the retries")


def requests(rows: DataFrame, config: Config, *, order: str = "seq") -> DataFrame:
    """(order, body): the request of each row."""
    user = T.user_prompt(*(F.col(c) for c in ("text", *P.DEMOGRAPHICS, "is_multi_speaker")))
    return rows.select(F.col(order).cast("long").alias(order), T.request_body(user, config.model, config.max_tokens, config.thinking).alias("body"))


def distill(rows: DataFrame, config: Config, transport: Transport, *, order: str = "seq", sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(order, user, assistant, dialect, error): each row's dialogue, or why it has none.

    Each partition keeps at most ``concurrency`` requests in flight. Payment errors, and with ``fail_fast`` all, fail the job.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(body: str) -> tuple[str | None, str | None, str | None, str | None]:
            try:
                return (*complete(body, config, transport, sleep), None)
            except Exception as e:
                if config.fail_fast or isinstance(e, PaymentError):
                    raise
                return None, None, None, f"{type(e).__name__}: {e}"

        with ThreadPoolExecutor(config.concurrency) as pool:
            for b in batches:
                found = list(pool.map(one, b.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([f[i] for f in found], pa.string()) for i in range(4))], names=[order, "user", "assistant", "dialect", "error"])

    return requests(rows, config, order=order).mapInArrow(run, f"{order} long, user string, assistant string, dialect string, error string")


def summary(outcomes: DataFrame, *, order: str = "seq") -> DataFrame:
    """One row: total, succeeded, failed, and the rows and messages of both as arrays in order."""
    done = F.col("error").isNull()
    return outcomes.agg(
        F.count("*").alias("total"), F.count_if(done).alias("succeeded"), F.count_if(~done).alias("failed"),
        F.array_sort(F.collect_list(F.when(done, F.col(order)))).alias("succeeded_indices"),
        F.transform(F.array_sort(F.collect_list(F.when(~done, F.struct(order, "error")))), lambda s: F.concat(F.lit("row "), s[order].cast("string"), F.lit(": "), s["error"])).alias("error_samples"),
    )


def canned(url: str, headers: dict[str, str], body: str) -> tuple[int, dict[str, str], str]:
    """A transport without a network: the anchor's words come back as a dialogue, always alike."""
    prompt = json.loads(body)["messages"][1]["content"]
    anchor = prompt.split("said: ", 1)[-1]
    dialect = "hijazi" if "dialect: Hijazi" in prompt else "najdi"
    content = json.dumps({"user": anchor, "assistant": f"{anchor} طيب", "dialect": dialect}, ensure_ascii=False)
    return 200, {}, json.dumps({"choices": [{"message": {"content": content}}]})


@dataclass
class Completed:
    """``outcomes`` of all requests, the rows that ``succeeded`` with their columns, the ``dialogues`` that stay and their text."""

    outcomes: DataFrame
    succeeded: DataFrame
    dialogues: DataFrame


def completed(todo: DataFrame, config: Config, transport: Transport, *, earlier: DataFrame | None = None) -> Completed:
    """Requests for numbered rows (``seq``), each sent once, and the dialogues without drift, exact and near duplicates.

    ``earlier`` dialogues (user, assistant, dialect) count as seen.
    """
    todo = saved(todo)
    outcomes = saved(distill(todo, config, transport))
    # outcomes go back to their rows by number
    succeeded = todo.join(outcomes.where("error is null").select("seq"), "seq", "left_semi")
    pair = F.concat_ws(" ", "user", "assistant")
    good = outcomes.where("error is null").withColumn("text", pair)
    if earlier is not None:
        good = good.join(earlier.select(T.canonical(pair).alias("__seen")).distinct(), T.canonical(F.col("text")) == F.col("__seen"), "left_anti")
    return Completed(outcomes, succeeded, saved(dedup.dedupe(good)))


@dataclass
class Result:
    """``dialogues`` that stay, ``outcomes`` of all requests, and ``flagged``: words that few speakers use."""

    dialogues: DataFrame
    outcomes: DataFrame
    flagged: DataFrame


def run(metadata: DataFrame, config: Config, transport: Transport, *, anchors: DataFrame | None = None, max_rows: int = 0, earlier: DataFrame | None = None) -> Result:
    """From numbered, validated metadata (``seq``) to deduplicated dialogues: route, resume, distil, purge, report.

    The cap of ``max_rows`` counts rows as routed, before those that were finished are left out. Word dispersion is that
    of all metadata, not only of what was routed.
    """
    routed = ingest.distillation_rows(ingest.tier_a(metadata, keep=("seq",)), max_rows=max_rows)
    done = completed(resume.todo(routed, anchors) if anchors is not None else routed, config, transport, earlier=earlier)
    return Result(done.dialogues.select("seq", "user", "assistant", "dialect"), done.outcomes, lexicon.report(done.dialogues, lexicon.dispersion(metadata)))
