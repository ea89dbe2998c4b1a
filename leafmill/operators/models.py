"""External models behind a client: row to JSON, failures as rows, results stored before reuse.

No client reaches a network: ``FixtureClient`` answers from a table of
responses, and an application brings its own client for real calls.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.readers import holds_rows
from .tables import pending

RESULT = "status string, error string, response string, attempts int"


class ModelClient(Protocol):
    def complete(self, messages: str) -> str: ...


class FixtureClient:
    """Answers by the digest of the messages; unknown ones get the default, or fail without one."""

    def __init__(self, responses: dict[str, str] | None = None, default: str | None = None):
        self.responses, self.default = responses or {}, default

    @staticmethod
    def digest(messages: str) -> str:
        return hashlib.sha256(messages.encode()).hexdigest()

    def complete(self, messages: str) -> str:
        answer = self.responses.get(self.digest(messages), self.default)
        if answer is None:
            raise LookupError("no fixture for these messages")
        return answer


class EchoClient:
    """Answers with the messages themselves."""

    def complete(self, messages: str) -> str:
        return messages


class RateLimited(Exception):
    """The service asks to slow down."""


class Transient(Exception):
    """A failure of the service that may pass."""


# Attempts after a failure of each class, and the seconds between them.
RETRIES = {RateLimited: 60, Transient: 8}
PAUSE = 60.0


def failure_class(status: int | None, body: str = "") -> type[Exception] | None:
    """The class of a failed HTTP call, by the rules of text.is_rate_limit and text.is_transient."""
    if status == 429 or any(m in (body or "").lower() for m in T.RATE_LIMIT_MARKERS):
        return RateLimited
    return Transient if status in T.TRANSIENT_STATUS else None


def call(client: ModelClient, messages: str, retries: dict[type[Exception], int] = RETRIES, pause=time.sleep) -> tuple[str, str | None, str | None, int]:
    """(status, error, response, attempts); the answer must be JSON.

    The classes of failure count apart, each with its own number of further
    attempts; tokens are acquired before the first one only, by the caller.
    """
    left, attempts = dict(retries), 0
    while True:
        attempts += 1
        try:
            answer = client.complete(messages)
            json.loads(answer)
            return "ok", None, answer, attempts
        except Exception as e:  # noqa: BLE001  a bad row must not fail the job
            kind = next((k for k in left if isinstance(e, k)), None)
            if kind is None or left[kind] == 0:
                return "error", f"{type(e).__name__}: {e}", None, attempts
            left[kind] -= 1
            pause(PAUSE)


def call_model(work: DataFrame, client: ModelClient, key: str, messages: str = "messages", retries: dict[type[Exception], int] = RETRIES, pause=time.sleep) -> DataFrame:
    """(key, status, error, response, attempts) for each row of work."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [call(client, m, retries, pause) for m in pdf[messages]]
            yield pd.DataFrame({key: pdf[key], **dict(zip(("status", "error", "response", "attempts"), zip(*rows, strict=True), strict=True))} if rows else {c: [] for c in (key, "status", "error", "response", "attempts")})

    part = work.select(key, messages)
    schema = f"{part.schema[key].simpleString()}".replace(":", " ", 1) + ", " + RESULT
    return part.mapInPandas(run, schema)


def call_pending(work: DataFrame, client: ModelClient, key: str, path: str, **options) -> DataFrame:
    """Answers of all work: those stored at path, and new ones, which are stored first so no retry asks twice."""
    spark = work.sparkSession
    work_left = pending(work, spark.read.parquet(path).where("status = 'ok'"), key) if holds_rows(spark, path) else work
    call_model(work_left, client, key, **options).write.mode("append").parquet(path)
    return work.select(key).join(spark.read.parquet(path).dropDuplicates([key, "status"]), key, "left")


def messages(system: str, user: Column, images: Column | None = None) -> Column:
    """A chat request as JSON: a system text and a user text, with image parts where given."""
    text = F.struct(F.lit("user").alias("role"), user.alias("content"))
    if images is None:
        return F.to_json(F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")), text))
    part = "struct<type:string,text:string,image_url:struct<url:string>>"
    first = F.array(F.struct(F.lit("text").alias("type"), user.alias("text"), F.lit(None).cast("struct<url:string>").alias("image_url")).cast(part))
    rest = F.transform(images, lambda u: F.struct(F.lit("image_url").alias("type"), F.lit(None).cast("string").alias("text"), F.struct(u.alias("url")).alias("image_url")).cast(part))
    return F.to_json(F.struct(F.lit(system).alias("system"), F.concat(first, rest).alias("content")))


def message_text(parts: Column) -> Column:
    """The text parts of a message, a line each."""
    return F.array_join(F.transform(F.filter(parts, lambda p: p["type"] == "text"), lambda p: p["text"]), "\n")


def charged_calls(work: DataFrame, client: ModelClient, key: str, limits: Column, limit: int, reserved: Column, arrived: str, model: str = "model", messages: str = "messages", **options) -> DataFrame:
    """Calls behind the limiter: estimate, bucket, acquire once a call, call, log: (key, bucket, tokens, admitted, waited, status, error, response, attempts)."""
    from . import budget

    asked = work.withColumns({"bucket": budget.bucket_of(F.col(model), limits), "tokens": budget.text_tokens(F.col(messages)) + reserved})
    gate = budget.admit(asked, "bucket", arrived, "tokens", key, limit).select(F.col("ident").alias(key), "bucket", "admitted", "waited")
    told = call_model(work, client, key, messages, **options).join(asked.select(F.col(key).alias("_key"), "tokens"), F.col(key) == F.col("_key")).drop("_key")
    return gate.join(told, key)
