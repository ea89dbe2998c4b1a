"""Token budgets: estimates, buckets, trailing usage, admission in order of arrival."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import tokens

# Fixed values of the limiter.
WINDOW_SECONDS, RESERVE, LEAST_WAIT, SLACK = 60.0, 2048, 0.25, 0.05
BOUNDARY_TOKENS = 2


def reserve(*candidates: Column, default: int = RESERVE) -> Column:
    """The first candidate that is a whole number, else the default; never negative."""
    return F.greatest(F.lit(0), F.coalesce(*(c.cast("string").try_cast("int") for c in candidates), F.lit(default)))


def text_tokens(c: Column, chars: int = 4) -> Column:
    """A deterministic stand-in for a tokenizer: a token for every `chars` characters begun."""
    return F.ceil(F.length(F.coalesce(c, F.lit(""))) / chars).cast("long")


def estimates(messages: DataFrame, conv: str, text: str, order: str, chars: int = 4, reserved: int = RESERVE) -> DataFrame:
    """(conv, text_tokens, message_count, total_tokens) a conversation: each message's tokens, one for each join, and the reserve."""
    part = messages.groupBy(conv).agg(F.sum(text_tokens(F.col(text), chars)).alias("text_tokens"), F.count("*").alias("message_count"))
    return part.withColumn("total_tokens", F.greatest(F.lit(1).cast("long"), F.col("text_tokens") + F.col("message_count") - 1 + reserved))


def token_estimates(messages: DataFrame, conv: str, role: str, text: str, reserved: int = RESERVE, path: str = tokens.VOCABULARY) -> DataFrame:
    """(conv, text_tokens, message_count, total_tokens): tokens of a conversation's lines ``role: text`` joined by line feeds, and with the reserve.

    Messages are counted one by one and never joined: a line feed between two of
    them is one token of its own, since no word of the vocabulary's pattern
    holds a line feed and what follows it. A blank role is ``user``.
    """
    line = F.concat(T.or_default(F.col(role), "user"), F.lit(": "), F.coalesce(F.col(text), F.lit("")))
    counted = messages.select(conv, tokens.token_count(line, path).alias("_n"))
    part = counted.groupBy(conv).agg((F.sum("_n") + F.count("*") - 1).alias("text_tokens"), F.count("*").alias("message_count"))
    return part.withColumn("total_tokens", F.greatest(F.lit(1).cast("long"), F.col("text_tokens") + reserved))


def total(text: Column, image: Column, images: Column, reserved: Column) -> Column:
    return F.greatest(F.lit(1), text + image + images * BOUNDARY_TOKENS + reserved)


def bucket_of(model: Column, limits: Column) -> Column:
    """The model where limits name it; an error where they name others; default without limits."""
    known = F.map_contains_key(limits, model)
    wrong = F.raise_error(F.concat(F.lit("no limit for model "), model)).cast("string")
    return F.when(limits.isNull() | (F.size(limits) == 0), F.lit("default")).when(known, model).otherwise(wrong)


def trailing_usage(events: DataFrame, keys, ts: str, tokens: str, seconds: int, name: str = "used") -> DataFrame:
    """Tokens of the key in the closed window of `seconds` before each event, itself included.

    Time is cut into spans of one window, and an event counts in its own span
    and in the next, so a key with many events is many tasks.
    """
    width = seconds * 1_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    own = events.withColumns({"_t": micros, "_span": F.floor(micros / width), "_own": F.lit(True)})
    both = own.withColumn("_where", F.explode(F.array(F.struct(F.col("_span").alias("span"), F.lit(True).alias("own")), F.struct((F.col("_span") + 1).alias("span"), F.lit(False).alias("own")))))
    w = Window.partitionBy(*keys, "_where.span").orderBy("_t").rangeBetween(-width, 0)
    return both.withColumn(name, F.sum(tokens).over(w)).where("_where.own").drop("_t", "_span", "_own", "_where")


def usage(reservations: DataFrame) -> DataFrame:
    """(bucket, used, oldest)."""
    return reservations.groupBy("bucket").agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("used"), F.min("ts").alias("oldest"))


class Limiter:
    """Admits requests of one bucket in order; each waits until its tokens fit the trailing window.

    shared keeps a reservation that is exactly one window old, the in-process
    form drops it.
    """

    def __init__(self, limit: int, shared: bool = False, held=()):
        if limit <= 0:
            raise ValueError("the limit must be positive")
        self.limit, self.shared = limit, shared
        self.held: deque[tuple[float, int]] = deque(held)
        self.used = sum(n for _, n in self.held)

    def evict(self, now: float) -> None:
        while self.held and (now - self.held[0][0] > WINDOW_SECONDS or (not self.shared and now - self.held[0][0] == WINDOW_SECONDS)):
            self.used -= self.held.popleft()[1]

    def acquire(self, now: float, tokens: int) -> tuple[float, float, int]:
        """(admitted at, seconds waited, tokens reserved)."""
        asked = max(1, min(int(tokens), self.limit))
        start = now
        self.evict(now)
        while self.used + asked > self.limit:
            now = round(now + max(LEAST_WAIT, WINDOW_SECONDS - (now - self.held[0][0]) + SLACK), 6)
            self.evict(now)
        self.held.append((now, asked))
        self.used += asked
        return now, round(now - start, 6), asked


def admit(requests: DataFrame, bucket: str, ts: str, tokens: str, ident: str, limit: int, shared: bool = False) -> DataFrame:
    """(bucket, ident, arrived, admitted, waited, reserved): each bucket's requests in order of arrival.

    A request is considered when the one before it is admitted, so a bucket is
    folded in order by one task; buckets are models, not rows. Spark sorts them
    (on disk where they are many), and the fold takes them batch by batch, so
    its memory follows a batch and the requests of one window.
    """
    rows = requests.select(F.col(bucket).cast("string").alias("bucket"), F.col(ident).alias("ident"), (F.unix_micros(F.col(ts)) / 1e6).alias("arrived"), F.col(tokens).cast("long").alias("tokens"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, gate, clock = None, None, 0.0
        for batch in batches:
            names, arrivals, sizes = (batch.column(c).to_pylist() for c in ("bucket", "arrived", "tokens"))
            at, waited, reserved = [], [], []
            for b, t, n in zip(names, arrivals, sizes, strict=True):
                if gate is None or b != now:
                    now, gate, clock = b, Limiter(limit, shared), 0.0
                # A request without a time comes last, at the bucket's clock.
                clock, _, got = gate.acquire(clock if t is None else max(clock, t), n)
                at.append(clock)
                waited.append(None if t is None else round(clock - t, 6))
                reserved.append(got)
            made = [batch.column("bucket"), batch.column("ident"), batch.column("arrived"), pa.array(at, pa.float64()), pa.array(waited, pa.float64()), pa.array(reserved, pa.int64())]
            yield pa.RecordBatch.from_arrays(made, ["bucket", "ident", "arrived", "admitted", "waited", "reserved"])

    order = [F.col("bucket"), *(F.col(c).asc_nulls_last() for c in ("arrived", "ident", "tokens"))]
    kind = rows.schema["ident"].dataType.simpleString()
    return rows.repartition("bucket").sortWithinPartitions(*order).mapInArrow(fold, f"bucket string, ident {kind}, arrived double, admitted double, waited double, reserved long")
