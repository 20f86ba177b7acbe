"""Embedding of pending rows with any embedder, a batch at a time, with halving and retries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import hash_embedding

Embedder = Callable[[list[str]], list[list[float]]]


class TooLarge(Exception):
    """A request over the backend's size limit: it is halved."""


class Retryable(Exception):
    """A rate limit or a lost connection: the request is repeated later."""


#: What the messages of errors that pass, and of requests that are too large, say: all of one of the groups.
_PASSING = "429|rate limit|ratelimit|connectionerror|connection error|timeout|timed out|broken pipe|connection reset|remote disconnected|temporarily unavailable".split("|")
_LARGE = ("max_tokens_per_request", "max tokens per request", "requested tokens 300000")


def classified(error: Exception) -> Exception:
    """The error as ``Retryable`` or ``TooLarge`` where its type's name or its message says so, else as it is."""
    if isinstance(error, (Retryable, TooLarge)):
        return error
    said = f"{type(error).__name__} {error}".lower()
    if said.find(_LARGE[0]) >= 0 or said.find(_LARGE[1]) >= 0 or all(w in said for w in _LARGE[2].split()):
        return TooLarge(str(error))
    return Retryable(str(error)) if any(mark in said for mark in _PASSING) else error


def checked(embed: Embedder) -> Embedder:
    """An embedder whose errors are classified, so that any client's can be halved and retried."""

    def run(texts: list[str]) -> list[list[float]]:
        try:
            return embed(texts)
        except Exception as error:
            if (known := classified(error)) is error:
                raise
            raise known from error

    return run


def embed_batch(embed: Embedder, texts: list[str], depth: int = 12, tries: int = 5, wait: float = 1.0) -> list[list[float]]:
    """Embeds; halves a batch that is too large, down to single texts; backs off on errors that pass."""
    for attempt in range(tries):
        try:
            return embed(texts)
        except Retryable:
            if attempt == tries - 1:
                raise
            time.sleep(wait * 2**attempt)
        except TooLarge:
            if len(texts) < 2 or depth == 0:
                raise
            mid = len(texts) // 2
            return embed_batch(embed, texts[:mid], depth - 1, tries, wait) + embed_batch(embed, texts[mid:], depth - 1, tries, wait)
    raise AssertionError


def pending(chunks: DataFrame, embedded: DataFrame, identity: list[str]) -> DataFrame:
    """Chunks that have no embedding yet."""
    return chunks.join(embedded.select(*identity), identity, "left_anti")


def embed_rows(df: DataFrame, key: str, text: str, make: Callable[[], Embedder], batch: int = 500, wait: float = 1.0) -> DataFrame:
    """(key, embedding); ``make`` builds the embedder once per task. A lost task repeats only its own partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        embed = None
        for rows in batches:
            embed = embed or checked(make())
            texts = [t or "" for t in rows.column(1).to_pylist()]
            vectors = [v for lo in range(0, len(texts), batch) for v in embed_batch(embed, texts[lo : lo + batch], wait=wait)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(vectors, pa.list_(pa.float32()))], names=[key, "embedding"])

    kind = dict(df.dtypes)[key]
    return df.select(key, text).mapInArrow(run, f"{key} {kind}, embedding array<float>")


def embed_in_rounds(todo: DataFrame, key: str, text: str, make: Callable[[], Embedder], out: str, rounds: int, model: str, batch: int = 500) -> None:
    """Appends embeddings to ``out`` in rounds of rows with one hash: a run that stops loses its current round only.

    What earlier rounds or runs have written is left out by ``pending``, so the call may simply be repeated.
    """
    for r in range(rounds):
        part = todo.where(F.pmod(F.xxhash64(key), F.lit(rounds)) == r)
        embed_rows(part, key, text, make, batch).withColumn("model", F.lit(model)).write.mode("append").parquet(out)


def query_vector(text: str, make: Callable[[], Embedder], prefix: str = "") -> list[float]:
    """The vector of a query by any embedder; some models want a prefix before queries."""
    return embed_batch(checked(make()), [prefix + text])[0]


def hash_embedder(dimensions: int) -> Callable[[], Embedder]:
    """The deterministic embedder of drills and tests: no network."""
    return lambda: lambda texts: [hash_embedding(t, dimensions) for t in texts]
