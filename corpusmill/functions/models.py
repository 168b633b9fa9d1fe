"""Models that a caller plugs in, and stand-ins for tests."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

#: Embedders by name: functions from a text column to an array<float> column.
EMBEDDERS: dict[str, Callable[[Column], Column]] = {}


def embedder(name: str):
    """Register an embedder under a name."""
    def put(function: Callable[[Column], Column]) -> Callable[[Column], Column]:
        EMBEDDERS[name] = function
        return function

    return put


@embedder("hashing")
def hashing_embedding(text: Column, size: int = 64) -> Column:
    """A unit vector of hashed words, for tests; a text without words has zeros."""
    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda t: _hashed(t or "", size))

    return embed(text)


def _hashed(text: str, size: int) -> list[float]:
    vector = np.zeros(size, np.float64)
    for word in text.lower().split():
        digest = hashlib.md5(word.encode()).digest()
        vector[digest[0] % size] += 1 if digest[1] % 2 else -1
    return (vector / max(1e-12, np.linalg.norm(vector))).astype(np.float32).tolist()


class BatchModel:
    """A caller's batch function from texts to vectors (or to anything of Spark's type `kind`) as a column function.

    guarded() is the same with errors as data: a struct of value and error. A batch that raises is taken again text by
    text, so an error stands at the texts that cause it.
    """

    def __init__(self, call: Callable[[pd.Series], pd.Series], kind: str = "array<float>"):
        self.call, self.kind = call, kind

    def __call__(self, text: Column) -> Column:
        @F.pandas_udf(self.kind)
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield self.call(batch)

        return run(text)

    def guarded(self, text: Column) -> Column:
        call = self.call

        def one(t: str | None) -> tuple:
            try:
                return call(pd.Series([t], dtype=object)).iloc[0], None
            except Exception as error:  # whatever a caller's model raises is this text's error
                return None, f"{type(error).__name__}: {error}"

        @F.pandas_udf(f"struct<value: {self.kind}, error: string>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                try:
                    found = [(v, None) for v in call(batch)]
                except Exception:
                    found = [one(t) for t in batch]
                yield pd.DataFrame(found, columns=["value", "error"])

        return run(text)


def text_model(call: Callable[[pd.Series], pd.Series]) -> Callable[[Column], Column]:
    """U4: a caller's batch function from texts to texts (classify, derive, compress, answer) as a column function."""
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield call(batch)

    return run
