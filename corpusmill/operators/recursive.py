"""Recursive splitting of a text into overlapping chunks of bounded size."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F


def check_sizes(size: int, overlap: int) -> None:
    """Sizes that can't work are an error."""
    if size <= 0:
        raise ValueError(f"chunk size must be positive, not {size}")
    if not 0 <= overlap < size:
        raise ValueError(f"overlap must be at least 0 and below {size}, not {overlap}")


def _pieces(text: str, separator: str) -> list[str]:
    """The text cut before each separator, which stays at the head of what follows; no empty pieces."""
    if not separator:
        return list(text)
    head, *rest = text.split(separator)
    return [p for p in (head, *(separator + r for r in rest)) if p]


def _merge(pieces: list[str], size: int, overlap: int) -> list[str]:
    """Runs of pieces of at most `size` characters; each run begins with the end of the last one, up to `overlap`."""
    chunks: list[str] = []
    first = total = 0  # the run is pieces[first:i]

    def emit(end: int) -> None:
        if chunk := "".join(pieces[first:end]).strip():
            chunks.append(chunk)

    for i, piece in enumerate(pieces):
        if total + len(piece) > size and first < i:
            emit(i)
            while first < i and (total > overlap or total + len(piece) > size and total > 0):
                total -= len(pieces[first])
                first += 1
        total += len(piece)
    if first < len(pieces):
        emit(len(pieces))
    return chunks


def split_text(text: str, size: int, overlap: int, separators: list[str]) -> list[str]:
    """Chunks of a text.

    The first separator that occurs cuts it (the empty one always does); pieces below `size` are merged, longer ones are
    split with the separators that follow, or kept whole if none do.
    """
    at = next((i for i, s in enumerate(separators) if s == "" or s in text), len(separators) - 1)
    rest = separators[at + 1 :] if separators[at] else []
    chunks: list[str] = []
    short: list[str] = []
    for piece in _pieces(text, separators[at]):
        if len(piece) < size:
            short.append(piece)
            continue
        chunks += _merge(short, size, overlap)
        short = []
        chunks += split_text(piece, size, overlap, rest) if rest else [piece]
    return chunks + _merge(short, size, overlap)


SIZE, OVERLAP = 1000, 200


def split_column(text: Column, separators: Column, size: int | Column = SIZE, overlap: int = OVERLAP) -> Column:
    """T1 on columns: array of chunks; an empty array for null and for empty text. The size can differ from row to row."""
    if isinstance(size, int):
        check_sizes(size, overlap)

    @F.pandas_udf("array<string>")
    def chunks(texts: pd.Series, seps: pd.Series, sizes: pd.Series) -> pd.Series:
        return pd.Series([split_text(t, int(n), overlap, list(s)) if t else [] for t, s, n in zip(texts, seps, sizes, strict=True)])

    return chunks(text, separators, F.lit(size) if isinstance(size, int) else size)
