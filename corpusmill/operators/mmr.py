"""Search by maximal marginal relevance."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, types as T


def mmr_order(query: np.ndarray, vectors: np.ndarray, k: int, lam: float) -> list[int]:
    """Positions of k vectors: each next one has the greatest lam * likeness to the query - (1 - lam) * likeness to those picked."""
    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-300)

    vectors, near = unit(vectors), unit(vectors) @ unit(query)
    picked: list[int] = []
    closest = np.full(len(vectors), -np.inf)
    while len(picked) < min(k, len(vectors)):
        value = near if not picked else lam * near - (1 - lam) * closest
        value = np.where(np.isin(np.arange(len(vectors)), picked), -np.inf, value)
        best = int(np.argmax(value))
        picked.append(best)
        closest = np.maximum(closest, vectors @ vectors[best])
    return picked


def mmr_search(store: DataFrame, queries: DataFrame, k: int = 5, fetch_k: int = 20, lam: float = 0.5) -> DataFrame:
    """K4: query_id, rank, chunk_id, score (always 1.0) of k diverse rows among the fetch_k nearest.

    Only the fetch_k candidates of a query, at most, meet in one group.
    """
    from corpusmill.operators.search import similarity_search

    near = similarity_search(store, queries, fetch_k).select("query_id", "rank", "chunk_id")
    vectors = near.join(store.select("chunk_id", "embedding"), "chunk_id").join(queries.selectExpr("query_id", "embedding as wanted"), "query_id")
    kinds = [T.StructField("query_id", queries.schema["query_id"].dataType), T.StructField("rank", T.IntegerType()), T.StructField("chunk_id", store.schema["chunk_id"].dataType), T.StructField("score", T.DoubleType())]

    def pick(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rank", ignore_index=True)
        order = mmr_order(np.array(group["wanted"][0], np.float64), np.array(group["embedding"].tolist(), np.float64), k, lam)
        return pd.DataFrame({"query_id": group["query_id"][0], "rank": range(1, len(order) + 1), "chunk_id": group["chunk_id"][order].to_numpy(), "score": 1.0})

    return vectors.groupBy("query_id").applyInPandas(pick, T.StructType(kinds))
