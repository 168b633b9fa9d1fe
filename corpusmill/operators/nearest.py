"""Exact nearest neighbours: a scan for few queries, an exchange of blocks for many."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from corpusmill.functions.scratch import written

#: Queries (with each of their stores) that go to every task of a scan; more are exchanged with the store in blocks.
SCANNED = 2048
#: Rows of the store that are compared at once, rows of a block of the exchange.
ROWS, BLOCK = 2048, 16_384
#: Reference vectors of the exchange, and shells around each.
PIVOTS, SHELLS = 64, 8
#: The name under which all rows are, where no stores are told apart.
ALL = ""


class Nearest:
    """A bounded list of the nearest rows for each of some queries, over all batches that it is fed.

    A matrix product gives distances that are right but for rounding; what they leave within reach of a query's list, as
    found by a partition, is computed once more by differences, so that equal vectors are equally far and ties go to the smaller id.
    """

    def __init__(self, queries: np.ndarray, k: np.ndarray):
        self.queries, self.k = queries, k
        self.norms = (queries**2).sum(axis=1)
        self.worst = np.full(len(queries), np.inf)
        self.query, self.ids, self.distance = np.empty(0, np.int64), None, np.empty(0)

    def feed(self, ids: np.ndarray, vectors: np.ndarray, queries: np.ndarray | None = None) -> None:
        """Offer rows to all queries, or to those at the given positions."""
        at = np.arange(len(self.queries)) if queries is None else queries
        for start in range(0, len(ids), ROWS):
            self._some(ids[start : start + ROWS], vectors[start : start + ROWS], at)

    def _some(self, ids: np.ndarray, vectors: np.ndarray, at: np.ndarray) -> None:
        norms = (vectors**2).sum(axis=1)
        rough = norms[:, None] - 2 * (vectors @ self.queries[at].T) + self.norms[at]
        reach = self.worst[at]
        most = int(self.k[at].max())
        if len(ids) > most:
            reach = np.minimum(reach, np.partition(rough, most - 1, axis=0)[most - 1])
        slack = 1e-9 * (norms.max() + self.norms[at]) + 1e-300
        row, place = np.nonzero(rough <= reach + slack)
        query = at[place]
        distance = ((vectors[row] - self.queries[query]) ** 2).sum(axis=1)
        self._merge(query, ids[row], distance)

    def _merge(self, query: np.ndarray, ids: np.ndarray, distance: np.ndarray) -> None:
        touched = np.zeros(len(self.queries), bool)
        touched[query] = True
        old = touched[self.query]
        if self.ids is not None:
            query, ids, distance = (np.concatenate([x[old], y]) for x, y in ((self.query, query), (self.ids, ids), (self.distance, distance)))
        order = np.lexsort((ids, distance, query))
        query, ids, distance = query[order], ids[order], distance[order]
        first = np.searchsorted(query, query)
        rank = np.arange(len(query)) - first
        keep = rank < self.k[query]
        full = rank == self.k[query] - 1
        self.worst[query[full]] = distance[full]
        if self.ids is None:
            self.query, self.ids, self.distance = query[keep], ids[keep], distance[keep]
        else:
            self.query, self.ids, self.distance = (np.concatenate([x[~old], y[keep]]) for x, y in ((self.query, query), (self.ids, ids), (self.distance, distance)))


def matrix(vectors: pa.Array) -> np.ndarray:
    """A column of lists without nulls, all of one length, as rows of doubles."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def values(column: pa.Array) -> np.ndarray:
    """Ids as numbers or strings that NumPy can sort."""
    return np.array(column.to_pylist()) if pa.types.is_string(column.type) else column.to_numpy(zero_copy_only=False)


def nearest(store: DataFrame, queries: DataFrame, k: int, scope: DataFrame | None = None, groups: str = "store_keys", k_of: dict[str, int] | None = None, scanned: int = SCANNED) -> DataFrame:
    """query_id, store_key, chunk_id, distance (squared L2), rank from 1 of the k nearest, ties by chunk_id.

    store: chunk_id, embedding, and with a scope an array of the names under which a row is. scope: query_id, store_key; a query
    is compared with the rows of its stores alone, and has k rows for each of them; without one store_key is empty. k_of: another
    k for the stores named. Rows without a vector are never found, queries without one find nothing. Up to `scanned` queries (counted
    with their stores) go to all tasks of one scan of the store, each of which gives k rows a query; more meet the store in
    blocks, see exchanged().
    """
    wanted = queries.where("embedding is not null").select("query_id", "embedding")
    asked = wanted.withColumn("store_key", F.lit(ALL)) if scope is None else wanted.join(scope.select("query_id", "store_key").distinct(), "query_id").select("query_id", "embedding", "store_key")
    rows = store.where("embedding is not null").select("chunk_id", "embedding", (F.array(F.lit(ALL)) if scope is None else F.col(groups)).alias("groups"))
    few = asked.limit(scanned + 1).toArrow()
    found = scan(rows, few, asked.schema, k, k_of or {}) if few.num_rows <= scanned else exchanged(rows, asked, k, k_of or {})
    limit = F.lit(k)
    for name, other in (k_of or {}).items():
        limit = F.when(F.col("store_key") == name, F.lit(other)).otherwise(limit)
    rank = F.row_number().over(W.partitionBy("query_id", "store_key").orderBy("distance", "chunk_id"))
    most = max([k, *(k_of or {}).values()])
    return found.withColumn("rank", rank).where(F.col("rank") <= most).where(F.col("rank") <= limit)


def _result(query: T.DataType, chunk: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("query_id", query), T.StructField("store_key", T.StringType()), T.StructField("chunk_id", chunk), T.StructField("distance", T.DoubleType())])


def _found(top: Nearest, ids: np.ndarray, keys: np.ndarray, types: list[pa.DataType]) -> pa.RecordBatch:
    chunk = top.ids if top.ids is not None else []
    columns = [pa.array(ids[top.query].tolist(), types[0]), pa.array(keys[top.query].tolist(), pa.string()), pa.array(list(chunk), types[1]), pa.array(top.distance)]
    return pa.RecordBatch.from_arrays(columns, names=["query_id", "store_key", "chunk_id", "distance"])


def scan(rows: DataFrame, asked: pa.Table, schema: T.StructType, k: int, k_of: dict[str, int]) -> DataFrame:
    """The k nearest of each task: query_id, store_key, chunk_id, distance. asked: query_id, embedding, store_key, few rows.

    The stores of the queries are an index from a name to queries; a row is compared with the queries of its own names only.
    """
    shared = rows.sparkSession.sparkContext.broadcast(asked)
    types = [asked.schema.field("query_id").type, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value.combine_chunks()
        if not table.num_rows:
            return
        ids, keys = values(table.column("query_id").chunk(0)), np.array(table.column("store_key").to_pylist(), object)
        index = {key: np.flatnonzero(keys == key) for key in set(keys.tolist())}
        top = Nearest(matrix(table.column("embedding").chunk(0)), np.array([k_of.get(key, k) for key in keys.tolist()]))
        for batch in batches:
            types[1] = batch.schema.field("chunk_id").type
            chunk, vectors = values(batch.column(0)), None
            names = batch.column(2)
            row = np.repeat(np.arange(batch.num_rows), names.value_lengths().fill_null(0).to_numpy())
            listed = names.flatten().dictionary_encode()
            code = listed.indices.to_numpy(zero_copy_only=False)
            for c, name in enumerate(listed.dictionary.to_pylist()):
                if name in index:
                    vectors = matrix(batch.column(1)) if vectors is None else vectors
                    mine = row[code == c]
                    top.feed(chunk[mine], vectors[mine], index[name])
        if types[1] is not None:
            yield _found(top, ids, keys, types)

    return rows.mapInArrow(run, _result(schema["query_id"].dataType, rows.schema["chunk_id"].dataType))


def exchanged(rows: DataFrame, asked: DataFrame, k: int, k_of: dict[str, int], pivots: int = PIVOTS, shells: int = SHELLS, block: int = BLOCK) -> DataFrame:
    """As scan(), for any number of queries: neither queries nor rows pass through the driver or are gathered in one task.

    Every row of a store is in the cell of its nearest pivot and in a shell of that cell by its distance to it; a shell of
    many rows is cut into blocks. Counts and extremes of the shells tell a query how far its k-th neighbour is at most, and by
    the triangle inequality which shells can hold one of its neighbours. Queries go to the blocks of these shells, rows to their own block; there they are
    compared. rows: chunk_id, embedding, groups; asked: query_id, embedding, store_key.
    """
    spark = rows.sparkSession
    named = rows.select("chunk_id", "embedding", F.explode(F.array_distinct("groups")).alias("store_key")).join(asked.select("store_key").distinct(), "store_key", "left_semi")
    some = rows.select("embedding").limit(16 * pivots).toArrow()  # a fixed number of vectors, from the first files alone
    if not some.num_rows:
        return spark.createDataFrame([], _result(asked.schema["query_id"].dataType, rows.schema["chunk_id"].dataType))
    centres = _spread(matrix(some.combine_chunks().column("embedding").chunk(0)), pivots)
    width, reach = _width(centres, shells), float(np.sqrt((centres**2).sum(axis=1)).max())
    shared = spark.sparkContext.broadcast(centres)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distance = _distances(matrix(batch.column(1)), shared.value)
            cell = distance.argmin(axis=1)
            near = distance[np.arange(len(cell)), cell]
            shell = np.minimum(near / width, shells - 1).astype(np.int64)
            names = [*batch.schema.names, "cell", "shell", "near"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(shell), pa.array(near)], names=names)

    schema = T.StructType([*(named.schema[c] for c in ("chunk_id", "embedding", "store_key")), T.StructField("cell", T.LongType()), T.StructField("shell", T.LongType()), T.StructField("near", T.DoubleType())])
    placed = written(named.select("chunk_id", "embedding", "store_key").mapInArrow(place, schema))
    sums = placed.groupBy("store_key", "cell", "shell").agg(F.count("*").alias("n"), F.min("near").alias("lo"), F.max("near").alias("hi"))
    sized = sums.withColumn("parts", F.ceil(F.col("n") / block))
    listed = sized.groupBy("store_key").agg(F.collect_list(F.struct("cell", "shell", "n", "lo", "hi", "parts")).alias("shells"))  # pivots * shells at most

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column(1))
            apart = _distances(vectors, shared.value)
            slack = 1e-6 * (np.sqrt((vectors**2).sum(axis=1)) + reach)  # far more than rounding makes of a distance
            key, of = batch.column(2).to_pylist(), batch.column(3)
            for i in range(batch.num_rows):
                cell, shell, n, lo, hi, parts = (x.to_numpy(zero_copy_only=False) for x in of[i].values.flatten())
                d = apart[i, cell]
                order = np.argsort(d + hi)
                enough = np.searchsorted(np.cumsum(n[order]), k_of.get(key[i], k))
                most = (d + hi)[order[enough]] if enough < len(order) else np.inf
                least = np.maximum(np.maximum(d - hi, lo - d), 0)
                go = np.flatnonzero(least <= most + slack[i])
                times = parts[go].astype(np.int64)
                part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                own = batch.slice(i, 1).select([0, 1, 2]).take(pa.array(np.zeros(len(part), np.int64)))
                yield pa.RecordBatch.from_arrays([*own.columns, *(pa.array(np.repeat(x[go], times)) for x in (cell, shell)), pa.array(part)], names=[*own.schema.names, "cell", "shell", "part"])

    where = [T.StructField(c, T.LongType()) for c in ("cell", "shell", "part")]
    told = asked.join(listed, "store_key").select("query_id", "embedding", "store_key", "shells")
    visiting = told.mapInArrow(visit, T.StructType([*(asked.schema[c] for c in ("query_id", "embedding", "store_key")), *where]))
    dealt = placed.join(sized.select("store_key", "cell", "shell", "parts"), ["store_key", "cell", "shell"]).withColumn("part", F.pmod(F.xxhash64("chunk_id"), F.col("parts")))
    keys = ["store_key", "cell", "shell", "part"]
    no_query, no_chunk = F.lit(None).cast(asked.schema["query_id"].dataType), F.lit(None).cast(rows.schema["chunk_id"].dataType)
    vector = F.col("embedding").cast("array<double>").alias("embedding")
    both = dealt.select(*keys, F.lit(False).alias("asks"), no_query.alias("query_id"), "chunk_id", vector).unionByName(visiting.select(*keys, F.lit(True).alias("asks"), "query_id", no_chunk.alias("chunk_id"), vector))
    # a block's rows come before the queries that visit it
    met = both.repartition(*keys).sortWithinPartitions(*keys, "asks")
    return met.mapInArrow(lambda batches: _compare(batches, k, k_of), _result(asked.schema["query_id"].dataType, rows.schema["chunk_id"].dataType))


def _compare(batches: Iterator[pa.RecordBatch], k: int, k_of: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """The nearest rows of each block for the queries that follow them; a block and a batch of queries are held at once."""
    held: list[pa.RecordBatch] = []
    block, ids, vectors = None, None, None
    for piece in (p for batch in batches for p in _pieces(batch)):
        here = tuple(piece.column(i)[0].as_py() for i in range(4))
        if here != block:
            block, held, vectors = here, [], None
        if not piece.column(4)[0].as_py():
            held.append(piece)
            continue
        if not held:
            continue
        if vectors is None:
            ids, vectors = np.concatenate([values(p.column(6)) for p in held]), np.concatenate([matrix(p.column(7)) for p in held])
        top = Nearest(matrix(piece.column(7)), np.full(piece.num_rows, k_of.get(block[0], k)))
        top.feed(ids, vectors)
        yield _found(top, values(piece.column(5)), np.full(piece.num_rows, block[0], object), [piece.schema.field(5).type, piece.schema.field(6).type])


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of equal block and kind, at most SCANNED rows long."""
    marks = zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)
    for _, group in groupby(enumerate(marks), key=lambda x: x[1]):
        first = next(group)[0]
        last = first + 1 + sum(1 for _ in group)
        for at in range(first, last, SCANNED):
            yield batch.slice(at, min(SCANNED, last - at))


def _distances(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = (vectors**2).sum(axis=1)[:, None] - 2 * vectors @ centres.T + (centres**2).sum(axis=1)
    return np.sqrt(np.maximum(squares, 0))


def _spread(vectors: np.ndarray, n: int) -> np.ndarray:
    """At most n of the vectors, each the farthest from those before it."""
    chosen, apart = [0], _distances(vectors, vectors[:1])[:, 0]
    while len(chosen) < min(n, len(vectors)) and apart.max() > 0:
        chosen.append(int(apart.argmax()))
        apart = np.minimum(apart, _distances(vectors, vectors[chosen[-1:]])[:, 0])
    return vectors[chosen]


def _width(centres: np.ndarray, shells: int) -> float:
    """Thickness of a shell: the pivots' mean distance to their next neighbours over the number of shells."""
    if len(centres) < 2:
        return 1.0
    apart = _distances(centres, centres)
    np.fill_diagonal(apart, np.inf)
    return max(float(apart.min(axis=1).mean()) * 1.5 / shells, 1e-12)
