"""Files, pages, stores and the answer cache on disk."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusmill.functions.scratch import written

#: Extractors by name: functions from Pandas batches (path, content) to batches (path, page_no, text).
EXTRACTORS: dict[str, Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]] = {}


def extractor(name: str):
    """Register an extractor under a name."""
    def put(function):
        EXTRACTORS[name] = function
        return function

    return put


@extractor("plain")
def plain_text(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Form feeds end the pages of a UTF-8 file; bytes that aren't UTF-8 become replacement characters. One file's pages are held at a time."""
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            pages = bytes(content).decode("utf-8", "replace").split("\f")
            yield pd.DataFrame({"path": path, "page_no": range(len(pages)), "text": pages})


def file_inventory(spark: SparkSession, folder: str, suffix: str = ".pdf") -> DataFrame:
    """Path, size_kb (2 places) of the files with the suffix in any case. Contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    return files.where(F.lower("path").endswith(suffix)).select("path", F.round(F.col("length") / 1024, 2).alias("size_kb"))


def pages_of_files(spark: SparkSession, folder: str, extract: str | Callable, suffix: str = ".pdf") -> DataFrame:
    """Path, page_no, text from an extractor, registered or given, that sees each file's bytes where they are read.

    Formats such as PDF can't be read in pieces, so a file goes to its extractor whole and must fit into a task several times over.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    chosen = files.where(F.lower("path").endswith(suffix)).select("path", "content")
    return chosen.mapInPandas(EXTRACTORS[extract] if isinstance(extract, str) else extract, "path string, page_no int, text string")


#: Parts of a store partition's Bloom filter by the first byte of a digest, bits of each, and lookups.
PARTS, BITS, LOOKUPS = 256, 1 << 15, 4


def save_stores(store: DataFrame, base: str, mode: str = "overwrite", files_per_type: int = 8) -> None:
    """The store partitioned by domain and content_type. A frequent type is spread over several files by chunk_id.

    Every row has the md5 of its text as `digest`, and every partition Bloom filters of its digests under _blooms, for appends.
    """
    typed = store.withColumns({"domain": F.replace("domain", F.lit("/"), F.lit("_")), "content_type": F.coalesce("content_type", F.lit("general")), "digest": F.unhex(F.md5("text"))})
    spread = typed.repartition("domain", "content_type", F.pmod(F.xxhash64("chunk_id"), F.lit(files_per_type)))
    spread.write.mode(mode).partitionBy("domain", "content_type").parquet(base)
    _blooms(typed).write.mode(mode).parquet(f"{base}/_blooms")


def _positions(digests: np.ndarray) -> np.ndarray:
    """Bits of digests (rows of 16 bytes) in the filter of their part: one row of LOOKUPS for each; the first byte chose the part."""
    return digests[:, 4 : 4 + 2 * LOOKUPS].copy().view("<u2").astype(np.int64) % BITS


def _digest_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 16)


def _blooms(rows: DataFrame) -> DataFrame:
    """domain, content_type, part, bits: a filter for every partition and part. rows: domain, content_type, digest."""
    keyed = rows.where("digest is not null").select("domain", "content_type", _part(F.col("digest")).alias("part"), "digest")
    keys = ["domain", "content_type", "part"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, bits = None, np.zeros(BITS, bool)

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.string()), pa.array([key[1]], pa.string()), pa.array([key[2]], pa.int32()), pa.array([np.packbits(bits).tobytes()], pa.binary())], names=[*keys, "bits"])

        for batch in batches:
            marks = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            places = _positions(_digest_rows(batch.column(3))) if batch.num_rows else None
            for here, group in groupby(range(batch.num_rows), key=marks.__getitem__):
                if here != key:
                    if key is not None:
                        yield row()
                    key, bits = here, np.zeros(BITS, bool)
                at = list(group)
                bits[places[at[0] : at[-1] + 1]] = True
        if key is not None:
            yield row()

    return keyed.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(build, "domain string, content_type string, part int, bits binary")


def _part(digest: Column) -> Column:
    return F.conv(F.hex(F.substring(digest, 1, 1)), 16, 10).cast("int")


def _may_hold(new: DataFrame, blooms: DataFrame) -> DataFrame:
    """domain, content_type, digest: which partitions may hold which digests, by their filters.

    The digests of a part and the filters of that part meet in one place, the digests first; a filter at a time is held.
    """
    none = F.lit(None).cast("binary")
    asked = new.select(_part(F.col("digest")).alias("part"), F.lit("").alias("domain"), F.lit("").alias("content_type"), "digest", none.alias("bits"))
    told = blooms.select("part", "domain", "content_type", none.alias("digest"), "bits")
    both = asked.unionByName(told).repartition("part").sortWithinPartitions("part", F.col("bits").isNotNull())

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for batch in batches:
            for here, domain, kind, digest, bits in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if here != part:
                    part, held, table, places = here, [], None, None
                if bits is None:
                    held.append(digest)
                    continue
                if held and places is None:
                    table = np.frombuffer(b"".join(held), np.uint8).reshape(-1, 16)
                    places = _positions(table)
                if held:
                    hit = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8))[places].all(axis=1))
                    yield pa.RecordBatch.from_arrays([pa.array([domain] * len(hit), pa.string()), pa.array([kind] * len(hit), pa.string()), pa.array([table[i].tobytes() for i in hit], pa.binary())], names=["domain", "content_type", "digest"])

    return both.mapInArrow(test, "domain string, content_type string, digest binary")


def load_store(spark: SparkSession, base: str, domain: str, content_type: str | None = None) -> tuple[DataFrame, int]:
    """The rows of a store and how many; every type of the domain without content_type. A missing one is an error."""
    wanted = F.col("domain") == domain.replace("/", "_")
    if content_type is not None:
        wanted = wanted & (F.col("content_type") == content_type)
    rows = spark.read.parquet(base).where(wanted)
    if not (n := rows.count()):
        raise FileNotFoundError(f"no store {domain}_{content_type or 'all'} in {base}")
    return rows, n


def append_to_store(store: DataFrame, base: str, skip_known: bool = False) -> None:
    """Add rows; new types come to be, known ones grow. With skip_known texts that are stored already, in any partition, or
    twice in the new rows, are left out; of equal new ones the smallest chunk_id stays. Null texts are never known.

    No stored text is read for it: Bloom filters name the partitions that may hold one of the new digests, and of these alone
    the stored digests are compared.
    """
    if skip_known:
        store = new_texts(store, base)
    save_stores(store, base, "append")


def new_texts(store: DataFrame, base: str) -> DataFrame:
    """The rows of store whose text no partition under base has, one of each text."""
    spark = store.sparkSession
    keyed = store.withColumn("_digest", F.unhex(F.md5("text")))
    first = keyed.where(F.col("_digest").isNotNull()).groupBy("_digest").agg(F.min("chunk_id").alias("_first"))
    digests = written(first)
    doubtful = written(_may_hold(digests.select(F.col("_digest").alias("digest")), spark.read.parquet(f"{base}/_blooms")))
    asked = doubtful.select("domain", "content_type").distinct().collect()  # partitions of the store
    wanted = F.col("domain").isin(sorted({r[0] for r in asked})) & F.col("content_type").isin(sorted({r[1] for r in asked}))
    known = spark.read.parquet(base).where(wanted).select("digest").join(doubtful.select("digest").distinct(), "digest", "left_semi").distinct()
    fresh = digests.join(known, digests["_digest"] == known["digest"], "left_anti").select(F.col("_digest").alias("_d"), "_first")
    same = F.col("_digest").isNull() | (F.col("_first") == F.col("chunk_id"))
    return keyed.join(fresh, keyed["_digest"] == fresh["_d"], "left").where(same).dropDuplicates(["chunk_id", "_digest"]).select(*store.columns)


def publish_answers(answers: DataFrame, path: str) -> None:
    """Add answers (key, model, response) to the cache."""
    answers.select("key", "model", "response").write.mode("append").parquet(path)


def clear_answers(spark: SparkSession, path: str) -> None:
    """An empty cache."""
    spark.createDataFrame([], "key string, model string, response string").write.mode("overwrite").parquet(path)
