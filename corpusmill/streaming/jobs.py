"""Incremental ingest and running session statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from corpusmill.functions.scratch import written
from corpusmill.functions.text import is_korean
from corpusmill.operators.splitting import as_chunks, split_in_steps

PAGE_SCHEMA = "path string, page_no int, text string"


#: What the state operator gives for each page that has chunks: the language of its file's separators, the number of its first chunk.
PAGE_PLACE = T.StructType([T.StructField("path", T.StringType()), T.StructField("page_no", T.IntegerType()), T.StructField("file", T.StringType()), T.StructField("korean", T.BooleanType()), T.StructField("first_index", T.LongType())])


def chunk_facts(pages: DataFrame, steps: list[str], size: int | None = None) -> DataFrame:
    """A row for each chunk, without its text: path, page_no, file, place, korean, by. pages: path, page_no, text, file.

    by: `general` and `korean` for the chunks that either separators give; `before` for what the first semantic step takes, and
    whether that is Korean. Chains without such a step have one kind of chunks, the general one.
    """
    def rows(chunks: DataFrame, by: str, korean: Column) -> DataFrame:
        return chunks.select("path", "page_no", "file", "place", korean.cast("boolean").alias("korean"), F.lit(by).alias("by"))

    chunks = as_chunks(pages, "file")
    if "semantic" not in steps:
        return rows(split_in_steps(chunks, steps, size), "general", F.lit(None))
    at = steps.index("semantic")
    before = split_in_steps(chunks, steps[:at], size)
    cut = (rows(split_in_steps(before, steps[at:], size, F.lit(by == "korean")), by, F.lit(None)) for by in ("general", "korean"))
    return reduce(DataFrame.unionByName, cut, rows(before, "before", is_korean(F.col("text"))))


class ChunkNumbers(StatefulProcessor):
    """State of a file: the number of its next chunk, and whether its first chunk was Korean (null: it had none yet)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        kind = T.StructType([T.StructField("following", T.LongType()), T.StructField("korean", T.BooleanType())])
        self.file = handle.getValueState("file", kind)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        following, korean = self.file.get() if self.file.exists() else (0, None)
        counts: Counter = Counter()
        first: tuple | None = None
        for frame in rows:
            for page, file, place, is_first, by in frame[["page_no", "file", "place", "korean", "by"]].itertuples(index=False, name=None):
                if by != "before":
                    counts[by, page, file] += 1
                elif korean is None:
                    candidate = (page, tuple(place), bool(is_first))
                    first = candidate if first is None else min(first, candidate)
        if first is not None:
            korean = first[2]
        mine = sorted((page, file, n) for (by, page, file), n in counts.items() if by == ("korean" if korean else "general"))
        places = []
        for page, file, n in mine:
            places.append((key[0], page, file, bool(korean), following))
            following += n
        self.file.update((following, korean))
        yield pd.DataFrame(places, columns=PAGE_PLACE.names)

    def close(self) -> None:
        pass


def ingest_pages(spark: SparkSession, pages_dir: str, store_dir: str, checkpoint: str, domain: str, steps: list[str] | None = None, size: int | None = None, files_per_trigger: int | None = None) -> StreamingQuery:
    """Split the page files that arrive and append their chunks, with their numbers in the file, to a store.

    The pages of a file may come over any number of micro-batches, in reading order; the numbers go on where the last batch ended and
    the file's first chunk decides the separators of all, so the chunks are those of one batch. What is carried from batch to batch,
    the next number and that decision, is the operator's keyed state. It sees facts of chunks (their source file, page and place by
    either separators), not texts; a batch then reads its source files again, cuts them once more and adds the numbers. How many chunks a
    file has in all isn't known while it grows.

    Every micro-batch has a folder of its own in the store (batch=n), written in overwrite mode, so a batch that is run again
    after a failure replaces what it wrote before.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    names = steps or ["semantic"]
    reader = spark.readStream.schema(PAGE_SCHEMA)
    pages = (reader if files_per_trigger is None else reader.option("maxFilesPerTrigger", files_per_trigger)).parquet(pages_dir)
    facts = chunk_facts(pages.select("path", "page_no", "text", F.col("_metadata.file_path").alias("file")), names, size)
    placed = facts.groupBy("path").transformWithStateInPandas(statefulProcessor=ChunkNumbers(), outputStructType=PAGE_PLACE, outputMode="Append", timeMode="None")

    def write(batch: DataFrame, batch_id: int) -> None:
        places = written(batch)
        files = [r["file"] for r in places.select("file").distinct().collect()]  # the batch's source files, which Spark lists as well
        if not files:
            return
        known = places.select(F.col("path").alias("_path"), F.col("page_no").alias("_page"), F.col("file").alias("_file"), F.col("korean").alias("_korean"), "first_index")
        texts = spark.read.schema(PAGE_SCHEMA).parquet(*files).withColumn("_source", F.col("_metadata.file_path"))
        found = texts.join(known, texts["path"].eqNullSafe(known["_path"]) & (texts["page_no"] == known["_page"]) & (texts["_source"] == known["_file"]))
        chunks = split_in_steps(as_chunks(found.withColumn("korean_file", F.col("_korean")), "korean_file", "first_index"), names, size, F.col("korean_file"))
        inside = F.row_number().over(W.partitionBy("path", "page_no").orderBy("place")) - 1
        rows = chunks.withColumn("chunk_index", F.col("first_index") + inside).drop("first_index", "korean_file", "place")
        stamped = rows.withColumn("domain", F.lit(domain)).withColumn("content_type", F.coalesce("content_type", F.lit("general")))
        stamped.write.mode("overwrite").parquet(f"{store_dir}/batch={batch_id}")

    return placed.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_session_stats(log: DataFrame, watermark: str = "1 hour", window: str = "1 day") -> DataFrame:
    """Streaming counts and sums by window, session and question type; the watermark bounds the state.

    log: ts, session_id, question_type, elapsed_sec, cache_hit. Rows later than the watermark are left out.
    """
    return log.withWatermark("ts", watermark).groupBy(F.window("ts", window).alias("w"), "session_id", "question_type").agg(
        F.count("*").alias("queries"), F.round(F.sum("elapsed_sec"), 3).alias("total_elapsed"), F.count_if(F.coalesce("cache_hit", F.lit(False))).alias("hits")
    ).select(F.col("w.start").alias("window_start"), "session_id", "question_type", "queries", "total_elapsed", "hits")
